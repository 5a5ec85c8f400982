"""Registered queries for record assembly, lookups, validation and prompts."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lectern import dims
from lectern.functions import text as T
from lectern.operators import records as R
from lectern.operators import segment as SEG
from lectern.plans import oracle_text as O
from lectern.plans import text_queries as TQ
from lectern.plans.tables import sql_str, table
from lectern.session import materialize as write_table

CANARY = "lectern test canary"
SUBJECTS = [s for s, _ in dims.SUBJECT_CODES]


def _record_json():
    """The record as one JSON string, as the sink writes it."""
    return F.to_json(F.struct("input", "target", "id", "metadata"))


def _pick_sql(key: str, values: list[str]) -> str:
    """SQL form of picking ``values[key % len(values)]``."""
    arms = " ".join(f"WHEN {i} THEN {sql_str(v)}" for i, v in enumerate(values))
    return f"(CASE ({key}) % {len(values)} {arms} END)"


def _codes_sql() -> str:
    return "(VALUES " + ", ".join(f"('{s}', '{c}')" for s, c in dims.SUBJECT_CODES) + ") AS codes(subject, code)"


def _letters_sql() -> str:
    return "(VALUES " + ", ".join(f"({sql_str(l)}, {sql_str(t)})" for l, t in dims.LETTER_EXAMPLES) + ") AS lx(language, letters)"


def _translations_sql() -> str:
    return "(VALUES " + ", ".join(f"({sql_str(l)}, {sql_str(a)}, {sql_str(t)})" for l, a, t in dims.ANSWER_TRANSLATIONS) \
        + ") AS tr(language, answer, translated)"


def _section_lat_sql(col: str) -> str:
    arms = " ".join(f"WHEN {sql_str(c)} THEN {sql_str(l)}" for c, l in dims.SECTION_LATIN)
    return f"(CASE {col} {arms} ELSE {col} END)"


def _j(expr: str) -> str:
    return f"to_json({expr})"


def _record_json_sql(system: str, user_parts: str, target: str, rid: str, comments: str, subject: str,
                     year: str, language: str, section: str, points: str) -> str:
    """The record as Spark's ``to_json`` writes it (null fields left out)."""
    return ("'{\"input\":[{\"role\":\"system\",\"content\":[{\"type\":\"text\",\"text\":' || " + _j(system)
            + " || '}]},{\"role\":\"user\",\"content\":[' || " + user_parts + " || ']}],\"target\":' || "
            + _j(target) + " || ',\"id\":' || " + _j(rid) + " || ',\"metadata\":{' || "
            + f"CASE WHEN {comments} IS NULL THEN '' ELSE '\"comments\":' || {_j(comments)} || ',' END || "
            + "'\"subject\":' || " + _j(subject) + " || ',\"year\":' || " + _j(year)
            + " || ',\"language\":' || " + _j(language) + " || ',\"section\":' || " + _j(section)
            + " || ',\"points\":' || CAST(" + points + " AS VARCHAR) || ',\"canary\":' || "
            + _j(sql_str(CANARY)) + " || '}}'")


def _text_part_sql(text: str) -> str:
    return "'{\"type\":\"text\",\"text\":' || " + _j(text) + " || '}'"


# -------------------------------------------------------------- chat_records
# conversations as records: one record per user turn; system text = the
# conversation's system turns (newline-joined) plus the letter example of its
# language (rus for even conv_id, bel for odd); target = the next turn when it
# is the assistant's, else ''; section A for turns 0-1, B after.


def q_chat_records(spark: SparkSession, sf_dir: str):
    c = table(spark, sf_dir, "conversations")
    system = (c.where(F.col("role") == "system").groupBy("conv_id")
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))),
                                            lambda x: x["text"]), "\n").alias("sys")))
    reply = c.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply"))
    u = (c.where(F.col("role") == "user")
         .join(system, "conv_id", "left").join(reply, ["conv_id", "turn"], "left")
         .withColumn("language", F.when(F.col("conv_id") % 2 == 0, "rus").otherwise("bel"))
         .join(dims.letter_examples(spark), "language"))
    section = F.when(F.col("turn") < 2, "A").otherwise("B")
    rid = F.concat_ws("-", F.lit("conv"), F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    cols = R.record_columns(F.concat(F.coalesce("sys", F.lit("")), F.lit("\n"), F.col("letters")),
                            F.col("text"), None, F.coalesce("reply", F.lit("")), rid,
                            F.lit(None).cast("string"), F.lit("chat"), F.lit("2024"), F.col("language"),
                            section, CANARY)
    return u.select(*cols).select("id", _record_json().alias("record"))


def sql_chat_records() -> str:
    rid = "'conv-' || CAST(u.conv_id AS VARCHAR) || '-' || CAST(u.turn AS VARCHAR)"
    lang = "CASE WHEN u.conv_id % 2 = 0 THEN 'rus' ELSE 'bel' END"
    rec = _record_json_sql(
        system="coalesce(s.sys, '') || chr(10) || lx.letters", user_parts=_text_part_sql("u.text"),
        target="coalesce(r.text, '')", rid=rid, comments="NULL", subject="'chat'", year="'2024'",
        language=lang, section="CASE WHEN u.turn < 2 THEN 'A' ELSE 'B' END",
        points="CASE WHEN u.turn < 2 THEN 1 ELSE 2 END")
    return f"""
    SELECT {rid} AS id, {rec} AS record
    FROM conversations u
    LEFT JOIN (SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS sys FROM conversations
               WHERE role = 'system' GROUP BY conv_id) s ON s.conv_id = u.conv_id
    LEFT JOIN conversations r ON r.conv_id = u.conv_id AND r.turn = u.turn + 1 AND r.role = 'assistant'
    JOIN {_letters_sql()} ON lx.language = {lang}
    WHERE u.role = 'user'"""


# -------------------------------------------------------------- exam_records
# documents as exams: subject by doc_id % 15, year 2023, language rus for
# English and German documents, bel otherwise; questions and section info from
# segmentation; answers from labels (one per document); one image per page,
# page_id = doc_id, assigned to the document's first question, bytes = html.


def _exam_inputs(spark, sf_dir, materialize: bool = True):
    docs = table(spark, sf_dir, "documents")
    exams = docs.select("doc_id",
                        F.element_at(F.array(*[F.lit(s) for s in SUBJECTS]), (F.col("doc_id") % 15 + 1).cast("int")).alias("subject"),
                        F.lit("2023").alias("year"),
                        F.when(F.col("lang").isin("en", "de"), "rus").otherwise("bel").alias("language"))
    segs = SEG.segments(TQ._doc_classified(spark, sf_dir))
    if materialize:   # read by questions, section info and the image assignment
        segs = write_table(spark, segs, "segments")
    questions = SEG.items_of(segs)
    info = SEG.section_info_of(segs)
    lab = table(spark, sf_dir, "labels")
    answers = lab.select(
        "doc_id",
        F.when(F.col("quality") == 1, "ПОЛИТИКА").when(F.col("toxic") == 1, "МЕЖЛЕДНИКОВЬЕ")
        .otherwise(F.concat(F.lit("ОТВЕТ "), F.col("doc_id").cast("string"))).alias("answer"),
        F.format_string("quality %d, toxic %d", "quality", "toxic").alias("comment"))
    first_q = questions.groupBy("doc_id").agg(F.min_by("question_id", "pos").alias("question_id"))
    pages = table(spark, sf_dir, "pages")
    images = (pages.join(first_q, pages.page_id == first_q.doc_id)
              .select("doc_id", "question_id", F.lit(1).alias("page_no"), F.lit(1).alias("img_no"),
                      T.data_uri(F.encode("html", "UTF-8"), F.lit("png")).alias("image_url")))
    return exams, questions, info, answers, images


def q_exam_records(spark: SparkSession, sf_dir: str):
    exams, questions, info, answers, images = _exam_inputs(spark, sf_dir)
    rec = R.assemble_records(spark, exams, questions, info, answers, images, CANARY,
                             answer_keys=("doc_id",), image_keys=("doc_id", "question_id"))
    return rec.select("doc_id", "id", _record_json().alias("record"))


def sql_exam_records() -> str:
    items = TQ.sql_segment_lines()
    info = TQ.sql_section_info()
    subj = _pick_sql("d.doc_id", SUBJECTS)
    sec = _section_lat_sql("q.section")
    rid = f"codes.code || '-' || e.subject || '-2023-' || e.language || '-' || {sec} || substr(q.question_id, 2)"
    img = "'{\"type\":\"image\",\"image\":' || to_json('data:image/png;base64,' || to_base64(encode(p.html))) || '}'"
    parts = _text_part_sql("q.text") + " || coalesce(',' || im.part, '')"
    answer = ("CASE WHEN l.quality = 1 THEN 'ПОЛИТИКА' WHEN l.toxic = 1 THEN 'МЕЖЛЕДНИКОВЬЕ' "
              "ELSE 'ОТВЕТ ' || CAST(l.doc_id AS VARCHAR) END")
    rec = _record_json_sql(
        system="coalesce(si.general_info, '') || chr(10) || lx.letters", user_parts=parts,
        target=f"coalesce(tr.translated, {answer})", rid=rid,
        comments="'quality ' || CAST(l.quality AS VARCHAR) || ', toxic ' || CAST(l.toxic AS VARCHAR)",
        subject="e.subject", year="'2023'", language="e.language", section=sec,
        points=f"CASE WHEN {sec} = 'A' THEN 1 ELSE 2 END")
    return f"""
    WITH q AS ({items}),
    si AS ({info}),
    e AS (SELECT d.doc_id, {subj} AS subject,
                 CASE WHEN d.lang IN ('en', 'de') THEN 'rus' ELSE 'bel' END AS language FROM documents d),
    fq AS (SELECT doc_id, arg_min(question_id, pos) AS question_id FROM q GROUP BY doc_id),
    im AS (SELECT fq.doc_id, fq.question_id, {img} AS part FROM pages p JOIN fq ON p.page_id = fq.doc_id)
    SELECT q.doc_id, {rid} AS id, {rec} AS record
    FROM q JOIN e ON e.doc_id = q.doc_id
    JOIN {_codes_sql()} ON codes.subject = e.subject
    LEFT JOIN si ON si.doc_id = q.doc_id AND si.section = q.section
    JOIN {_letters_sql()} ON lx.language = e.language
    JOIN labels l ON l.doc_id = q.doc_id
    LEFT JOIN {_translations_sql()} ON tr.language = e.language AND tr.answer = {answer}
    LEFT JOIN im ON im.doc_id = q.doc_id AND im.question_id = q.question_id"""


# ---------------------------------------------------------------- dim_lookup
# customers as questions: subject by nation % 15 (P1), Cyrillic section А for
# even keys and В for odd (P2), question id <section><custkey % 40 + 1> (P3),
# answer from the market segment with two segments mapped to dictionary
# words (P4), language rus for even nations, points (P5), record id.


def q_dim_lookup(spark: SparkSession, sf_dir: str):
    c = table(spark, sf_dir, "customer")
    sec = F.when(F.col("c_custkey") % 2 == 0, "А").otherwise("В")
    q = c.select(
        "c_custkey",
        F.element_at(F.array(*[F.lit(s) for s in SUBJECTS]), (F.col("c_nationkey") % 15 + 1).cast("int")).alias("subject"),
        sec.alias("section"),
        F.concat(sec, (F.col("c_custkey") % 40 + 1).cast("string")).alias("question_id"),
        F.when(F.col("c_nationkey") % 2 == 0, "rus").otherwise("bel").alias("language"),
        F.when(F.col("c_mktsegment") == "BUILDING", "ПОЛИТИКА").when(F.col("c_mktsegment") == "MACHINERY", "МЕЖЛЕДНИКОВЬЕ")
        .otherwise(F.upper("c_mktsegment")).alias("answer"))
    q = q.join(dims.subject_codes(spark), "subject")
    q = R.translate_answers(spark, q)
    lat = dims.section_latin("section")
    rid = F.concat_ws("-", "code", "subject", F.lit("2023"), "language",
                      F.concat(lat, F.expr("substring(question_id, 2)")))
    return q.select("c_custkey", rid.alias("id"), "target", lat.alias("section"),
                    F.when(lat == "A", 1).otherwise(2).alias("points"))


def sql_dim_lookup() -> str:
    sec = "CASE WHEN c_custkey % 2 = 0 THEN 'А' ELSE 'В' END"
    lat = _section_lat_sql(f"({sec})")
    ans = ("CASE WHEN c_mktsegment = 'BUILDING' THEN 'ПОЛИТИКА' WHEN c_mktsegment = 'MACHINERY' THEN 'МЕЖЛЕДНИКОВЬЕ' "
           f"ELSE {O.upper('c_mktsegment')} END")
    lang = "CASE WHEN c_nationkey % 2 = 0 THEN 'rus' ELSE 'bel' END"
    subj = _pick_sql("c_nationkey", SUBJECTS)
    return f"""
    SELECT c_custkey, codes.code || '-' || {subj} || '-2023-' || {lang} || '-' || {lat} || CAST(c_custkey % 40 + 1 AS VARCHAR) AS id,
           coalesce(tr.translated, {ans}) AS target, {lat} AS section,
           CASE WHEN {lat} = 'A' THEN 1 ELSE 2 END AS points
    FROM customer JOIN {_codes_sql()} ON codes.subject = {subj}
    LEFT JOIN {_translations_sql()} ON tr.language = {lang} AND tr.answer = {ans}"""


# ------------------------------------------------------------------ validate
# catalogue requests from customers: subject from 15 valid codes and two
# invalid ones by custkey % 17, language rus / bel / eng by custkey % 3.

_REQ_SUBJECTS = SUBJECTS + ["xyz", "abc"]
_REQ_LANGS = ["rus", "bel", "eng"]


def q_validate(spark: SparkSession, sf_dir: str):
    c = table(spark, sf_dir, "customer")
    req = c.select(
        "c_custkey",
        F.element_at(F.array(*[F.lit(s) for s in _REQ_SUBJECTS]), (F.col("c_custkey") % 17 + 1).cast("int")).alias("subject"),
        F.element_at(F.array(*[F.lit(s) for s in _REQ_LANGS]), (F.col("c_custkey") % 3 + 1).cast("int")).alias("language"),
        F.lit("2023").alias("year"))
    return R.catalogue_rejects(spark, req).select("c_custkey", "error")


def sql_validate() -> str:
    subj = _pick_sql("c_custkey", _REQ_SUBJECTS)
    lang = _pick_sql("c_custkey", _REQ_LANGS)
    known = "(" + ", ".join(f"'{s}'" for s in SUBJECTS) + ")"
    return f"""
    SELECT c_custkey, CASE WHEN s NOT IN {known} THEN 'Subject ''' || s || ''' is not a valid subject code.'
                           ELSE 'Language ''' || l || ''' is not a valid language.' END AS error
    FROM (SELECT c_custkey, {subj} AS s, {lang} AS l FROM customer)
    WHERE s NOT IN {known} OR l NOT IN ('rus', 'bel')"""


# ------------------------------------------------------------ validate_records
# V2/V3 over the exam_records inputs: questions whose document has no label,
# and exams without questions or without an image.

def q_validate_records(spark: SparkSession, sf_dir: str):
    exams, questions, info, answers, images = _exam_inputs(spark, sf_dir)
    return R.validation_report(exams.select("doc_id"), questions, answers, images,
                               answer_keys=("doc_id",), image_exam_keys=("doc_id",))


def sql_validate_records() -> str:
    items = TQ.sql_segment_lines()
    return f"""
    WITH q AS ({items}),
    fq AS (SELECT doc_id, arg_min(question_id, pos) AS question_id FROM q GROUP BY doc_id),
    im AS (SELECT DISTINCT fq.doc_id FROM pages p JOIN fq ON p.page_id = fq.doc_id)
    SELECT doc_id, question_id, 'no answer' AS problem FROM q WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    UNION ALL
    SELECT doc_id, NULL, 'no questions' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM q)
    UNION ALL
    SELECT doc_id, NULL, 'no answers' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
    UNION ALL
    SELECT doc_id, NULL, 'no images' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM im)"""


# ------------------------------------------------------------- build_prompts

def q_build_prompts(spark: SparkSession, sf_dir: str):
    """P10 + P11 on benchmark items."""
    b = table(spark, sf_dir, "benchmark")
    return b.select("item_id", T.prompt_text("text").alias("prompt"))


def sql_build_prompts() -> str:
    return f"SELECT item_id, replace({sql_str(T.COT_TEMPLATE)}, '{{prompt}}', text) AS prompt FROM benchmark"


# ---------------------------------------------------------- jsonl_roundtrip
# chat_records appended twice to a fresh folder under the session's checkpoint
# folder (K2 create, K1 append twice), read back with the explicit schema.

def q_jsonl_roundtrip(spark: SparkSession, sf_dir: str):
    import uuid

    from lectern.schemas import RECORD
    from lectern.session import ensure_checkpoint_dir
    from lectern.sources import readers, sinks
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/lectern-records-{uuid.uuid4().hex}"
    sinks.create_dataset(spark, path)
    recs = q_chat_records(spark, sf_dir).select(F.from_json("record", RECORD).alias("r")).select("r.*")
    sinks.append_records(recs, path)
    sinks.append_records(recs, path)
    back = readers.read_records(spark, path)
    return back.select("id", F.to_json(F.struct("input", "target", "id", "metadata")).alias("record"))


def sql_jsonl_roundtrip() -> str:
    one = sql_chat_records()
    return f"SELECT * FROM ({one}) UNION ALL SELECT * FROM ({one})"


# --------------------------------------------------------------- quarantine
# conversations: every turn is a line of JSON, written as text to a fresh folder;
# by (conv_id * 31 + turn) % 10 a line is cut short (0), lacks its id (1), has
# text as input (2), or lacks its metadata (3) or input (4).  Read back with the
# record schema: good lines as records, the others as rejects with their problem.

def q_quarantine(spark: SparkSession, sf_dir: str):
    import uuid

    from lectern.session import ensure_checkpoint_dir
    from lectern.sources import readers
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", ((F.col("conv_id") * 31 + F.col("turn")) % 10).alias("kind"))
    kind = F.col("kind")
    field = lambda k, text: F.when(kind == k, F.lit(None).cast("string")).otherwise(text)
    body = F.concat_ws(",", F.when(kind == 2, '"input":"text"').otherwise(field(4, F.lit('"input":[]'))),
                       F.concat(F.lit('"target":"t'), F.col("turn"), F.lit('"')),
                       field(1, F.concat(F.lit('"id":"'), F.col("conv_id"), F.lit("-"), F.col("turn"), F.lit('"'))),
                       field(3, F.concat(F.lit('"metadata":{"points":'), F.col("turn"), F.lit("}"))))
    line = F.concat(F.lit("{"), body, F.lit("}"))
    line = F.when(kind == 0, line.substr(F.lit(1), F.length(line) - 3)).otherwise(line)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lectern-lines-{uuid.uuid4().hex}"
    c.select(line.alias("value")).write.text(path)
    records, rejects = readers.read_records_checked(spark, path)
    none = F.lit(None).cast("string")
    return records.select("id", F.col("metadata.points").cast("bigint").alias("points"), none.alias("problem"), none.alias("raw")).unionByName(
        rejects.select(none.alias("id"), F.lit(None).cast("bigint").alias("points"), "problem", "raw"))


def sql_quarantine() -> str:
    def line(k: int) -> str:
        parts = [None if k == 4 else "'\"input\":\"text\"'" if k == 2 else "'\"input\":[]'", "'\"target\":\"t' || turn || '\"'",
                 None if k == 1 else "'\"id\":\"' || conv_id || '-' || turn || '\"'",
                 None if k == 3 else "'\"metadata\":{\"points\":' || turn || '}'"]
        return "'{' || " + " || ',' || ".join(p for p in parts if p) + " || '}'"
    cut = f"left({line(0)}, length({line(0)}) - 3)"
    problems = {0: "not a record", 1: "no id", 2: "not a record", 3: "no metadata", 4: "no input"}
    problem = " ".join(f"WHEN {k} THEN '{p}'" for k, p in problems.items())
    raw = " ".join(f"WHEN {k} THEN {cut if k == 0 else line(k)}" for k in problems)
    return f"""SELECT CASE WHEN kind >= 5 THEN conv_id || '-' || turn END AS id, CASE WHEN kind >= 5 THEN turn END::BIGINT AS points,
       CASE kind {problem} END AS problem, CASE kind {raw} END AS raw
FROM (SELECT conv_id, turn, (conv_id * 31 + turn) % 10 AS kind FROM conversations)"""
