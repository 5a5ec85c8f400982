"""The end-to-end build over exams made from ``customer``: records, problems, images.

Each customer is one exam, named by its key (``year`` is the key as text).  The
subject is the sixteenth of a list of the fifteen codes and one unknown code;
every tenth exam has an unsupported second language (``eng``) instead of
Belarusian; every seventh exam lists its documents twice.  A document has two
pages with sections А and В and three questions; the answer of В1 is missing in
every eleventh exam.  The first document holds three images, the first two for
question А1 and the third for В1 where the key is even; every fourth exam
has an edited copy of the second.  ``eng`` documents hold an image too, which no
exam may use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern import dims
from lectern.build import BuildResult, ExamInputs, Profiles, build_records
from lectern.plans.tables import sql_str, table

SUBJECTS = [s for s, _ in dims.SUBJECT_CODES] + ["xyz"]
CANARY = "lectern"


def _path(lang) -> F.Column:
    lang = F.lit(lang) if isinstance(lang, str) else lang
    return F.concat(F.lit("data/"), F.col("subject"), F.lit("_"), F.col("year"), F.lit("_"), lang, F.lit(".pdf"))


def exams_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    subject = F.element_at(F.array(*[F.lit(s) for s in SUBJECTS]), (F.col("c_custkey") % len(SUBJECTS) + 1).cast("int"))
    return c.select("*", subject.alias("subject"), F.col("c_custkey").cast("string").alias("year"),
                    F.when(F.col("c_custkey") % 10 == 0, "eng").otherwise("bel").alias("second"))


def inputs_of(spark: SparkSession, sf_dir: str) -> tuple[ExamInputs, Profiles]:
    e = exams_of(spark, sf_dir)
    k = F.col("c_custkey")
    test = e.withColumn("language", F.explode(F.array(F.lit("rus"), F.col("second")))).withColumn("doc_id", _path(F.col("language")))
    docs = (test.select("doc_id", "subject", "year", "language", F.lit("test").alias("kind"), (k % 7 == 0).alias("twice"))
            .unionByName(e.select(_path("consult").alias("doc_id"), "subject", "year", F.lit(None).cast("string").alias("language"),
                                  F.lit("consult").alias("kind"), (k % 7 == 0).alias("twice"))))
    docs = docs.withColumn("copy", F.explode(F.when(F.col("twice"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))) \
        .drop("twice", "copy")
    first = F.concat(F.lit("Часть А\n"), F.col("c_mktsegment"), F.lit(" info\nА1. First "), F.col("language"), F.lit(" of "),
                     F.col("c_name"), F.lit(" here\nА2. Second\n"))
    second = F.concat(F.lit("Часть В\nВ1. Third "), F.col("c_mktsegment"), F.lit("\nitem"))
    pages = test.select("doc_id", F.posexplode(F.array(first, second)).alias("page_no", "text")).withColumn("page_no", F.col("page_no") + 1)
    blocks = e.select(_path("consult").alias("doc_id"), F.lit(1).alias("page_no"), F.posexplode(F.array(
        F.struct(F.lit(141.0).alias("x0"), F.concat(F.lit("А1. q\nОтвет: "), (k % 5 + 1).cast("string")).alias("text")),
        F.struct(F.lit(410.0).alias("x0"), F.concat(F.lit("note "), k.cast("string")).alias("text")),
        F.struct(F.lit(410.0).alias("x0"), F.lit("more").alias("text")),
        F.struct(F.lit(141.0).alias("x0"), F.lit("А2. q\nОтвет: политика").alias("text")),
        F.struct(F.lit(141.0).alias("x0"), F.when(k % 11 != 0, F.concat(F.lit("В1. q\nОтвет: "), F.lower("c_mktsegment"))).otherwise("В1. q").alias("text"))
    )).alias("block_no", "b")).select("doc_id", "page_no", "block_no", "b.x0", (F.col("block_no") * 20.0).alias("y0"),
                                      (F.col("b.x0") + 80).alias("x1"), (F.col("block_no") * 20.0 + 10).alias("y1"), "b.text")
    # attribution keeps a question only when it has an answer or a comment: В1 without an answer must not appear
    blocks = blocks.where(F.col("text") != "В1. q")
    spots = F.array(*[F.struct(F.lit(p).alias("page_no"), F.lit(i).alias("img_no")) for p, i in ((1, 1), (1, 2), (2, 1))])
    shape = [F.lit("png").alias("format"), F.encode(F.concat_ws(" ", F.col("c_name"), F.col("s.page_no"), F.col("s.img_no")), "utf-8").alias("content"),
             *[F.lit(v).alias(n) for n, v in (("x0", 300.0), ("y0", 300.0), ("x1", 400.0), ("y1", 400.0))]]
    own = e.select(_path("rus").alias("doc_id"), "c_name", F.explode(spots).alias("s"))
    foreign = e.where("second = 'eng'").select(_path("eng").alias("doc_id"), "c_name", F.explode(F.slice(spots, 1, 1)).alias("s"))
    images = own.unionByName(foreign).select("doc_id", "s.page_no", "s.img_no", *shape)
    edited = e.where(k % 4 == 0).select(_path("rus").alias("doc_id"), F.lit("page1_img2.png").alias("filename"),
                                        F.encode(F.concat(F.lit("edited "), "c_name"), "utf-8").alias("content"))
    positions = e.select("subject", "year", F.explode(F.when(k % 2 == 0, F.array(*[F.struct(F.lit(p).alias("position"), F.lit(q).alias("question_id"))
                                                                                 for p, q in ((1, "А1"), (2, "А1"), (3, "В1"))]))
                                                      .otherwise(F.array(*[F.struct(F.lit(p).alias("position"), F.lit("А1").alias("question_id"))
                                                                           for p in (1, 2)]))).alias("p")).select("subject", "year", "p.*")
    return ExamInputs(docs, pages, blocks, images, edited_images=edited), Profiles(position_map=positions)


def _built(spark: SparkSession, sf_dir: str) -> BuildResult:
    inputs, profiles = inputs_of(spark, sf_dir)
    return build_records(spark, inputs, CANARY, profiles)


def q_build_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 by question id, J2 with ordered images, P1-P9, J9, R28: the records of the build, flat."""
    r = _built(spark, sf_dir).records
    parts = F.filter(F.col("input")[1]["content"], lambda p: p["type"] == "image")
    return r.select("id", "target", F.col("input")[0]["content"][0]["text"].alias("system"),
                    F.col("input")[1]["content"][0]["text"].alias("question"),
                    F.array_join(F.transform(parts, lambda p: p["image"]), "|").alias("images"),
                    F.col("metadata.comments").alias("comments"), F.col("metadata.section").alias("section"),
                    F.col("metadata.points").cast("bigint").alias("points"), F.col("metadata.language").alias("language"))


def q_build_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1, V2, V3, V5, V6 and images past the list: the problem report of the build."""
    return _built(spark, sf_dir).problems


def q_build_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The image table of the build."""
    i = _built(spark, sf_dir).images
    return i.select("doc_id", "filename", "question_id", "image_url", F.col("size").cast("bigint").alias("size"), "nearby_text")


def _sql_exams() -> str:
    arms = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(SUBJECTS))
    codes = " ".join(f"WHEN '{s}' THEN '{c}'" for s, c in dims.SUBJECT_CODES)
    return f"""e AS (SELECT *, 'data/' || subject || '_' || year || '_' AS stem, CASE subject {codes} END AS code,
                 CASE WHEN k % 7 = 0 THEN 2 ELSE 1 END AS times
          FROM (SELECT c_custkey AS k, c_name AS name, c_mktsegment AS seg, c_custkey::VARCHAR AS year,
                       CASE c_custkey % {len(SUBJECTS)} {arms} END AS subject,
                       CASE WHEN c_custkey % 10 = 0 THEN 'eng' ELSE 'bel' END AS second FROM customer))"""


_URI = "'data:image/png;base64,' || to_base64(encode({}))"


def _sql_image(page: int, img: int) -> str:
    plain = f"name || ' {page} {img}'"
    if (page, img) == (1, 2):
        return f"CASE WHEN k % 4 = 0 THEN 'edited ' || name ELSE {plain} END"
    return plain


def sql_build_records() -> str:
    letters = " ".join(f"WHEN '{lang}' THEN {sql_str(x)}" for lang, x in dims.LETTER_EXAMPLES)
    a1 = f"{_URI.format(_sql_image(1, 1))} || '|' || {_URI.format(_sql_image(1, 2))}"
    return f"""
WITH {_sql_exams()},
d AS (SELECT *, unnest(['rus', second]) AS language FROM e),
q AS (SELECT *, unnest([
        {{'n': 'A1', 'target': (k % 5 + 1)::VARCHAR, 'question': 'А1. First ' || language || ' of ' || name || ' here',
          'images': {a1}, 'comments': 'note ' || k || ' more', 'section': 'A'}},
        {{'n': 'A2', 'target': CASE language WHEN 'bel' THEN 'ПАЛІТЫКА' ELSE 'ПОЛИТИКА' END, 'question': 'А2. Second',
          'images': '', 'comments': '', 'section': 'A'}},
        {{'n': 'B1', 'target': CASE WHEN k % 11 <> 0 THEN upper(seg) END, 'question': 'В1. Third ' || seg || ' item',
          'images': CASE WHEN k % 2 = 0 THEN {_URI.format(_sql_image(2, 1))} ELSE '' END, 'comments': '', 'section': 'B'}}]) AS x
      FROM d WHERE code IS NOT NULL AND language <> 'eng')
SELECT code || '-' || subject || '-' || year || '-' || language || '-' || x.n AS id, x.target AS target,
       CASE x.section WHEN 'A' THEN seg || ' info' ELSE '' END || chr(10) || CASE language {letters} END AS system,
       x.question AS question, x.images AS images, x.comments AS comments, x.section AS section,
       CASE x.section WHEN 'A' THEN 1 ELSE 2 END::BIGINT AS points, language
FROM q, range(times) WHERE x.target IS NOT NULL"""


def sql_build_problems() -> str:
    bad_subject, bad_language = (m.replace("{}", "' || {} || '") for m in (dims.MSG_BAD_SUBJECT, dims.MSG_BAD_LANGUAGE))
    quoted = lambda m, c: "'" + m.replace("Subject '", "Subject ''").replace("Language '", "Language ''").replace("' is not", "'' is not").format(c) + "'"
    return f"""
WITH {_sql_exams()},
d AS (SELECT *, unnest(['rus', second]) AS language FROM e)
SELECT stem || language || '.pdf' AS doc_id, 'В1' AS question_id, 'no answer' AS problem FROM d WHERE k % 11 = 0
UNION ALL SELECT stem || language || '.pdf', NULL,
       CASE WHEN code IS NULL THEN {quoted(bad_subject, 'subject')} ELSE {quoted(bad_language, 'language')} END
FROM d WHERE code IS NULL OR language = 'eng'
UNION ALL SELECT stem || 'rus.pdf', 'page2_img1.png', 'image without question' FROM e WHERE k % 2 = 1
UNION ALL SELECT stem || 'eng.pdf', NULL, 'unsupported image source' FROM e WHERE second = 'eng'"""


def sql_build_images() -> str:
    rows = ", ".join(f"{{'f': 'page{p}_img{i}.png', 'q': {q}, 'c': {_sql_image(p, i)}}}"
                     for p, i, q in ((1, 1, "'А1'"), (1, 2, "'А1'"), (2, 1, "CASE WHEN k % 2 = 0 THEN 'В1' END")))
    return f"""
WITH {_sql_exams()},
i AS (SELECT stem, unnest([{rows}]) AS x FROM e)
SELECT stem || 'rus.pdf' AS doc_id, x.f AS filename, x.q AS question_id, {_URI.format('x.c')} AS image_url,
       octet_length(encode(x.c))::BIGINT AS size, '' AS nearby_text FROM i"""
