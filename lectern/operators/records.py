"""Exam catalogue, validation and chat-style record assembly.

J1, J2, J7, P1-P10, V1-V6, U1, O3 of the survey.  A record per question:

  input    [system: section info + letter example,
            user: question text, then one image part per assigned image]
  target   answer (translated for Belarusian)
  id       code-subject-year-language-<Latin question id>
  metadata comments, subject, year, language, section, points, canary
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern import dims
from lectern.session import shuffled


# ------------------------------------------------------------------ catalogue

def exam_documents(spark: SparkSession, requests: DataFrame) -> DataFrame:
    """J7 + S6: each requested ``(subject, year)`` in both languages, with the
    test and consult file paths.  An unknown subject has no code, so no path:
    it is left out here, and :func:`catalogue_rejects` of the requests lists it."""
    langs = F.posexplode(F.array(*[F.lit(lang) for lang in dims.LANGUAGES])).alias("lang_order", "language")
    r = requests.join(dims.subject_codes(spark), "subject").select("*", langs)   # each row in both languages
    folder = F.concat_ws("_", "code", "subject")
    stem = F.concat_ws("_", "code", "subject")
    return r.select(
        "subject", "code", "year", "language", "lang_order",
        F.concat_ws("/", F.lit("data"), folder,
                    F.concat(stem, F.lit("_test_"), F.col("year"), F.lit("_"), F.col("language"), F.lit(".pdf"))).alias("test_path"),
        F.concat_ws("/", F.lit("data"), folder,
                    F.concat(stem, F.lit("_consult_"), F.col("year"), F.lit(".pdf"))).alias("consult_path"))


def exam_catalogue(spark: SparkSession, requests: DataFrame) -> DataFrame:
    """The ``exam_docs`` table for ``(subject, year)`` requests: both test
    documents (one per language) and the shared consult document, with the
    file path as ``doc_id``.  Layout tables keyed by path plug straight into
    :func:`lectern.build.build_records`."""
    docs = exam_documents(spark, requests)
    tests = docs.select(F.col("test_path").alias("doc_id"), "subject", "year", "language",
                        F.lit("test").alias("kind"))
    consults = docs.where(F.col("lang_order") == 0).select(
        F.col("consult_path").alias("doc_id"), "subject", "year",
        F.lit(None).cast("string").alias("language"), F.lit("consult").alias("kind"))
    return tests.unionByName(consults)


def catalogue_rejects(spark: SparkSession, requests: DataFrame) -> DataFrame:
    """V1/V5: rows of ``(subject, language, year)`` requests that are invalid,
    with the message; the subject is checked before the language."""
    codes = dims.subject_codes(spark).select("subject", F.lit(True).alias("_known_s"))
    langs = dims.letter_examples(spark).select("language", F.lit(True).alias("_known_l"))
    r = requests.join(codes, "subject", "left").join(langs, "language", "left")
    msg = (F.when(F.col("_known_s").isNull(), F.format_string(dims.MSG_BAD_SUBJECT.replace("{}", "%s"), "subject"))
           .when(F.col("_known_l").isNull(), F.format_string(dims.MSG_BAD_LANGUAGE.replace("{}", "%s"), "language")))
    return r.where(msg.isNotNull()).select(*requests.columns, msg.alias("error"))


def raise_on_rejects(rejects: DataFrame) -> None:
    """Strict mode: fail with one of the messages, like the source does; takes
    the rejects of the catalogue (``error``) or a problem report (``problem``)."""
    column = "error" if "error" in rejects.columns else "problem"
    first = rejects.select(column).limit(1).collect()
    if first:
        raise ValueError(first[0][0])


def parse_document_path(path: Column) -> Column:
    """S6 inverse: subject, year, language, kind from a document path."""
    pat = r"(\d{2})_([a-z]{3})_(test|consult)_(\d{4})(?:_([a-z]+))?\.pdf$"
    return F.struct(F.regexp_extract(path, pat, 1).alias("code"),
                    F.regexp_extract(path, pat, 2).alias("subject"),
                    F.regexp_extract(path, pat, 3).alias("kind"),
                    F.regexp_extract(path, pat, 4).alias("year"),
                    F.nullif(F.regexp_extract(path, pat, 5), F.lit("")).alias("language"))


# -------------------------------------------------------------------- records

def translate_answers(spark: SparkSession, df: DataFrame, answer: str = "answer",
                      language: str = "language", out: str = "target") -> DataFrame:
    """Belarusian answers through the dictionary, others unchanged."""
    t = dims.answer_translations(spark).withColumnRenamed("answer", "_a").withColumnRenamed("language", "_l")
    j = df.join(t, (F.col(language) == F.col("_l")) & (F.col(answer) == F.col("_a")), "left")
    return j.withColumn(out, F.coalesce("translated", answer)).drop("_a", "_l", "translated")


def image_arrays(images: DataFrame, keys: list[str]) -> DataFrame:
    """J2, first half: the images of each question as an ordered array, so the
    join to questions is one-to-one and no question row is multiplied."""
    return images.groupBy(*keys).agg(F.array_sort(F.collect_list(
        F.struct("page_no", "img_no", "image_url"))).alias("images"))


def text_part(text) -> Column:
    """A ``{"type": "text", "text": ...}`` content part."""
    return F.struct(F.lit("text").alias("type"), text.alias("text"), F.lit(None).cast("string").alias("image"))


def image_part(url) -> Column:
    """A ``{"type": "image", "image": ...}`` content part."""
    return F.struct(F.lit("image").alias("type"), F.lit(None).cast("string").alias("text"), url.alias("image"))


def record_columns(system_text: Column, question_text: Column, images: Column | None, target: Column,
                   record_id: Column, comments: Column, subject: Column, year: Column, language: Column,
                   section_lat: Column, canary: str) -> list[Column]:
    """The four top-level record columns."""
    user = F.array(text_part(question_text))
    if images is not None:
        user = F.concat(user, F.coalesce(F.transform(images, lambda i: image_part(i["image_url"])),
                                         F.array().cast("array<struct<type:string,text:string,image:string>>")))
    messages = F.array(
        F.struct(F.lit("system").alias("role"), F.array(text_part(system_text)).alias("content")),
        F.struct(F.lit("user").alias("role"), user.alias("content")))
    points = F.when(section_lat == "A", F.lit(1)).otherwise(F.lit(2))          # P5
    metadata = F.struct(comments.alias("comments"), subject.alias("subject"), year.alias("year"),
                        language.alias("language"), section_lat.alias("section"),
                        points.alias("points"), F.lit(canary).alias("canary"))  # P8
    return [messages.alias("input"), target.alias("target"), record_id.alias("id"), metadata.alias("metadata")]


def assemble_records(spark: SparkSession, exams: DataFrame, questions: DataFrame, section_info: DataFrame,
                     answers: DataFrame, images: DataFrame | None, canary: str,
                     answer_keys: tuple[str, ...] = ("subject", "year", "question_id"),
                     image_keys: tuple[str, ...] = ("subject", "year", "question_id")) -> DataFrame:
    """J1 + J2 + P1-P9 over a whole corpus.

    ``exams``: doc_id, subject, year, language, and optionally ``times``, how
    often each record is given (R28).  ``questions``: doc_id, section,
    question_id, pos, text.  ``section_info``: doc_id, section, general_info.
    ``answers``: answer_keys + answer, comment (one consult per subject and
    year serves both languages).  ``images``: image_keys + page_no, img_no,
    image_url.  Questions without an answer are left out here and listed by
    :func:`validation_report`, exams of an unknown subject or language by
    :func:`catalogue_rejects`.  Output: the record columns plus ordering
    columns (doc_id, lang_order, section_order, pos).
    """
    q = (shuffled(questions).join(exams, "doc_id")
         .join(dims.subject_codes(spark), "subject"))                                  # P1
    q = (shuffled(q).join(section_info, ["doc_id", "section"], "left")
         .join(dims.letter_examples(spark), "language")                                # V5
         .join(dims.languages(spark), "language"))
    q = shuffled(q).join(answers, list(answer_keys))                                   # J1
    q = translate_answers(spark, q)                                                    # P4
    if images is not None:
        q = shuffled(q).join(image_arrays(images, list(image_keys)), list(image_keys), "left")  # J2
    sec = dims.section_letters(spark)
    q = q.join(sec, "section", "left")
    section_lat = F.coalesce(F.col("section_lat"), F.col("section"))                   # P2
    qid_lat = F.concat(section_lat, F.expr("substring(question_id, 2)"))                # P3
    rid = F.concat_ws("-", "code", "subject", "year", "language", qid_lat)              # P6
    system = F.concat(F.coalesce("general_info", F.lit("")), F.lit("\n"), F.col("letters"))  # P7
    cols = record_columns(system, F.col("text"), F.col("images") if images is not None else None,
                          F.col("target"), rid, F.col("comment"), F.col("subject"), F.col("year"),
                          F.col("language"), section_lat, canary)
    order = ["doc_id", "lang_order", F.coalesce("section_order", F.lit(99)).alias("section_order"), "pos"]
    if "times" in exams.columns:
        return (q.select(*cols, *order, F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy"))
                .drop("copy"))
    return q.select(*cols, *order)


def in_reference_order(records: DataFrame) -> DataFrame:
    """O3: exam by exam (subject, year), then language (rus before bel), then
    section, then question position.  A distributed sort; used only when the
    output order matters (writing the data set)."""
    keys = ["lang_order", "doc_id", "section_order", "pos"]
    if "metadata" in records.columns:
        keys = [F.col("metadata.subject"), F.col("metadata.year")] + keys
    return records.orderBy(*keys)


def sample_columns(records: DataFrame) -> DataFrame:
    """P10: keep what the evaluation reads."""
    return records.select("input", "target", "id", "metadata")


# ----------------------------------------------------------------- validation

def validation_report(exams: DataFrame, questions: DataFrame, answers: DataFrame,
                      images: DataFrame | None,
                      answer_keys: tuple[str, ...] = ("subject", "year", "question_id"),
                      image_exam_keys: tuple[str, ...] = ("subject", "year")) -> DataFrame:
    """V2 + V3: one row per problem: ``(doc_id, question_id, problem)``.

    * ``no answer``: a question whose key has no answer row (anti join);
    * ``no questions`` / ``no answers`` / ``no images``: an exam with none.
    """
    q = shuffled(questions).join(exams, "doc_id")
    exam_keys = [k for k in answer_keys if k != "question_id"]
    none = F.lit(None).cast("string").alias("question_id")
    missing = (shuffled(q).join(answers.select(*answer_keys).distinct(), list(answer_keys), "left_anti")
               .select("doc_id", "question_id", F.lit("no answer").alias("problem")))
    probs = [missing,
             shuffled(exams).join(questions.select("doc_id").distinct(), "doc_id", "left_anti")
             .select("doc_id", none, F.lit("no questions").alias("problem")),
             shuffled(exams).join(answers.select(*exam_keys).distinct(), exam_keys, "left_anti")
             .select("doc_id", none, F.lit("no answers").alias("problem"))]
    if images is not None:
        probs.append(shuffled(exams).join(images.select(*image_exam_keys).distinct(), list(image_exam_keys), "left_anti")
                     .select("doc_id", none, F.lit("no images").alias("problem")))
    out = probs[0]
    for p in probs[1:]:
        out = out.unionByName(p)
    return out
