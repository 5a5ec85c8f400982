"""Whole exams through the catalogue, from requests to a scored data set.

``customer`` gives the requests: subject by ``c_custkey % 15``, the key as the
year; ``exam_catalogue`` makes both test documents and the consult document of
each (J7, S6, U1).  A test document has two pages (two languages, two header
words), two items in section А and one in В, and four tables: the first goes into
А1, the second twice into А2, the third nowhere, the fourth into the first one
inside А1.  The fourth is excluded for even keys (P14), and for keys divisible by
three two ordered fixes change the first across its cells (J8).  The Russian
document has an image with a text block near it (J4).

``exam_dataset`` writes the records with a batch id, appends the same batch again
(which adds nothing), reads them back, and scores them against completions;
``exam_reports`` gives the unplaced tables, the image table and the problems.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern import dims
from lectern.build import BuildResult, ExamInputs, Profiles, build_records, write_records
from lectern.functions import text as T
from lectern.operators.records import exam_catalogue
from lectern.operators.scoring import evaluate, prompts
from lectern.plans.tables import sql_str, table
from lectern.session import ensure_checkpoint_dir
from lectern.sources.readers import read_records

SUBJECTS = [s for s, _ in dims.SUBJECT_CODES]
CANARY = "lectern"


def _exams(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("seg"))
    subject = F.element_at(F.array(*[F.lit(s) for s in SUBJECTS]), (F.col("k") % len(SUBJECTS) + 1).cast("int"))
    return c.select("k", "seg", subject.alias("subject"), F.col("k").cast("string").alias("year"))


def _cells(rows: list[list[str]]) -> F.Column:
    """Cells of one table; ``#`` stands for the key."""
    return F.array(*[F.struct(F.lit(r).alias("row_no"), F.lit(c).alias("col_no"), F.replace(F.lit(x), F.lit("#"), F.col("year")).alias("text"))
                     for r, row in enumerate(rows) for c, x in enumerate(row)])


TABLES = [[["Head#", "x"], ["y", "Tail#"]], [["Alpha"], ["Omega"]], [["nowhere"], ["z"]], [["Head#"], ["Tail#"]]]
FIXES = [(1, 1, "x\ny", "u\nv"), (1, 2, "u", "w")]


def _built(spark: SparkSession, sf_dir: str) -> BuildResult:
    e = _exams(spark, sf_dir)
    docs = exam_catalogue(spark, e.select("subject", "year"))
    d = docs.join(e, ["subject", "year"])
    test, consult = d.where("kind = 'test'"), d.where("kind = 'consult'")
    head = F.when(F.col("language") == "rus", "Часть").otherwise("Частка")
    first = F.concat(head, F.lit(" А\n"), F.col("seg"), F.lit(" info\nА1. Head"), F.col("year"), F.lit(" body of table Tail"), F.col("year"),
                     F.lit(" end\nА2. Alpha one Omega and Alpha one Omega\n"))
    second = F.concat(head, F.lit(" В\nВ1. Third "), F.col("seg"), F.lit("\nitem"))
    pages = test.select("doc_id", F.posexplode(F.array(first, second)).alias("page_no", "text"))
    cells = test.select("doc_id", "year", F.posexplode(F.array(*[_cells(t) for t in TABLES])).alias("t", "cells")) \
        .select("doc_id", (F.col("t") + 1).alias("table_no"), F.inline("cells"))
    answers = F.array(*[F.struct(F.lit(x).alias("x0"), t.alias("text")) for x, t in (
        (141.0, F.concat(F.lit("А1. q\nОтвет: "), (F.col("k") % 5 + 1).cast("string"))),
        (410.0, F.concat(F.lit("note "), F.col("year"))),
        (141.0, F.lit("А2. q\nОтвет: политика")),
        (141.0, F.concat(F.lit("В1. q\nОтвет: "), F.lower("seg"))))])
    blocks = consult.select("doc_id", F.lit(1).alias("page_no"), F.posexplode(answers).alias("block_no", "b")).select(
        "doc_id", "page_no", "block_no", "b.x0", (F.col("block_no") * 20.0).alias("y0"), (F.col("b.x0") + 80).alias("x1"),
        (F.col("block_no") * 20.0 + 10).alias("y1"), "b.text")
    around = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("x0", "y0", "x1", "y1"), box)], t.alias("text")) for box, t in (
        ((350.0, 310.0, 380.0, 320.0), F.concat(F.lit("near "), F.col("year"))), ((10.0, 10.0, 20.0, 20.0), F.lit("far")),
        ((325.0, 275.0, 340.0, 285.0), F.lit("above")))])
    rus = test.where("language = 'rus'")
    spans = rus.select("doc_id", F.lit(0).alias("page_no"), F.posexplode(around).alias("block_no", "b")).select(
        "doc_id", "page_no", "block_no", "b.x0", "b.y0", "b.x1", "b.y1", "b.text")
    images = rus.select("doc_id", F.lit(0).alias("page_no"), F.lit(1).alias("img_no"), F.lit("png").alias("format"),
                        F.encode(F.concat(F.lit("image "), F.col("year")), "utf-8").alias("content"),
                        *[F.lit(v).alias(n) for n, v in zip(("x0", "y0", "x1", "y1"), (340.0, 290.0, 400.0, 340.0))])
    fixes = F.array(*[F.struct(F.lit(t).alias("table_no"), F.lit(s).alias("seq"), F.lit(a).alias("from"), F.lit(b).alias("to"))
                      for t, s, a, b in FIXES])
    profiles = Profiles(position_map=e.select("subject", "year", F.lit(1).alias("position"), F.lit("А1").alias("question_id")),
                        excluded_tables=e.where("k % 2 = 0").select("subject", "year", F.lit(4).alias("table_no")),
                        text_fixes=e.where("k % 3 = 0").select("subject", "year", F.inline(fixes)))
    return build_records(spark, ExamInputs(docs, pages, blocks.unionByName(spans), images, cells), CANARY, profiles)


def q_exam_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored records in file order with their prompts, and their scores."""
    result = _built(spark, sf_dir)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lectern-exams-{uuid.uuid4().hex}"
    write_records(spark, result, path, batch_id="exams")
    write_records(spark, result, path, append=True, batch_id="exams")
    back = read_records(spark, path)
    # a model that answers the exams of odd keys
    odd = back.where(F.col("metadata.year").cast("long") % 2 == 1)
    completions = odd.select("id", F.lit("m").alias("model"), F.concat(F.lit("It is "), F.lower("target")).alias("completion"))
    scores, accuracy = evaluate(back, completions, models=["m"])
    order = Window.partitionBy("subject", "year").orderBy("file", "start", "row")
    placed = back.select("id", F.col("metadata.subject").alias("subject"), F.col("metadata.year").alias("year"),
                         F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                         F.monotonically_increasing_id().alias("row")).withColumn("position", F.row_number().over(order).cast("long"))
    return (prompts(back).join(placed.select("id", "subject", "year", "position"), "id").join(scores.select("id", "value"), "id")
            .join(accuracy, ["subject", "year"])
            .select("id", "target", "prompt", F.array_join("images", "|").alias("images"), "position",
                    F.col("value").cast("double").alias("value"), F.col("weighted_accuracy").cast("double").alias("weighted_accuracy")))


def q_exam_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unplaced tables (V4), images with their near text (J3, J4, J6), problems (V1-V6)."""
    r = _built(spark, sf_dir)
    none = F.lit(None).cast("string")
    rows = [r.unplaced_tables.select(F.lit("unplaced").alias("kind"), "doc_id", F.col("table_no").cast("string").alias("item"), none.alias("detail")),
            r.images.select(F.lit("image"), "doc_id", "filename", F.concat_ws("|", "question_id", "size", "nearby_text")),
            r.problems.select(F.lit("problem"), "doc_id", "question_id", "problem")]
    out = rows[0]
    for x in rows[1:]:
        out = out.union(x)
    return out


def _sql_exams() -> str:
    subject = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(SUBJECTS))
    code = " ".join(f"WHEN {i} THEN '{c}'" for i, (_, c) in enumerate(dims.SUBJECT_CODES))
    return f"""e AS (SELECT c_custkey AS k, c_mktsegment AS seg, c_custkey::VARCHAR AS year,
                 CASE c_custkey % {len(SUBJECTS)} {subject} END AS subject, CASE c_custkey % {len(SUBJECTS)} {code} END AS code FROM customer),
d AS (SELECT *, unnest(['rus', 'bel']) AS language FROM e),
p AS (SELECT *, 'data/' || code || '_' || subject || '/' || code || '_' || subject || '_test_' || year || '_' || language || '.pdf' AS doc_id FROM d)"""


def sql_exam_dataset() -> str:
    m1 = ("'| Head' || year || CASE WHEN k % 3 = 0 THEN ' | w |' ELSE ' | x |' END || chr(10) || '| --- | --- |' || chr(10) || "
          "CASE WHEN k % 3 = 0 THEN '| v | Tail' ELSE '| y | Tail' END || year || ' |' || chr(10)")
    m4 = "'| Head' || year || ' |' || chr(10) || '| --- |' || chr(10) || '| Tail' || year || ' |' || chr(10)"
    m2 = "'| Alpha |' || chr(10) || '| --- |' || chr(10) || '| Omega |' || chr(10)"
    a1 = f"'А1. ' || CASE WHEN k % 2 = 0 THEN {m1} ELSE '| ' || {m4} || ' |' || chr(10) END || ' end'"
    a2 = f"'А2. ' || {m2} || ' and ' || {m2}"
    uri = "'data:image/png;base64,' || to_base64(encode('image ' || year))"
    return f"""
WITH {_sql_exams()},
q AS (SELECT *, unnest([
        {{'n': 'A1', 'at': 1, 'target': (k % 5 + 1)::VARCHAR, 'text': {a1}, 'images': {uri}}},
        {{'n': 'A2', 'at': 2, 'target': CASE language WHEN 'bel' THEN 'ПАЛІТЫКА' ELSE 'ПОЛИТИКА' END, 'text': {a2}, 'images': ''}},
        {{'n': 'B1', 'at': 3, 'target': upper(seg), 'text': 'В1. Third ' || seg || ' item', 'images': ''}}]) AS x FROM p)
SELECT code || '-' || subject || '-' || year || '-' || language || '-' || x.n AS id, x.target AS target,
       replace({sql_str(T.COT_TEMPLATE)}, '{{prompt}}', x.text) AS prompt, x.images AS images,
       (x.at + CASE language WHEN 'rus' THEN 0 ELSE 3 END)::BIGINT AS position,
       CASE WHEN k % 2 = 1 THEN CASE x.n WHEN 'B1' THEN 2.0 ELSE 1.0 END ELSE 0.0 END::DOUBLE AS value,
       (k % 2)::DOUBLE AS weighted_accuracy
FROM q"""


def sql_exam_reports() -> str:
    return f"""
WITH {_sql_exams()}
SELECT 'unplaced' AS kind, doc_id, '3' AS item, NULL::VARCHAR AS detail FROM p
UNION ALL SELECT 'image', doc_id, 'page0_img1.png', 'А1|' || length('image ' || year) || '|above' || chr(10) || 'near ' || year
FROM p WHERE language = 'rus'"""
