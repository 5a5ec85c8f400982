"""Registered queries for scoring, with oracles.

documents ⋈ labels: the document text is the completion of record
``doc-<doc_id>``; its targets are a decoy and the upper-cased last five
characters of the stripped text; points = 1 + quality.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lectern.functions.score import LOCATIONS
from lectern.functions.text import strip
from lectern.operators import scoring as SC
from lectern.plans import oracle_text as O
from lectern.plans.tables import table

DECOY = "no such answer"


def _inputs(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    lab = table(spark, sf_dir, "labels")
    tail = F.upper(F.expr("substring(text, -5, 5)"))
    records = lab.join(d.select("doc_id", "lang", "source", strip("text").alias("text")), "doc_id").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("id"), "doc_id", "lang", "source",
        F.array(F.lit(DECOY), tail).alias("targets"), (F.col("quality") + 1).alias("points"))
    completions = d.select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("id"),
                           F.lit("m").alias("model"), F.col("text").alias("completion"))
    return records, completions


def q_score_answers(spark: SparkSession, sf_dir: str):
    """All four locations ignoring case, and "end" with case, from one join."""
    records, completions = _inputs(spark, sf_dir)
    variants = [(loc, loc, True) for loc in LOCATIONS] + [("end_case", "end", False)]
    return SC.score_variants(records, completions, variants).select(
        "doc_id", F.col("variant").alias("location"), "value", "answer")


def _score_sql(loc: str, ignore_case: bool) -> str:
    def norm(x):
        return f"lower({O.strip(x)})" if ignore_case else O.strip(x)
    v = norm("d.text")
    t_of = {"begin": "starts_with({v}, {t})", "end": "suffix({v}, {t})", "any": "contains({v}, {t})",
            "exact": "{v} = {t}"}[loc]
    dec = norm(O.q(DECOY))
    tail = norm(O.upper("substr(" + O.strip("d.text") + ", -5, 5)"))
    m_dec = t_of.format(v=v, t=dec)
    m_tail = t_of.format(v=v, t=tail)
    chosen = f"CASE WHEN {m_dec} THEN {dec} ELSE {tail} END"
    ans = {"begin": f"substr({v}, 1, length({chosen}))",
           "end": f"CASE WHEN length({chosen}) = 0 THEN '' ELSE substr({v}, greatest(length({v}) - length({chosen}) + 1, 1), length({chosen})) END",
           "any": f"CASE WHEN contains({v}, {chosen}) THEN {chosen} ELSE {v} END",
           "exact": v}[loc]
    name = loc if ignore_case else "end_case"
    return (f"SELECT d.doc_id, '{name}' AS location, CASE WHEN {m_dec} OR {m_tail} THEN l.quality + 1 ELSE 0 END AS value, "
            f"{ans} AS answer FROM labels l JOIN documents d ON d.doc_id = l.doc_id")


def sql_score_answers() -> str:
    return " UNION ALL ".join([_score_sql(loc, True) for loc in LOCATIONS] + [_score_sql("end", False)])


def q_weighted_accuracy(spark: SparkSession, sf_dir: str):
    """A7 per language and overall (lang = 'all'), in one aggregation."""
    records, completions = _inputs(spark, sf_dir)
    s = SC.score(records, completions)
    out = s.rollup("lang").agg(F.grouping("lang").alias("_all"), F.count(F.lit(1)).alias("questions"),
                               SC.weighted_accuracy().alias("weighted_accuracy"))
    return out.select(F.when(F.col("_all") == 1, F.lit("all")).otherwise(F.col("lang")).alias("lang"),
                      "questions", "weighted_accuracy")


def q_result_table(spark: SparkSession, sf_dir: str):
    """A8 by language and source (source stands for the model)."""
    records, completions = _inputs(spark, sf_dir)
    return SC.result_table(SC.score(records, completions), ["lang", "source"])


def _scored_sql() -> str:
    return f"SELECT d.lang, d.source, s.value, l.quality + 1 AS points FROM ({_score_sql('end', True)}) s " \
           "JOIN labels l USING (doc_id) JOIN documents d USING (doc_id)"


def sql_weighted_accuracy() -> str:
    return (f"WITH s AS ({_scored_sql()}) "
            "SELECT lang, count(*) AS questions, CAST(sum(value) AS DOUBLE) / CAST(sum(points) AS DOUBLE) AS weighted_accuracy "
            "FROM s GROUP BY lang UNION ALL "
            "SELECT 'all', count(*), CAST(sum(value) AS DOUBLE) / CAST(sum(points) AS DOUBLE) FROM s")


def sql_result_table() -> str:
    return (f"WITH s AS ({_scored_sql()}) "
            "SELECT lang, source, count(*) AS questions, "
            "CAST(sum(value) AS DOUBLE) / CAST(sum(points) AS DOUBLE) AS weighted_accuracy FROM s GROUP BY lang, source")


MODELS = ["m", "n", "absent"]


def q_score_missing(spark: SparkSession, sf_dir: str):
    """J10 over records x models: "n" answers even documents only, "absent" none; what is missing scores 0."""
    records, completions = _inputs(spark, sf_dir)
    number = F.substring_index("id", "-", -1).cast("bigint")
    both = completions.unionByName(completions.where(number % 2 == 0).withColumn("model", F.lit("n")))
    scores = SC.score(records, both, models=MODELS)
    return scores.groupBy("model").agg(
        F.count(F.lit(1)).alias("questions"), F.sum("value").cast("bigint").alias("value"),
        F.sum(F.when(F.col("explanation").isNull(), 1).otherwise(0)).cast("bigint").alias("missing"),
        SC.weighted_accuracy().alias("weighted_accuracy"))


def sql_score_missing() -> str:
    return f"""
WITH s AS ({_score_sql("end", True)}),
r AS (SELECT d.doc_id, l.quality + 1 AS points, unnest({MODELS!r}) AS model FROM labels l JOIN documents d ON d.doc_id = l.doc_id),
j AS (SELECT r.model, r.points, CASE WHEN r.model = 'm' OR (r.model = 'n' AND r.doc_id % 2 = 0) THEN s.value END AS value
      FROM r JOIN s ON r.doc_id = s.doc_id)
SELECT model, count(*) AS questions, sum(coalesce(value, 0))::BIGINT AS value, count(*) FILTER (value IS NULL)::BIGINT AS missing,
       sum(coalesce(value, 0))::DOUBLE / sum(points) AS weighted_accuracy FROM j GROUP BY model"""
