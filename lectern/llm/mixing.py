"""Mixing sources to target weights (operator 3).

Tokens are summed per source; each source's target is its weight's share of
all tokens, stopped at ``max_repeat`` times its own size, the excess reshared
by weight.  ``rate = target / size`` is then the mean number of copies of each
document of the source: ``floor(rate)`` copies always, and one more when a
hash of the document id falls below the fraction.  Nothing is drawn at random
at run time, so reruns and recomputed tasks agree.

Edge cases: a NULL source is a source of its own, ordered last; NULL or blank
texts have size 0 and follow their source's rate; a source of size 0 has
target 0 and rate 0; rows with the same id get the same number of copies; an
empty table gives empty results.  Columns of the input are never renamed;
working columns use a private prefix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import unit_hash, words, written

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SEED = "mix-1"


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """(source, source_size, weight, target, rate) from rows (source, size).

    The grouping pre-aggregates, so a hot source costs one row per task.  The
    windows below run over one row per source.  A source is capped exactly
    when its cap per weight is below the level at which the remaining tokens
    would fill the remaining weights; in order of cap per weight that is a
    prefix, so one ordered pass gives what repeated resharing converges to.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    every = Window.partitionBy()
    fill = Window.orderBy("fill_at", F.asc_nulls_last("source"))
    t = (per.withColumn("weight", pick)
         .withColumn("cap", (F.col("source_size") * max_repeat).cast("double"))
         .withColumn("fill_at", F.col("cap") / F.col("weight"))
         .withColumn("total", F.sum("source_size").over(every).cast("double"))
         .withColumn("used", F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
         .withColumn("left_weight", F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing)))
         .withColumn("level", (F.col("total") - F.col("used")) / F.col("left_weight"))
         # the first source that the level does not fill to its cap fixes the level of all after it
         .withColumn("final", F.min(F.when(F.col("fill_at") >= F.col("level"),
                                           F.struct("fill_at", "level"))).over(every)["level"])
         .withColumn("target", F.least(F.col("cap"), F.col("final") * F.col("weight"))))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return t.select("source", "source_size", "weight", F.coalesce("target", F.lit(0.0)).alias("target"),
                    F.coalesce(rate, F.lit(0.0)).alias("rate"))


def copies(rate: Column, *keys: Column | str, seed: str = SEED) -> Column:
    """floor(rate) copies plus one when the hash of the keys is below the fraction."""
    whole = F.floor(rate)
    return (whole + F.when(unit_hash(*keys, seed=seed) < rate - whole, 1).otherwise(0)).cast("int")


def plan_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             size: Column | None = None, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate, copies.

    Only ids, sources and sizes move; the table of sources is written first, so
    it is broadcast when Spark's own size limit allows it and joined by
    shuffle, with skewed sources split, when not.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                    (F.size(words(F.col(text_col))) if size is None else size).cast("long").alias("size"))
    t = written(source_targets(d, weights, max_repeat), "mix-targets").alias("t")
    j = d.alias("d").join(t, F.col("d.source").eqNullSafe(F.col("t.source")), "left")
    return j.select("d.doc_id", "d.source", "d.size", "t.source_size", "t.target", "t.rate",
                    copies(F.col("t.rate"), "d.doc_id", seed=seed).alias("copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = SEED) -> DataFrame:
    """The mix itself: every document as often as it is taken, columns unchanged."""
    sizes = docs.select(F.col(source_col).alias("source"), F.size(words(F.col(text_col))).cast("long").alias("size"))
    t = written(source_targets(sizes, weights, max_repeat), "mix-targets")
    t = t.select(F.col("source").alias("_mix_source"), F.col("rate").alias("_mix_rate"))
    j = docs.join(t, docs[source_col].eqNullSafe(t["_mix_source"]), "left")
    n = copies(F.col("_mix_rate"), docs[id_col], seed=seed)
    return (j.withColumn("_mix_copy", F.explode(F.array_repeat(F.lit(1), n)))
            .select(*[docs[c] for c in docs.columns]))
