"""Quality scores from preference pairs, Bradley-Terry (operator 4).

A document's strength is a linear score of features of its text.  Of two
documents, the one labelled better is preferred with probability
``sigmoid(s_i - s_j)``: logistic loss on feature *differences*, without a
constant, minimised by Newton steps.  The threshold is the quantile of the
scores at the share of low-quality labels, and the reported score is
``sigmoid(s - threshold + logit(CUT))``, so a document at the threshold has
score ``CUT``.

Every labelled row that is not held out is learned from.  Rows are numbered
within their class, and each low-quality row is paired with ``PAIRS_EACH`` rows
of the other class in turn, never all pairs; the pairs meet in a join on these
numbers and are written once.  A Newton step sums gradient and Hessian over the
pairs in the tasks, and the threshold is the exact quantile of all their scores,
found by counting in ever narrower ranges, so the driver sees sums and counts
only.  Features and scores are built-in expressions over whole texts; labels
meet the features, never the texts, so no text crosses a shuffle.

Edge cases: NULL and empty texts have all features 0 words and are scored like
any other; NULL ids are not held out; labels other than 0 and 1 and NULL
labels are ignored; repeated rows each count; without labels of both classes
all scores are ``CUT``; label, language, source and id are never features;
input columns beside the named ones are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import words, written
from lectern.llm.quality_rules import bind

BUCKET_ROWS = 100_000       # labelled rows that one task numbers
BINS, FEW = 4_096, 10_000   # ranges of one counting pass; scores that are few enough to be sorted
PAIRS_EACH = 8
RIDGE = 1e-3
STEPS = 25
CUT = 0.3
FEATURES = ("symbols", "capitals", "marks", "variety", "long_words", "short_words", "dup_lines", "digits", "doubled", "size")


def features(text_col: Column) -> Column:
    """array<double> of ``FEATURES`` of the whole text."""
    text = F.coalesce(text_col, F.lit(""))
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    share = lambda cls: (F.length(text) - F.length(F.regexp_replace(text, cls, ""))) / chars
    lines = F.filter(F.split(text, "\n"), lambda s: s != "")

    def by_words(w: Column) -> Column:
        n = F.greatest(F.size(w), F.lit(1)).cast("double")
        mean = F.length(F.array_join(w, "")) / n
        doubled = F.size(F.filter(w, lambda x, i: x == F.get(w, i - 1))) / n
        return F.array(F.least(F.size(F.array_distinct(w)) / n, F.lit(1.0)), F.greatest(mean - 5.5, F.lit(0.0)),
                       F.greatest(4.5 - mean, F.lit(0.0)), doubled, F.log1p(F.size(w).cast("double")))
    per_word = lambda b: [b[i] for i in range(5)]
    return bind(bind(words(text), by_words), lambda b: F.array(
        F.sqrt(share("[#*$%&|<>]+")), share("[\\p{Lu}]+"), F.sqrt(share("[!?]+")), per_word(b)[0], per_word(b)[1],
        per_word(b)[2], bind(lines, lambda s: (F.size(s) - F.size(F.array_distinct(s))) / F.greatest(F.size(s), F.lit(1))),
        F.sqrt(share("[0-9]+")), per_word(b)[3], per_word(b)[4]))


NAMES = [f"f{i}" for i in range(len(FEATURES))]


def numbered(rows: DataFrame) -> DataFrame:
    """``_i``: the row's number within its label, from 0, in an order that the rows alone give."""
    n = rows.count()
    rows = rows.withColumn("_b", F.pmod(F.xxhash64("_id"), F.lit(max(1, math.ceil(n / BUCKET_ROWS)))))
    sizes = rows.groupBy("_label", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_label").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_label", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    at = F.row_number().over(Window.partitionBy("_label", "_b").orderBy("_id", *NAMES)) - 1
    return rows.withColumn("_at", at).join(sizes, ["_label", "_b"]).select("_label", *NAMES, (F.col("_before") + F.col("_at")).alias("_i"))


def stride(n_good: int) -> int:
    """Step between the good rows of one turn and the next, no divisor of their number."""
    return 7919 if n_good % 7919 else 7907


def pairs(good: np.ndarray, bad: np.ndarray, each: int = PAIRS_EACH) -> np.ndarray:
    """Feature differences good - bad of rows at hand; every bad row meets ``each`` good rows, taken in turn."""
    k = np.arange(len(bad) * each)
    return good[(k * stride(len(good))) % len(good)] - bad[k % len(bad)]


def paired(rows: DataFrame, n_good: int, n_bad: int, each: int = PAIRS_EACH) -> DataFrame:
    """The differences of :func:`pairs` for numbered rows, by a join."""
    good = rows.where("_label = 1").select(F.col("_i").alias("_g"), *[F.col(f).alias(f"g_{f}") for f in NAMES])
    bad = rows.where("_label = 0").select("*", F.explode(F.sequence(F.lit(0), F.lit(each - 1))).alias("_turn"))
    bad = bad.withColumn("_g", (F.col("_i") + F.col("_turn").cast("long") * n_bad) * stride(n_good) % n_good)
    return bad.join(good, "_g").select(*[(F.col(f"g_{f}") - F.col(f)).alias(f) for f in NAMES])


def newton_sums(differences: DataFrame, scale: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and Hessian of the logistic loss, summed over all differences."""
    k = len(w)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grad, hess = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            d = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1) / scale
            p = 1 / (1 + np.exp(np.clip(d @ w, -35, 35)))       # chance given to the wrong order
            grad += d.T @ p
            hess += (d * (p * (1 - p))[:, None]).T @ d
        yield pa.RecordBatch.from_arrays([pa.array([[*grad, *hess.ravel()]], pa.list_(pa.float64()))], ["s"])
    rows = np.array([r["s"] for r in differences.mapInArrow(add, "s array<double>").collect()])
    total = np.array([math.fsum(c) for c in rows.T]) if len(rows) else np.zeros(k + k * k)
    return total[:k], total[k:].reshape(k, k)


def order_statistic(scores: DataFrame, at: int, n: int) -> tuple[float, float]:
    """Values number ``at`` and ``at + 1`` (from 0; the last counts twice) of the n values of column ``s``."""
    below, rest = 0, scores
    while True:
        lo, hi, size = rest.agg(F.min("s"), F.max("s"), F.count("s")).first()
        if lo == hi or size <= FEW:
            break
        bin_ = F.least(F.floor((F.col("s") - lo) / F.lit(hi - lo) * BINS), F.lit(BINS - 1))
        for b, m in sorted((r["b"], r["n"]) for r in rest.groupBy(bin_.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()):
            if below + m > at:
                rest = rest.where(bin_ == b)
                break
            below += m
        if m == size:  # the doubles lie too close for the bins to part them
            break
    if lo == hi:
        value = lo
    elif size <= FEW:
        value = sorted(r["s"] for r in rest.collect())[at - below]
    else:
        value = rest.agg(F.percentile("s", (at - below) / max(size - 1, 1))).first()[0]
    upto, after = scores.agg(F.sum((F.col("s") <= value).cast("long")), F.min(F.when(F.col("s") > value, F.col("s")))).first()
    return value, value if upto > at + 1 or after is None else after


def linear(weights: list[float]) -> Column:
    return sum((F.col(f) * F.lit(w) for f, w in zip(NAMES[1:], weights[1:])), F.col(NAMES[0]) * F.lit(weights[0]))


def fit(rows: DataFrame) -> dict:
    """Weights on raw features and the threshold, from all of ``rows`` (``_id``, ``_label`` 0 or 1, ``NAMES``)."""
    count = {r["_label"]: r["n"] for r in rows.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(count) < 2:
        return {"weights": [0.0] * len(FEATURES), "threshold": 0.0}
    scale = np.array(rows.agg(*[F.stddev_pop(f) for f in NAMES]).first()) + 1e-6
    d = written(paired(written(numbered(rows), "rank-numbered"), count[1], count[0]), "rank-pairs")
    n, w = d.count(), np.zeros(len(NAMES))
    for _ in range(STEPS):
        grad, hess = newton_sums(d, scale, w)
        step = np.linalg.solve(hess / n + RIDGE * np.eye(len(w)), grad / n - RIDGE * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    w = [float(f"{x:.10g}") for x in w / scale]     # the order in which tasks add does not show
    total = count[0] + count[1]
    place = (total - 1) * (count[0] / total)
    low, high = order_statistic(rows.select(linear(w).alias("s")), math.floor(place), total)
    return {"weights": w, "threshold": low + (high - low) * (place - math.floor(place))}


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def featured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id`` and ``NAMES`` of every row, written once: no later step reads or moves a text."""
    rows = docs.select(F.col(id_col).alias("_id"), features(F.col(text_col)).alias("f"))
    return written(rows.select("_id", *[F.col("f")[i].alias(f) for i, f in enumerate(NAMES)]), "rank-features")


def train_featured(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> dict:
    """Model from all labelled rows of :func:`featured` that are not held out."""
    usable = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
    usable = usable.where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & ~held_out(F.col("_id")))
    return fit(written(rows.join(usable, "_id").select("_id", "_label", *NAMES), "rank-rows"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> dict:
    """Model from all labelled rows that are not held out."""
    return train_featured(featured(docs, id_col, text_col), labels, id_col, label_col)


def score_featured(rows: DataFrame, model: dict, cut: float = CUT) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of :func:`featured`."""
    shift = math.log(cut / (1 - cut)) - model["threshold"]
    s = F.lit(shift)
    for f, w in zip(NAMES, model["weights"]):
        s = s + F.col(f) * F.lit(w)
    d = rows.select(F.col("_id").alias("doc_id"), s.alias("_s"))
    s = F.col("_s")
    d = d.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), (1 / (1 + F.exp(-s))).alias("score"))
    return d.withColumn("predicted", (F.col("score") >= cut).cast("int"))


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", cut: float = CUT) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    rows = docs.select(F.col(id_col).alias("_id"), features(F.col(text_col)).alias("f"))
    return score_featured(rows.select("_id", *[F.col("f")[i].alias(f) for i, f in enumerate(NAMES)]), model, cut)


def rank(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
         cut: float = CUT) -> DataFrame:
    """:func:`score` of every document by the model of :func:`train`, with each text read once."""
    rows = featured(docs, id_col, text_col)
    return score_featured(rows, train_featured(rows, labels, id_col, label_col), cut)
