"""Quality rules with adaptive thresholds (operator 1), built-in functions only.

Four document measures (integers, see ``MEASURES``) are summarised per
(language, source) in a mergeable quantile sketch: counts per bucket, where a
bucket keeps the ``SKETCH_BITS`` leading bits of the value, so a quantile is
off by at most one part in 2**(SKETCH_BITS - 1).  Sketches merge by adding
counts, which is a plain aggregation with a map-side partial step: a hot
source costs one row per bucket and task, and the result does not depend on
the order of merging.  The merged quartiles give each group an upper and a
lower fence; documents are then joined with the fences of their group.  The same
sketch merges further, over the sources of a language and over all documents,
and every document is held against the fences of these two levels as well.

``kept`` goes by the group's own fences, whatever its size: a small source
unlike its language is judged by its own documents.  One to three documents,
which are their own quartiles, are all inside; ``kept_lang`` and ``kept_all``,
the verdicts of the language's and the whole table's fences, tell of them.

Edge cases: NULL or blank texts have no words and fail the base rule; NULL
languages and sources are groups of their own; repeated rows are judged alike,
each; an empty table gives an empty result; input columns beside the four named
ones are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import words, written

WINDOW = 8              # words of a window that counts as repeated text
MIN_WORDS = 20          # base rule
MAX_REPEAT_PCT = 30     # base rule: per cent of the words in repeated windows
SKETCH_BITS = 8         # leading bits a bucket keeps
SPREAD = 3              # fences lie this many interquartile ranges outside the quartiles
SYMBOLS = "[#*$%&|<>]+"

# measure: (integer value from the base columns, least distance of the fences from the quartiles)
MEASURES = {
    "symbols": (lambda: F.col("n_symbols") * 1000, 100),        # per 1,000 words
    "word_length": (lambda: F.col("word_chars") * 100, 100),    # hundredths of a character
    "dup_lines": (lambda: F.col("n_dup_lines") * 1000, 100),    # per 1,000 words
    "repeats": (lambda: F.col("n_repeat_words") * 1000, 300),   # per 1,000 words
}


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def _covered(windows: Column) -> Column:
    """Words covered by the windows whose hash occurs at least twice: sort
    (hash, position), keep the positions with an equal neighbour, and add up
    how far each kept window reaches beyond the one before it."""
    def sum_up(ranked: Column) -> Column:
        same = lambda p, q: F.coalesce(F.get(ranked, q)["h"] == p["h"], F.lit(False))
        kept = F.filter(ranked, lambda p, j: same(p, j - 1) | same(p, j + 1))
        starts = F.array_sort(F.transform(kept, lambda p: p["i"]))
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(starts, start, lambda a, i: F.struct(
            (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).cast("long").alias("n"), i.alias("last")))["n"]
    return bind(F.sort_array(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), sum_up)


def repeat_words(word_array: Column) -> Column:
    """Number of words inside ``WINDOW``-word windows that occur twice or more.
    Windows are compared by a 64-bit hash of their words' 64-bit hashes."""
    def from_hashes(h: Column) -> Column:
        spans = F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW),
                            lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))
        return bind(spans, lambda s: F.when(F.size(F.array_distinct(s)) == F.size(s), F.lit(0).cast("long"))
                    .otherwise(_covered(s)))
    return F.when(F.size(word_array) <= WINDOW, F.lit(0).cast("long")).otherwise(
        bind(F.transform(word_array, lambda w: F.xxhash64(w)), from_hashes))


def base_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    by_words = bind(words(F.col(text_col)), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeat_words(w).alias("n_repeat_words")))
    by_lines = bind(lines, lambda s: (F.size(s) - F.size(F.array_distinct(s))).cast("long"))
    d = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
                    by_words.alias("w"), by_lines.alias("n_dup_lines"),
                    (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"))
    return d.select("doc_id", "lang", "source", "w.n_words", "w.word_chars", "n_symbols", "n_dup_lines",
                    "w.n_repeat_words",
                    ((F.col("w.n_words") < MIN_WORDS)
                     | (F.col("w.n_repeat_words") * 100 > F.col("w.n_words") * MAX_REPEAT_PCT)).alias("base_failed"))


def measures(base: DataFrame) -> DataFrame:
    """The measures as integer columns; NULL where there are no words."""
    return base.select("*", *[F.floor(of() / F.when(F.col("n_words") > 0, F.col("n_words"))).cast("long")
                              .alias(f"m_{name}") for name, (of, _) in MEASURES.items()])


def bucket(value: Column) -> Column:
    """The value with all but its leading ``SKETCH_BITS`` bits cleared."""
    low = F.greatest(F.length(F.bin(value)) - SKETCH_BITS, F.lit(0))
    step = F.pow(F.lit(2.0), low).cast("long")
    return (F.floor(value / step) * step).cast("long")


def sketch(measured: DataFrame) -> DataFrame:
    """(lang, source, measure, bucket, n): the mergeable sketch of every group."""
    rows = measured.select("lang", "source", F.explode(F.create_map(
        *[x for name in MEASURES for x in (F.lit(name), F.col(f"m_{name}"))])).alias("measure", "value"))
    return (rows.where("value IS NOT NULL").groupBy("lang", "source", "measure", bucket(F.col("value")).alias("bucket"))
            .agg(F.count(F.lit(1)).alias("n")))


def merge_sketches(*sketches: DataFrame) -> DataFrame:
    """Sketches of several inputs (or days, or shards) as one."""
    out = sketches[0]
    for s in sketches[1:]:
        out = out.unionByName(s)
    return out.groupBy("lang", "source", "measure", "bucket").agg(F.sum("n").alias("n"))


def quartiles(sk: DataFrame, keys: list[str]) -> DataFrame:
    """keys, measure, docs, q1, q3 of the sketch merged over ``keys``: the
    least bucket whose cumulative count reaches a quarter (three quarters)."""
    merged = sk.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "measure")
    w = (merged.withColumn("upto", F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)))
         .withColumn("docs", F.sum("n").over(group)))
    at = lambda k: F.min(F.when(F.col("upto") * 4 >= F.col("docs") * k, F.col("bucket")))
    return w.groupBy(*keys, "measure").agg(F.max("docs").alias("docs"), at(1).alias("q1"), at(3).alias("q3"))


LEVELS = {"": ["lang", "source"], "lang_": ["lang"], "all_": []}     # prefix of the fence columns: keys of the level


def fences(sk: DataFrame) -> DataFrame:
    """(lang, source, lo_<measure>, hi_<measure>..., lang_lo_<measure>..., all_lo_<measure>...): one row
    per group of the sketch, with the fences of its own, of its language and of all documents."""
    own, by_lang, overall = (_fences(sk, keys, prefix) for prefix, keys in LEVELS.items())
    b = by_lang.withColumnRenamed("lang", "_lang")
    return own.join(b, F.col("lang").eqNullSafe(F.col("_lang"))).drop("_lang").join(F.broadcast(overall), F.lit(True))


def _fences(sk: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    j = quartiles(sk, keys)
    least = F.create_map(*[x for name, (_, d) in MEASURES.items() for x in (F.lit(name), F.lit(d))])[F.col("measure")]
    width = F.greatest((F.col("q3") - F.col("q1")) * SPREAD, least)
    j = j.select(*keys, "measure", (F.col("q1") - width).alias("lo"), (F.col("q3") + width).alias("hi"))
    return j.groupBy(*keys).agg(*[
        F.max(F.when(F.col("measure") == m, F.col(side))).alias(f"{prefix}{side}_{m}") for m in MEASURES for side in ("lo", "hi")])


def judge(docs: DataFrame, **columns: str) -> DataFrame:
    """Base columns, base_failed, the measures, the fences of the three levels, ``kept``, ``kept_lang`` and ``kept_all``.

    The sketch covers the documents that pass the base rule; the narrow base
    table is written once, so texts are read and split once.
    """
    m = written(measures(base_columns(docs, **columns)), "quality-base")
    f = written(fences(sketch(m.where(~F.col("base_failed")))), "quality-fences").alias("f")
    j = m.alias("m").join(f, F.col("m.lang").eqNullSafe(F.col("f.lang")) & F.col("m.source").eqNullSafe(F.col("f.source")),
                          "left")
    verdicts = []
    for prefix, name in zip(LEVELS, ("kept", "kept_lang", "kept_all")):
        inside = F.lit(True)
        for measure in MEASURES:
            v = F.col(f"m.m_{measure}")
            inside = inside & (v >= F.col(f"f.{prefix}lo_{measure}")) & (v <= F.col(f"f.{prefix}hi_{measure}"))
        verdicts.append(F.when(F.col("m.base_failed"), False).otherwise(F.coalesce(inside, F.lit(True))).alias(name))
    fence = [F.col(f"f.{prefix}{side}_{name}") for prefix in LEVELS for name in MEASURES for side in ("lo", "hi")]
    return j.select("m.*", *fence, *verdicts)
