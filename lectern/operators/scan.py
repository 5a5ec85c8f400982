"""Ordered prefix scans that stay parallel when one key holds most rows.

The segmentation and attribution operators need "the latest value set at or
before this row" (forward fill) and running sums, per document, in reading
order.  ``Window.partitionBy(doc)`` would put a whole document into one task;
a document holding a third of the corpus would then run on one core.

Here rows are cut into *chunks*, a column that never decreases along the
order.  Where the order counts rows it gives the chunk itself (``line_no div
65536``); elsewhere ``row_chunks`` cuts each key at rows found from a sample, so
a chunk holds about so many rows whatever the order's values (one-line pages,
sparse page numbers, a thousand blocks at one height):

1. one shuffle by ``(keys, chunk)`` and a window inside each chunk give the
   local running values; tasks are bounded by the chunk size, not the key (rows
   that a join has dealt by the keys stay where they are if no key has several);
2. only keys of several chunks need a carry-in.  They are listed first, in a
   table written once; where there are none, step 1 is the whole scan;
3. for the listed keys the chunk totals are aggregated from the running columns,
   and a window over them gives each chunk its carry-in from the chunks before;
4. the carry-in, written once too, is joined back on ``(keys, chunk)``; its size
   is known, so the planner moves only the small side.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.session import materialize

CHUNK_ROWS = 65536     # rows of a chunk
MAX_CHUNKS = 4096      # chunks of one key; a longer key gets longer chunks
SAMPLED = 16           # sampled rows for each chunk
_HASHES = 1 << 30


def row_chunks(df: DataFrame, keys: Sequence[str], order: str | Column, rows: int = CHUNK_ROWS,
               max_chunks: int = MAX_CHUNKS, name: str = "_chunk") -> DataFrame:
    """Add ``name``: the number of the row's chunk within ``keys``, never
    decreasing along ``order``; a chunk holds about ``rows`` rows.

    A hash of (keys, order) picks about ``SAMPLED`` rows for each chunk, and
    every ``SAMPLED``-th of a key's sampled rows is a cut, so the cuts depend on
    the rows alone, not on how they are partitioned (a recomputed task agrees
    with the others).  Only keys longer than a chunk have cuts; their sorted
    cuts, at most ``max_chunks``, are joined by key and searched in two steps.
    Nothing but keys and order is read for the sample.  The cuts are written
    once: where no key has any, the rows are not moved at all.
    """
    keys, order_col = list(keys), F.col(order) if isinstance(order, str) else order
    rate = min(1.0, SAMPLED / rows)
    every = max(1, round(rows * rate))
    kept = lambda seed, share: F.pmod(F.xxhash64(F.lit(seed), *keys, "_o"), F.lit(_HASHES)) < share * _HASHES
    sample = df.select(*keys, order_col.alias("_o")).where(kept("sample", F.lit(rate)))
    sample = sample.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys))).where(F.col("_n") > every)
    sample = sample.where(kept("thin", F.lit(float(max_chunks * every)) / F.col("_n")))
    cuts = sample.groupBy(*keys).agg(F.array_sort(F.collect_list("_o")).alias("_s")).select(
        *keys, F.filter("_s", lambda _, i: (i + 1) % every == 0).alias("_cuts"))
    step = max(2, math.isqrt(max_chunks))
    cuts = cuts.select(*keys, "_cuts", F.filter("_cuts", lambda _, i: i % step == 0).alias("_heads"))
    cuts = materialize(df.sparkSession, cuts, "scan-cuts")
    if cuts.isEmpty():
        return df.select("*", F.lit(0).cast("long").alias(name))
    upto = lambda some, o: F.size(F.filter(some, lambda c: c <= o))
    j = df.withColumn("_o", order_col).join(cuts, keys, "left")
    j = j.withColumn("_h", F.when(F.col("_cuts").isNotNull(), upto(F.col("_heads"), F.col("_o"))).otherwise(0))
    chunk = F.when(F.col("_h") == 0, 0).otherwise(
        (F.col("_h") - 1) * step + upto(F.slice("_cuts", F.greatest((F.col("_h") - 1) * step + 1, F.lit(1)), step), F.col("_o")))
    return j.select(*df.columns, chunk.cast("long").alias(name))


def prefix_scan(df: DataFrame, keys: Sequence[str], order: str | Column, chunk: str,
                last: Mapping[str, Column] | None = None,
                sums: Mapping[str, Column] | None = None) -> DataFrame:
    """Add running columns to ``df``, inclusive of the current row.

    ``last``: name -> expression that is NULL where the row sets nothing; the
    output column holds the expression's value from the latest row (by
    ``order``) at or before the current one within ``keys``.
    ``sums``: name -> numeric expression; the output is its running sum.
    ``order`` must be orderable and unique within ``keys``; ``chunk`` must not
    decrease along ``order``; ``keys`` must not be NULL (the carry-in is
    joined back with plain equality, which keeps the big side's partitioning;
    a null-safe join would re-shuffle it).
    """
    last = dict(last or {})
    sums = dict(sums or {})
    order_col = F.col(order) if isinstance(order, str) else order
    keys = list(keys)
    part = keys + [chunk]

    # "latest non-null" is the running max of struct(order, value).
    marks = {f"__m_{n}": F.when(e.isNotNull(), F.struct(order_col.alias("o"), e.alias("v")))
             for n, e in last.items()}
    adds = {f"__s_{n}": e for n, e in sums.items()}
    base = df.select("*", *[e.alias(n) for n, e in {**marks, **adds}.items()])

    upto = Window.partitionBy(*part).orderBy(order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    def running(rows: DataFrame) -> DataFrame:
        return rows.select("*", *[F.max(n).over(upto).alias(f"{n}_run") for n in marks],
                           *[F.sum(n).over(upto).alias(f"{n}_run") for n in adds])

    several = materialize(df.sparkSession, df.where(F.col(chunk) != 0).select(*keys).distinct(), "scan-long-keys")
    if several.isEmpty():  # every key is one chunk
        return running(base).select(*df.columns, *[F.col(f"__m_{n}_run")["v"].alias(n) for n in last],
                            *[F.col(f"__s_{n}_run").alias(n) for n in sums])
    # Dealt by chunk: rows that come from a join on the keys would suit the window as they are, a whole key in one task.
    local = running(base.repartition(*part))
    totals = running(base.join(several, keys, "left_semi").repartition(*part)).groupBy(*part).agg(*[F.max(f"{n}_run").alias(n) for n in marks],
                                      *[F.max_by(f"{n}_run", order_col).alias(n) for n in adds])
    before = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*part, *[F.max(n).over(before).alias(f"{n}_in") for n in marks],
                          *[F.sum(n).over(before).alias(f"{n}_in") for n in adds])

    carry = materialize(df.sparkSession, carry, "scan-carry")
    out = local.join(carry, part, "left").select(
        *df.columns,
        *[F.coalesce(F.col(f"__m_{n}_run"), F.col(f"__m_{n}_in"))["v"].alias(n) for n in last],
        *[(F.col(f"__s_{n}_run") + F.coalesce(F.col(f"__s_{n}_in"), F.lit(0))).alias(n) for n in sums])
    return out
