"""Exact top-k by integer inner product with block-at-a-time pruning (operator 8).

Vectors are cut into blocks of neighbouring documents.  A block keeps its
forward index (the integer matrix) and, per component, the least and greatest
value: the summed component maxima of a query, ``sum_d max(q_d*lo_d, q_d*hi_d)``,
bound every score in the block.  Three passes:

1. *Order*: the blocks' bounds (two rows of numbers per block, no vectors) are
   computed for every group of queries, and each query is sent to the
   ``FIRST`` blocks with its greatest bounds.
2. *Start*: those blocks are scored through their forward index; the kth score
   of a query is a floor under its final kth score.
3. *Rest*: a block whose bound lies below the query's floor cannot hold a
   result; the other blocks are scored.  Bounds equal to the floor are scored,
   since a tie may go to a smaller id.

Blocks come from a range partitioning on a locality key (signs of a few random
projections), then id, so similar vectors share blocks and a very frequent
vector spreads over many.  Queries are handled in groups of ``QUERY_ROWS``
against blocks of ``BLOCK_ROWS``: no pair of single rows is formed in Spark,
and each query keeps at most k rows per scored block.

Edge cases: NULL vectors and vectors holding NULL, NaN or infinity take no
part; shorter vectors count as padded with zeros; ids may repeat (each row is a
query or candidate of its own, only a query's own row is none of its candidates);
fewer candidates than k gives all; an empty table gives an empty result.  Sums
are exact while the products stay below 2**53 in total, else Python integers are
used; components and scores beyond 64 bits count as the greatest (least) number,
so such scores tie and the smaller id goes first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import written

SCALE = 1024
LARGEST = 2 ** 63 - 1
BLOCK_ROWS = 512
QUERY_ROWS = 64
FIRST = 2
KEY_BITS, KEY_SEED = 12, 20
_HASH_DIMS = 1 << 16


def integer_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v array<long>, rid): floor(scale * x) of the vectors that take part, and the number of the row."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (table.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("x"), fine.alias("fine"))
            .where("vec_id IS NOT NULL AND x IS NOT NULL AND fine")
            .select("vec_id", F.transform("x", lambda x: F.floor(x * scale)).alias("v"), F.monotonically_increasing_id().alias("rid")))


def _matrix(lists: pa.ListArray, dims: int) -> np.ndarray:
    """Rows of the list column as an int64 matrix, padded with zeros."""
    at = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False).astype("int64")
    size = np.diff(at)
    out = np.zeros((len(size), dims), "int64")
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(at[0], at[-1]) - np.repeat(at[:-1], size)] = flat[at[0]:at[-1]]
    return out


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact a @ b.T: in doubles where every sum fits, else in Python integers."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < 2.0 ** 53:
        return (a.astype("float64") @ b.T.astype("float64")).astype("int64")
    exact = a.astype(object) @ b.T.astype(object)
    return np.minimum(np.maximum(exact, -LARGEST), LARGEST).astype("int64")


def locality(vectors: DataFrame, bits: int = KEY_BITS, seed: int = KEY_SEED) -> DataFrame:
    """Adds ``key``: the sign bits of ``bits`` random projections."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            dims = int(np.diff(lists.offsets.to_numpy()).max(initial=0))
            plane = np.random.default_rng(seed).standard_normal((_HASH_DIMS, bits))[:dims] if dims <= _HASH_DIMS else \
                np.random.default_rng(seed).standard_normal((dims, bits))
            signs = (_matrix(lists, dims).astype("float64") @ plane) > 0
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, batch.column(2), pa.array(signs @ (1 << np.arange(bits)), pa.int64())],
                                             ["vec_id", "v", "rid", "key"])
    return vectors.select("vec_id", "v", "rid").mapInArrow(run, "vec_id long, v array<long>, rid long, key long")


def blocks(vectors: DataFrame, dims: int, rows: int = BLOCK_ROWS) -> DataFrame:
    """(block, ids, rids, matrix, lo, hi): forward indexes and component bounds of
    runs of neighbouring documents.  Written once, as later passes must see the
    same blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                m, ids, rids = _matrix(part.column(1), dims), *(part.column(c).to_numpy().astype("int64") for c in (0, 2))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x.tobytes()], pa.binary()) for x in (ids, rids, m, m.min(0), m.max(0))], ["ids", "rids", "matrix", "lo", "hi"])
    ordered = locality(vectors).repartitionByRange("key", "vec_id").sortWithinPartitions("key", "vec_id")
    b = ordered.select("vec_id", "v", "rid").mapInArrow(run, "ids binary, rids binary, matrix binary, lo binary, hi binary")
    return written(b.select(F.monotonically_increasing_id().alias("block"), "*"), "topk-blocks")


def query_groups(vectors: DataFrame, dims: int, is_query, rows: int = QUERY_ROWS) -> DataFrame:
    """(group, ids, rids, matrix) of the queries, ``rows`` at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([part.column(c).to_numpy().astype("int64").tobytes()], pa.binary()) for c in (0, 2)),
                     pa.array([_matrix(part.column(1), dims).tobytes()], pa.binary())], ["ids", "rids", "matrix"])
    q = vectors.where(is_query).select("vec_id", "v", "rid").repartitionByRange("vec_id").sortWithinPartitions("vec_id")
    q = q.mapInArrow(run, "ids binary, rids binary, matrix binary")
    return written(q.select(F.monotonically_increasing_id().alias("group"), "*"), "topk-queries")


def _int64(value, dims: int | None = None) -> np.ndarray:
    a = np.frombuffer(value.as_buffer(), "int64")
    return a if dims is None else a.reshape(-1, dims)


def bounds(groups: DataFrame, block_bounds: DataFrame, dims: int, floors: DataFrame | None = None, first: int = FIRST) -> DataFrame:
    """(block, group, rows array<int>): the queries of each group that go to a block.

    Without floors each query goes to the ``first`` blocks of greatest bound
    (ties: smaller block); with floors, to the blocks whose bound reaches its floor and that
    have not been scored.  Bounds are two short rows of numbers per block,
    packed about ``BLOCK_ROWS`` to a row, so a task holds one pack and one group.
    """
    packed = block_bounds.groupBy("pack").agg(
        F.sort_array(F.collect_list(F.struct("block", "lo", "hi"))).alias("b"))
    packs, starting = _packs(block_bounds), floors is None
    g = groups if floors is None else groups.join(floors, "group")
    pairs = g.select("group", "ids", "matrix", *([] if floors is None else ["floor", "seen"]),
                     F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(packs, 1) - 1).cast("long")))
                     .alias("pack")).join(packed, "pack")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: batch.column(n)[r] for n in batch.schema.names}
                q = _int64(row["matrix"], dims).astype("float64")
                b = row["b"].as_py()
                lo, hi = (np.stack([np.frombuffer(x[s], "int64") for x in b]).astype("float64") for s in ("lo", "hi"))
                up = np.maximum(q, 0) @ hi.T + np.minimum(q, 0) @ lo.T
                up += np.abs(q) @ np.maximum(np.abs(lo), np.abs(hi)).T * 1e-9  # never below the true bound: rounding is relative to the products
                block = np.array([x["block"] for x in b])
                if starting:
                    top = min(first, len(block))
                    rank = np.argsort(-up, axis=1, kind="stable")[:, :top]
                    rows_, cols = np.repeat(np.arange(len(q)), top), rank.ravel()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows_), row["group"].as_py())), pa.array(rows_.astype("int32")),
                         pa.array(block[cols]), pa.array(up[rows_, cols])], ["group", "row", "block", "bound"])
                else:
                    go = up >= np.array(row["floor"].as_py(), "float64")[:, None]
                    for k, seen in enumerate(row["seen"].as_py()):
                        go[k, np.isin(block, seen)] = False
                    rows_, cols = np.nonzero(go)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows_), row["group"].as_py())), pa.array(rows_.astype("int32")),
                         pa.array(block[cols]), pa.array(up[rows_, cols])], ["group", "row", "block", "bound"])
    sent = pairs.mapInArrow(run, "group long, row int, block long, bound double")
    if starting:  # the best of each pack, then the best of all
        w = Window.partitionBy("group", "row").orderBy(F.desc("bound"), "block")
        sent = sent.withColumn("at", F.row_number().over(w)).where(F.col("at") <= first)
    return sent.groupBy("block", "group").agg(F.sort_array(F.collect_list("row")).alias("rows"))


def with_packs(block_bounds: DataFrame) -> DataFrame:
    """The pack of every block, by a hash of its id: no order over all blocks."""
    packs = max(-(-block_bounds.count() // BLOCK_ROWS), 1)
    return block_bounds.withColumn("pack", F.pmod(F.xxhash64("block"), F.lit(packs)))


def _packs(block_bounds: DataFrame) -> int:
    n = block_bounds.agg(F.max("pack")).first()[0]
    return 0 if n is None else n + 1


def scored(sent: DataFrame, groups: DataFrame, block_table: DataFrame, dims: int, k: int) -> DataFrame:
    """(group, row, query_id, vec_id, score, block): the k best of each block for the queries sent to it."""
    j = (sent.join(groups.select("group", F.col("ids").alias("q_ids"), F.col("rids").alias("q_rids"), F.col("matrix").alias("q")), "group")
         .join(block_table.select("block", "ids", "rids", "matrix"), "block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["group", "row", "query_id", "vec_id", "score", "block"]
        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: batch.column(n)[r] for n in batch.schema.names}
                at = np.array(row["rows"].as_py(), "int64")
                q_ids, q_rids, q = _int64(row["q_ids"])[at], _int64(row["q_rids"])[at], _int64(row["q"], dims)[at]
                ids, rids, m = _int64(row["ids"]), _int64(row["rids"]), _int64(row["matrix"], dims)
                s = _product(q, m)
                order = np.argsort(ids, kind="stable")  # then a stable sort by score leaves ties by id
                ids, rids, s = ids[order], rids[order], s[:, order]
                out = [[], [], [], []]
                for x in range(len(at)):
                    others = np.flatnonzero(rids != q_rids[x])
                    best = others[np.argsort(-s[x][others], kind="stable")[:k]]
                    out[0].append(np.full(len(best), at[x]))
                    out[1].append(np.full(len(best), q_ids[x]))
                    out[2].append(ids[best])
                    out[3].append(s[x][best])
                a = [np.concatenate(o) if o else np.empty(0, "int64") for o in out]
                n = len(a[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, row["group"].as_py(), "int64")), pa.array(a[0].astype("int32")),
                     *(pa.array(x.astype("int64")) for x in a[1:]), pa.array(np.full(n, row["block"].as_py(), "int64"))], names)
    return j.mapInArrow(run, "group long, row int, query_id long, vec_id long, score long, block long")


def search(table: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
           scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of every query row."""
    v = written(integer_vectors(table, id_col, vector_col, scale), "topk-vectors")
    dims = v.agg(F.max(F.size("v"))).first()[0] or 1
    block_table = blocks(v, dims)
    summary = written(with_packs(block_table.select("block", "lo", "hi")), "topk-bounds")
    groups = query_groups(v, dims, is_query)
    best = Window.partitionBy("group", "row").orderBy(F.desc("score"), "vec_id")

    started = written(scored(bounds(groups, summary, dims), groups, block_table, dims, k), "topk-start")
    kept = started.withColumn("at", F.row_number().over(best)).where(F.col("at") <= k)
    # the kth score so far; a query with fewer than k candidates yet has no floor
    floor = kept.groupBy("group", "row").agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
    seen = started.groupBy("group", "row").agg(F.collect_set("block").alias("seen"))
    per_query = groups.select("group", F.posexplode(F.sequence(F.lit(1), (F.octet_length("ids") / 8).cast("int"))).alias("row", "_x"))
    floors = (per_query.select("group", "row").join(floor, ["group", "row"], "left").join(seen, ["group", "row"], "left")
              .groupBy("group").agg(F.sort_array(F.collect_list(F.struct(
                  "row", F.coalesce(F.col("floor").cast("double"), F.lit(float("-inf"))).alias("floor"),
                  F.coalesce("seen", F.array().cast("array<long>")).alias("seen")))).alias("f"))
              .select("group", F.col("f.floor").alias("floor"), F.col("f.seen").alias("seen")))
    rest = scored(bounds(groups, summary, dims, written(floors, "topk-floors")), groups, block_table, dims, k)
    both = started.unionByName(rest)
    final = Window.partitionBy("group", "row").orderBy(F.desc("score"), "vec_id")
    return (both.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
