"""Near-duplicate classes by an n-gram Jaccard join over signature trees (operator 10).

Two documents link when the Jaccard similarity of their sets of word n-grams
(64-bit hashes) reaches ``num/den``; classes are the connected components.

* Equal sets are one *set* from the start (its id is a hash of the set), so
  exact copies cost nothing further.
* **Root**: sets are dealt to buckets by token.  With all tokens in one fixed
  order, two sets that link share a token among the first
  ``size - ceil(t*size) + 1`` of each, so every link lies inside a bucket.  The
  order puts tokens that are frequent in a sample of documents last; it decides
  bucket sizes only, any order gives the same links.
* **Trees**: in a bucket, sets sorted by size and bitmap form a signature tree:
  a node holds the OR and AND of its sets' token bitmaps and their size range.
  Dual traversal from (root, root) drops a node pair when the sizes cannot
  match or when the greatest possible overlap, ``size - |bits of one side's AND
  missing from the other's OR|``, is too small.  Buckets of more than
  ``CHUNK`` sets are cut into chunks and every pair of chunks is a task of its own.
* Surviving pairs are verified exactly on the token sets.

Classes need connections, not all pairs.  So a first round connects the bulk of
each group: buckets by ``ANCHORS`` minimum hashes, and from each tree only each
set's nearest predecessor (a line per set, not a pair per pair).  The second
round goes through *all* token buckets that still hold sets of different
classes and pairs only those, which makes the result whole.

Edge cases: NULL and blank texts have an empty set, size 0, and link with
nothing; fewer words than n are one n-gram; a NULL id takes no part and has a
NULL class; repeated rows share a class; an empty table gives an empty result;
very long texts are single rows handled in bounded groups; input columns beside
the two named are ignored.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lectern.llm.chunks import groups
from lectern.llm.common import unit_hash, written

ANCHORS = 4
CHUNK, SPAN_CHUNK = 1_024, 256        # sets of a bucket that one task pairs, or connects
LEAF, FANOUT = 32, 8
BITS = 512
ORDER_SAMPLE, ORDER_TOKENS = 16_000, 200_000
TEXT_ROWS, PAIR_ROWS = 1_000, 100   # rows of an Arrow batch that carries texts or pairs of token sets
SLOT_BITS = 23                      # size of the member filter: 2**23 bits, 1 MB whatever the corpus

_U = np.uint64
_RNG = np.random.default_rng(20_240_501)
_BYTE = _RNG.integers(1, 2 ** 63, 256, dtype="uint64") | _U(1)
_STEP = _RNG.integers(1, 2 ** 63, 16, dtype="uint64") | _U(1)
_SALT = _RNG.integers(1, 2 ** 63, ANCHORS + 2, dtype="uint64")
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def token_sets(texts: list[str | None], n: int) -> Iterator[np.ndarray]:
    """Sorted distinct n-gram hashes of each text (words lower-cased in A-Z only)."""
    for some in groups([t or "" for t in texts], rows=256, chars=1_000_000):
        raw = [t.encode("utf-8", "replace").lower() + b" " for t in some]
        b = np.frombuffer(b"".join(raw), "uint8")
        ends = np.cumsum([len(r) for r in raw])
        solid = ~_IS_SPACE[b]
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]
        first = np.flatnonzero(begins)
        if not len(first):
            yield from (np.empty(0, "uint64") for _ in some)
            continue
        at = np.cumsum(solid) - 1                       # position among the solid bytes
        starts = at[first]
        body = b[solid]
        length = np.diff(np.append(starts, len(body)))
        power = np.cumprod(np.concatenate([[_U(1)], np.full(int(length.max()) - 1, _U(6364136223846793005))]).astype("uint64"))
        place = np.arange(len(body)) - np.repeat(starts, length)
        word = mix64(np.add.reduceat(_BYTE[body] * power[place], starts) + length.astype("uint64") * _STEP[15])
        bounds = np.searchsorted(first, ends)           # words of text i end at bounds[i]
        low = 0
        for high in bounds.tolist():
            w = word[low:high]
            low = high
            if not len(w):
                yield np.empty(0, "uint64")
                continue
            k = min(n, len(w))
            total = np.full(len(w) - k + 1, _U(k), "uint64")
            for i in range(k):
                total = mix64(total * _STEP[i % 15] + w[i:len(w) - k + 1 + i])
            yield np.unique(total)


def set_id(tokens: np.ndarray) -> int:
    total = mix64(tokens ^ _SALT[-1]).sum(dtype="uint64", keepdims=True)
    return int(mix64(total + np.array([len(tokens)], "uint64") * _STEP[14]).view("int64")[0])


def prefix(tokens: np.ndarray, num: int, den: int, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first tokens of the set in the fixed order (frequency rank, then value)."""
    s = len(tokens)
    take = s + (-num * s // den) + 1                    # s - ceil(num*s/den) + 1
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
        order = np.where(frequent[at] == tokens, rank[at], 0)
        tokens = tokens[np.argsort(order, kind="stable")]
    return tokens[:take]


def bitmap(tokens: np.ndarray, width: int = BITS) -> bytes:
    """The set's token bitmap; ``width`` is a power of two of at least 64."""
    bits = np.zeros(width, "uint8")
    bits[(mix64(tokens) >> _U(24)) % _U(width)] = 1
    return np.packbits(bits).tobytes()


def wide_bitmap(tokens: np.ndarray) -> bytes:
    """A bitmap of four bits or more per token, so that most differences show."""
    return bitmap(tokens, max(BITS, 4 << int(len(tokens) - 1).bit_length()))


def greatest_overlap(size_a: int, a: bytes, size_b: int, b: bytes) -> int:
    """Greatest overlap that two bitmaps allow.  The wider is folded to the
    other's width by ORing halves, which is the bitmap it would have there."""
    x, y = np.frombuffer(a, "uint64"), np.frombuffer(b, "uint64")
    while len(x) > len(y):
        x = x[:len(x) // 2] | x[len(x) // 2:]
    while len(y) > len(x):
        y = y[:len(y) // 2] | y[len(y) // 2:]
    return min(size_a - int(np.bitwise_count(x & ~y).sum()), size_b - int(np.bitwise_count(y & ~x).sum()))


def _longs(x: np.ndarray) -> np.ndarray:
    return x.view("int64") if x.dtype == "uint64" else x


def frequent_tokens(docs: DataFrame, n: int, total: int, sample: int = ORDER_SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, ranks): tokens found in several of about ``sample`` documents,
    the most frequent ``ORDER_TOKENS`` of them; only the order of tokens, never
    the result, depends on them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                t = np.concatenate(list(token_sets(batch.column(0).slice(at, 512).to_pylist(), n)))
                yield pa.RecordBatch.from_arrays([pa.array(_longs(t))], ["token"])
    some = docs.where(unit_hash("doc_id", seed="order") < sample / max(total, 1)).select("text")
    rows = (some.mapInArrow(run, "token long").groupBy("token").count().where("count > 1")
            .orderBy(F.desc("count"), "token").limit(ORDER_TOKENS).toArrow())
    tokens = rows.column(0).to_numpy().view("uint64")
    order = np.argsort(tokens)
    return tokens[order], rows.column(1).to_numpy()[order]


def describe(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(doc_id, n_shingles, set_id, prefix, anchors, bitmap, wide).  A task gives
    the last four only with the first document of each set that it meets."""
    frequent, rank = frequent_tokens(docs, n, docs.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                size, ids, firsts, anchors, maps, wides = [], [], [], [], [], []
                for key, t in zip(part.column(0).to_pylist(), token_sets(part.column(1).to_pylist(), n)):
                    size.append(len(t))
                    ids.append(set_id(t) if len(t) and key is not None else None)
                    new = ids[-1] is not None and ids[-1] not in met
                    if len(met) > 1_000_000:
                        met.clear()
                    met.add(ids[-1])
                    firsts.append(_longs(prefix(t, num, den, frequent, rank)) if new else np.empty(0, "int64"))
                    anchors.append(_longs(mix64(np.array([mix64(t ^ s).min() for s in _SALT[:ANCHORS]], "uint64") + _SALT[:ANCHORS]))
                                   if new else np.empty(0, "int64"))
                    maps.append(bitmap(t) if new else None)
                    wides.append(wide_bitmap(t) if new else None)
                lists = [pa.ListArray.from_arrays(pa.array(np.cumsum([0] + [len(x) for x in col]), pa.int32()),
                                                  pa.array(np.concatenate(col))) for col in (firsts, anchors)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(size, pa.int64()), pa.array(ids, pa.int64()), *lists,
                                                  pa.array(maps, pa.binary()), pa.array(wides, pa.binary())],
                                                 ["doc_id", "n_shingles", "set_id", "prefix", "anchors", "bitmap", "wide"])
    return written(docs.mapInArrow(run, "doc_id long, n_shingles long, set_id long, prefix array<long>, anchors array<long>, "
                                        "bitmap binary, wide binary"), "jaccard-docs", TEXT_ROWS)


def shared(described: DataFrame, column: str, name: str) -> DataFrame:
    """(key, set_id, pos) of the keys that two or more sets have.  Minimum and
    maximum pre-aggregate, and only keys that differ in them are joined back."""
    rows = described.select("set_id", F.posexplode(column).alias("pos", "key"))
    keys = rows.groupBy("key").agg(F.min("set_id").alias("a"), F.max("set_id").alias("b")).where("a < b").select("key")
    return written(rows.join(written(keys, f"{name}-keys"), "key").groupBy("key", "set_id").agg(F.min("pos").alias("pos")), name)


def members(docs: DataFrame, described: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(set_id, tokens) of the wanted sets, recomputed from one document each.
    The documents are found through a bit filter of fixed size; a false hit
    gives a set that no pair asks for.  No text is shuffled."""
    reps = written(described.where("set_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("doc_id"))
                   .join(wanted, "set_id", "left_semi"), "jaccard-reps")
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << SLOT_BITS)) + 1
    packed = (reps.select(slot.alias("slot")).groupBy(F.bitmap_bucket_number("slot").alias("bucket"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect())
    bits = np.zeros((1 << SLOT_BITS) // 8, "uint8")
    for r in packed:  # at most 2**SLOT_BITS bits in all
        part = np.frombuffer(bytes(r["bits"]), "uint8")
        at = (r["bucket"] - 1) * len(part)
        bits[at:at + len(part)] = part[:len(bits) - at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = batch.column(0).to_numpy() - 1
            keep = batch.filter(pa.array((bits[s >> 3] >> (s & 7).astype("uint8")) & 1 == 1))
            for at in range(0, keep.num_rows, 512):
                part = keep.slice(at, 512)
                t = list(token_sets(part.column(1).to_pylist(), n))
                yield pa.RecordBatch.from_arrays([pa.array([set_id(x) if len(x) else None for x in t], pa.int64()),
                                                  pa.array([x.tobytes() for x in t], pa.binary())], ["set_id", "tokens"])
    texts = docs.where("doc_id IS NOT NULL").select(slot.alias("slot"), "text")
    return written(texts.mapInArrow(run, "set_id long, tokens binary"), "jaccard-members", TEXT_ROWS)


# --- signature trees -------------------------------------------------------------------------------

class Bucket:
    """Sets of one bucket, in tree order: by size, then bitmap."""

    def __init__(self, ids, size, bits, pos, cls, chunk, num, den):
        order = np.lexsort((bits[:, 1], bits[:, 0], size))
        self.ids, self.size, self.bits = ids[order], size[order].astype("int64"), bits[order]
        self.pos, self.cls, self.chunk = pos[order].astype("int64"), cls[order], chunk[order]
        self.num, self.den = num, den

    def matches(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which of the index grid i x j may link: positions, sizes and bitmaps allow the overlap."""
        a, b = self.size[i][:, None], self.size[j][None, :]
        ok = (self.den * np.minimum(a, b) >= self.num * np.maximum(a, b)) & (self.cls[i][:, None] != self.cls[j][None, :])
        # were this token their first common one, no more than what follows it could be shared
        after = 1 + np.minimum(a - self.pos[i][:, None] - 1, b - self.pos[j][None, :] - 1)
        ok &= self._enough(after, a, b)
        r, c = np.nonzero(ok)
        if len(r):
            most = self.overlap(i[r], j[c])
            ok[r, c] = self._enough(most, self.size[i[r]], self.size[j[c]])
        return ok

    def overlap(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Greatest possible overlap of the sets i[k], j[k]."""
        x, y = self.bits[i], self.bits[j]
        only = lambda p, q: np.bitwise_count(p & ~q).sum(1, dtype="int64")
        return np.minimum(self.size[i] - only(x, y), self.size[j] - only(y, x))

    def _enough(self, overlap, a, b):
        return self.den * overlap >= self.num * (a + b - overlap)

    def tree(self) -> list:
        """Nodes (first, last, OR, AND, children) level by level; returns the root."""
        level = []
        for s in range(0, len(self.ids), LEAF):
            e = min(s + LEAF, len(self.ids))
            level.append((s, e, np.bitwise_or.reduce(self.bits[s:e]), np.bitwise_and.reduce(self.bits[s:e]), None))
        while len(level) > 1:
            up = []
            for s in range(0, len(level), FANOUT):
                kids = level[s:s + FANOUT]
                up.append((kids[0][0], kids[-1][1], np.bitwise_or.reduce([k[2] for k in kids]),
                           np.bitwise_and.reduce([k[3] for k in kids]), kids))
            level = up
        return level[0]

    def may_link(self, x, y) -> bool:
        """Whether any set of node x can link to any of node y (x not after y in size)."""
        lo_x, hi_x, lo_y = self.size[x[0]], self.size[x[1] - 1], self.size[y[0]]
        if self.den * hi_x < self.num * lo_y:
            return False
        hi_y = self.size[y[1] - 1]
        gap = lambda p, q: int(np.bitwise_count(p & ~q).sum())
        most = min(hi_x - gap(x[3], y[2]), hi_y - gap(y[3], x[2]))
        return bool(self._enough(most, lo_x, lo_y))

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Dual traversal: index pairs of different classes that may link."""
        across = self.chunk.min() != self.chunk.max()
        root = self.tree() if len(self.ids) > LEAF else (0, len(self.ids), None, None, None)
        todo = [(root, root)]
        while todo:
            x, y = todo.pop()
            if x is not y and not self.may_link(x, y):
                continue
            if x[4] is None and y[4] is None:
                i, j = np.arange(x[0], x[1]), np.arange(y[0], y[1])
                ok = self.matches(i, j)
                if x is y:
                    ok &= i[:, None] < j[None, :]
                if across:
                    ok &= self.chunk[i][:, None] != self.chunk[j][None, :]
                r, c = np.nonzero(ok)
                if len(r):
                    yield i[r], j[c]
            else:
                xs, ys = x[4] or [x], y[4] or [y]
                todo += [(p, q) for a, p in enumerate(xs) for b, q in enumerate(ys) if x is not y or a <= b]

    def spanning(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Each set with its nearest predecessor in tree order (by possible overlap), if they may link."""
        m = len(self.ids)
        for s in range(1, m, 64):
            e = min(s + 64, m)
            i, j = np.arange(s, e), np.arange(e)
            r, c = np.nonzero((j[None, :] < i[:, None]) & (self.cls[i][:, None] != self.cls[j][None, :])
                              & (self.den * self.size[j][None, :] >= self.num * self.size[i][:, None]))
            if not len(r):
                continue
            most = self.overlap(i[r], j[c])
            ok = self._enough(most, self.size[i[r]], self.size[j[c]])
            r, c, most = r[ok], c[ok], most[ok]
            share = most / (self.size[i[r]] + self.size[j[c]] - most)
            order = np.lexsort((c, -share, r))
            r, c = r[order], c[order]
            lead = np.ones(len(r), bool)
            lead[1:] = r[1:] != r[:-1]
            yield i[r[lead]], j[c[lead]]


def tree_pairs(rows: DataFrame, num: int, den: int, spanning: bool) -> DataFrame:
    """Distinct candidate pairs (a < b) from the buckets of rows
    (key, set_id, pos, cls, size, bitmap)."""
    count = rows.groupBy("key").agg(F.ceil(F.count("*") / (SPAN_CHUNK if spanning else CHUNK)).cast("int").alias("chunks")).where("chunks > 1")
    r = rows.join(written(count, "jaccard-hot"), "key", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    r = r.withColumn("chunk", F.pmod(F.xxhash64("set_id", "key"), F.col("chunks")).cast("int"))
    if spanning:
        r = r.withColumn("ci", F.col("chunk")).withColumn("cj", F.col("chunk"))
    else:  # every chunk meets every chunk, itself included, in a group of its own
        r = r.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        r = r.withColumn("ci", F.least("chunk", "other")).withColumn("cj", F.greatest("chunk", "other"))
    r = r.withColumn("group", F.xxhash64("key", "ci", "cj")).select("group", "set_id", "pos", "cls", "size", "chunk", "bitmap")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(table: pa.Table) -> pa.RecordBatch:
            cols = {c: table.column(c).to_numpy() for c in ("group", "set_id", "pos", "cls", "size", "chunk")}
            bits = np.frombuffer(b"".join(table.column("bitmap").to_pylist()), "uint64").reshape(-1, BITS // 64)
            cut = np.flatnonzero(np.diff(cols["group"])) + 1
            out_a, out_b = [], []
            for s, e in zip([0, *cut.tolist()], [*cut.tolist(), len(bits)]):
                if e - s < 2:
                    continue
                b = Bucket(*(cols[c][s:e] if c != "bitmap" else bits[s:e]
                             for c in ("set_id", "size", "bitmap", "pos", "cls", "chunk")), num, den)
                for i, j in (b.spanning() if spanning else b.pairs()):
                    out_a.append(np.minimum(b.ids[i], b.ids[j]))
                    out_b.append(np.maximum(b.ids[i], b.ids[j]))
            a, b = (np.concatenate(x) if x else np.empty(0, "int64") for x in (out_a, out_b))
            both = np.unique(np.stack([a, b], 1), axis=0) if len(a) else np.empty((0, 2), "int64")
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            g = table.column("group").to_numpy()
            whole = int(np.searchsorted(g, g[-1])) if len(g) else 0   # the last group may go on
            if whole:
                yield done(table.slice(0, whole))
                held = table.slice(whole).combine_chunks().to_batches()
        if held:
            yield done(pa.Table.from_batches(held))
    dealt = r.repartition("group").sortWithinPartitions("group")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def allowed(pairs: DataFrame, described: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose wide bitmaps allow a similarity of num/den."""
    wide = described.where("wide IS NOT NULL").select("set_id", F.col("n_shingles").alias("size"), "wide")
    need = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
    wide = written(wide.join(need, "set_id", "left_semi").dropDuplicates(["set_id"]), "jaccard-wide")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size_a, size_b, x, y = (batch.column(c).to_pylist() for c in (2, 3, 4, 5))
            most = np.array([greatest_overlap(*row) for row in zip(size_a, x, size_b, y)], "int64")
            total = np.array(size_a, "int64") + np.array(size_b, "int64")
            ok = den * most >= num * (total - most)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(ok, pa.bool_()))
    side = lambda c: wide.select(F.col("set_id").alias(c), F.col("size").alias(f"{c}_size"), F.col("wide").alias(f"{c}_wide"))
    j = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_size", "b_size", "a_wide", "b_wide")
    return j.mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, docs: DataFrame, described: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The pairs whose exact Jaccard similarity reaches num/den.  Wide bitmaps,
    a small part of the sets in size, settle most pairs before any set moves."""
    pairs = written(allowed(written(pairs, "jaccard-candidates"), described, num, den), "jaccard-pairs", TEXT_ROWS)
    sets = members(docs, described, pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct(), n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = (np.frombuffer(v.as_buffer(), "uint64") for v in (x, y))
                both = len(np.intersect1d(p, q, assume_unique=True))
                ok.append(den * both >= num * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(ok, pa.bool_()))
    side = lambda c: sets.where("set_id IS NOT NULL").select(F.col("set_id").alias(c), F.col("tokens").alias(f"{c}_tokens"))
    j = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "a_tokens", "b_tokens")
    return written(j.mapInArrow(run, "a long, b long"), "jaccard-links", PAIR_ROWS)


def components(links: DataFrame) -> DataFrame:
    """(id, label): the least id of each connected component, by taking the
    least label of the neighbours, then the label's label, until nothing
    changes; every round is written, so lineage stays short."""
    edges = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "jaccard-edges")
    label = written(edges.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "jaccard-label")
    while True:
        near = (edges.join(label.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id"))
                .agg(F.min("label").alias("near")))
        low = label.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("mid"))
        jump = label.select(F.col("id").alias("mid"), F.col("label").alias("far"))
        new = written(low.join(jump, "mid", "left").select("id", "old", F.least("mid", F.coalesce("far", "mid")).alias("label")),
                      "jaccard-label")
        label = new.select("id", "label")
        if new.where("label <> old").isEmpty():
            return label


def _classes(docs: DataFrame, n: int, num: int, den: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The described documents, and (set_id, label, component_id) of every set:
    its class and the least doc_id of the class."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    described = describe(docs, n, num, den)
    by_anchor, by_token = shared(described, "anchors", "jaccard-anchors"), shared(described, "prefix", "jaccard-tokens")
    shape = written(described.where("bitmap IS NOT NULL").select("set_id", F.col("n_shingles").cast("int").alias("size"), "bitmap")
                    .dropDuplicates(["set_id"]), "jaccard-shapes")

    first = by_anchor.join(shape, "set_id").select("key", "set_id", F.lit(0).alias("pos"), F.col("set_id").alias("cls"), "size", "bitmap")
    links = verified(tree_pairs(first, num, den, spanning=True), docs, described, n, num, den)
    label = components(links)

    classed = by_token.join(label.withColumnRenamed("id", "set_id"), "set_id", "left").select(
        "key", "set_id", "pos", F.coalesce("label", "set_id").alias("cls"))
    mixed = classed.groupBy("key").agg(F.min("cls").alias("x"), F.max("cls").alias("y")).where("x < y").select("key")
    rest = classed.join(written(mixed, "jaccard-mixed"), "key").join(shape, "set_id")
    more = verified(tree_pairs(rest.select("key", "set_id", "pos", "cls", "size", "bitmap"), num, den, spanning=False), docs, described, n, num, den)
    if not more.isEmpty():
        label = components(links.union(more))

    least = described.where("set_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("rep"))
    least = least.join(label.withColumnRenamed("id", "set_id"), "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))
    of_class = least.groupBy("label").agg(F.min("rep").alias("component_id"))
    return described, written(least.join(of_class, "label").select("set_id", "label", "component_id"), "jaccard-classes")


def near_duplicates(docs: DataFrame, n: int, num: int, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document: sets of word
    n-grams, links at Jaccard num/den and above, least doc_id of the class."""
    described, of_set = _classes(docs, n, num, den, id_col, text_col)
    return (described.select("doc_id", "n_shingles", "set_id").join(of_set.drop("label"), "set_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def with_sets(docs: DataFrame, n: int, text_col: str) -> DataFrame:
    """The rows with the id of their token set as ``_set``; NULL without tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                t = token_sets(part.column(part.schema.get_field_index("_text")).to_pylist(), n)
                last = pa.array([set_id(x) if len(x) else None for x in t], pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], last], [*part.schema.names[:-1], "_set"])
    return docs.withColumn("_text", F.col(text_col).cast("string")).mapInArrow(
        run, StructType([*docs.schema.fields, StructField("_set", LongType())]))


def keep_one(docs: DataFrame, n: int, num: int, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, columns unchanged, one of each class: the row of the
    least id, and of rows with that id one (least set id).  Rows with NULL id
    stay, and so does one row without tokens of each id."""
    described, of_set = _classes(docs, n, num, den, id_col, text_col)
    rows = described.select("doc_id", "set_id").join(of_set, "set_id")
    drop = rows.where("doc_id <> component_id").select(F.col("doc_id").alias("_dropped")).distinct()
    # ids that occur in several rows are few: their rows are judged each by its own text
    again = written(docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_again")).count().where("count > 1")
                    .select("_again"), "jaccard-repeated")
    drop = written(drop, "jaccard-dropped")
    if again.isEmpty():
        return docs.join(drop, F.col(id_col) == F.col("_dropped"), "left_anti")
    same = F.col(id_col) == F.col("_again")
    once = docs.join(again, same, "left_anti").join(drop, F.col(id_col) == F.col("_dropped"), "left_anti")
    firsts = (rows.where("doc_id = component_id").groupBy("label").agg(F.first("doc_id").alias("_first"), F.min("set_id").alias("_of"))
              .join(again, F.col("_first") == F.col("_again"), "left_semi").select("_first", "_of"))
    firsts = written(firsts, "jaccard-firsts")
    many = written(with_sets(docs.join(again, same, "left_semi"), n, text_col), "jaccard-again", TEXT_ROWS)
    first = many.join(firsts, (F.col(id_col) == F.col("_first")) & (F.col("_set") == F.col("_of")), "left_semi")
    return once.union(first.union(many.where("_set IS NULL")).dropDuplicates([id_col, "_set"]).drop("_set"))
