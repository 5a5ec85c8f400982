"""Cross-tokenizer alignment with an identity-map fast path (operator 13).

A text is tokenised by a byte-level vocabulary (A) and by a sentencepiece
vocabulary (B), both over a space and the text.  Byte offsets at which tokens of
both end cut the tokens into groups; every A and every B token of a group are
linked.  How often an id pair is linked is counted in documents.

* Identity map: an array from each A id to the B id of the same bytes.  A group
  of one A and one B token is such a pair, so a task counts it in a vector as
  long as the A vocabulary; only the pairs of other groups are keyed by both ids.
* One pass tokenises each text once and writes two kinds of rows to the shared
  folder: a row per document (its figures and its distinct links) and, per task,
  partial counts.  Summing the partial counts is the only wide step over pairs.
* A second pass reads the stored links and looks counts up: identity counts and
  best counts as vectors of the A vocabulary's length, pair counts of frequent
  pairs from a sorted array of at most ``HOT_PAIRS``, those of all rarer pairs by
  a join, in which no key can be hot.

Neither vocabulary has tokens that run over a single space between two
characters that are not white space, so texts are aligned chunk by chunk and
chunks are cached; B's vocabulary is checked for that when it is loaded.

Edge cases: NULL and empty texts, and texts whose A or B tokens do not spell the
space and the text in bytes (U+2581 reads as a space in B), have no tokens and
zeros; special token strings are ordinary text; repeated rows count and are
returned each; an empty table gives no rows; input columns beside the two named
ones are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.bpe import byte_characters, pretoken_pattern, vocabulary_path
from lectern.llm.chunks import PieceCache, UnsafeCut, safe_parts, without_gc, word_cutter
from lectern.llm.common import kept, written

A_VOCABULARY, B_VOCABULARY = "byte_bpe_50k.json", "piece_bpe_32k.model"
HOT_PAIRS = 300_000         # pair counts that are broadcast (16 bytes each)
FLUSH_PAIRS = 400_000       # distinct pairs that a task counts before it hands them on
CACHED_CHARS = 200          # longer chunks are not cached
PART_CACHE, CHUNK_CACHE = 60_000, 250_000     # entries of a generation, two are kept
BATCH_ROWS = 1_000
SPACE = "▁"            # a space in B's pieces

STORED = ("kind int, rid long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "ones array<int>, ones_n array<int>, pairs array<long>, pairs_n array<long>")


class Aligner:
    """Both tokenisers and the identity map; built once per Python worker."""

    def __init__(self, a_path: str, b_path: str, pattern: str):
        import sentencepiece
        import tiktoken
        from sentencepiece import sentencepiece_model_pb2 as pb

        # A as ranks: where every merge makes the next id, merging by rank gives the ids of the file's own merges.
        with open(a_path, encoding="utf-8") as f:
            a = json.load(f)
        added = {t["content"] for t in a.get("added_tokens", ())}
        merges = [m.split(" ") if isinstance(m, str) else m for m in a["model"]["merges"]]
        if a.get("normalizer") or any(a["model"]["vocab"][x + y] != 256 + k for k, (x, y) in enumerate(merges)):
            raise ValueError("vocabulary A changes texts, or its ids do not follow its merges")
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in a["model"]["vocab"].items() if t not in added}
        self.a = tiktoken.Encoding("A", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        model = pb.ModelProto()
        with open(b_path, "rb") as f:
            model.ParseFromString(f.read())
        kind = pb.ModelProto.SentencePiece
        self.b_bytes = [bytes([int(p.piece[1:-1], 16)]) if p.type == kind.BYTE else
                        p.piece.replace(SPACE, " ").encode() if p.type in (kind.NORMAL, kind.USER_DEFINED) else None for p in model.pieces]
        normal = [p.piece for p in model.pieces if p.type in (kind.NORMAL, kind.USER_DEFINED)]
        if any(SPACE in p.lstrip(SPACE) for p in normal) or model.normalizer_spec.name != "identity":
            raise ValueError("vocabulary B has pieces that run into a space, or changes texts")
        model.normalizer_spec.add_dummy_prefix = False  # chunks bring their own space
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        # Words and the marks around them are aligned on their own if no piece of B joins them.
        joins = re.compile(r"[^\W\d_][.,\n]|[.,]\n|\n[^\W\d_]").search
        self.cut = (lambda c: [c]) if any(map(joins, normal)) else word_cutter(lambda c: [c])
        of_bytes = {b: i for i, b in enumerate(self.b_bytes) if b is not None and model.pieces[i].type == kind.BYTE}
        of_bytes.update((b, i) for i, b in enumerate(self.b_bytes) if b is not None and model.pieces[i].type != kind.BYTE)
        self.same = np.array([of_bytes.get(b, -1) for b in self.a_bytes], "int64")
        self.n_b = len(self.b_bytes)
        self.a_sizes = np.array([len(b) for b in self.a_bytes])
        self.b_sizes = np.array([len(b or b"") for b in self.b_bytes])
        # every id as text with what may follow it: a comma, or the end of its side of a group
        self.a_text, self.b_text = (np.array([[f"{i}{end}" for i in range(n)] for end in ends], object)
                                    for n, ends in ((len(self.a_bytes), ",|"), (self.n_b, ",;")))
        self.parts = PieceCache(self.part, PART_CACHE, cut=False)
        self.chunks = PieceCache(lambda c: self.chunk(" " + c), CHUNK_CACHE)

    def part(self, part: str) -> tuple[bytes | None, bytes | None]:
        """A and B ids as 32-bit bytes; two None if B does not spell the part."""
        return self.spelled(part, self.b.encode(part))

    def spelled(self, part: str, b: list[int]) -> tuple[bytes | None, bytes | None]:
        try:
            if b"".join(map(self.b_bytes.__getitem__, b)) != part.encode():  # A has every byte and spells anything
                return None, None
        except TypeError:  # a piece without bytes
            return None, None
        return array("I", self.a.encode_ordinary(part)).tobytes(), array("I", b).tobytes()

    def learn(self, texts: list[str | None]) -> None:
        """New chunks, their parts through B in one call, which costs half of single calls."""
        chunks = self.chunks.unknown(set().union(*[t.split(" ") for t in texts if t]))
        chunks = {c: self.cut(" " + c) for c in chunks if c and len(c) < CACHED_CHARS and c.strip() == c}
        parts = set().union(*chunks.values())
        new = [" " + c for c in self.chunks.unknown({p[1:] for p in parts if p[0] == " "})]
        new += self.parts.unknown({p for p in parts if p[0] != " "})
        new = new[:CHUNK_CACHE]
        for p, b in zip(new, self.b.encode(new, num_threads=1) if new else []):
            if p[0] == " ":  # a chunk of its own
                self.chunks.put(p[1:], self.spelled(p, b))
            else:
                self.parts.put(p, self.spelled(p, b))
        for c, cut in chunks.items():
            if len(cut) > 1:
                self.chunks.put(c, self.joined(cut))

    def chunk(self, chunk: str) -> tuple[bytes | None, bytes | None]:
        """``part`` of a chunk with its space, put together from its parts."""
        cut = self.cut(chunk)
        return self.part(chunk) if len(cut) == 1 else self.joined(cut)

    def joined(self, cut: list[str]) -> tuple[bytes | None, bytes | None]:
        """Ids of several parts, of which the first, behind a space, is a chunk of its own."""
        parts = [self.part(p) if len(p) > CACHED_CHARS else self.chunks[p[1:]] if p[0] == " " else self.parts[p] for p in cut]
        if any(p[0] is None for p in parts):
            return None, None
        return b"".join([p[0] for p in parts]), b"".join([p[1] for p in parts])

    def long(self, chunk: str) -> tuple[bytes | None, bytes | None]:
        if chunk[0].isspace() or chunk[-1].isspace():
            raise UnsafeCut
        return self.chunk(" " + chunk)

    def ids(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """A and B ids of a space and the text; None if they do not spell it."""
        chunks = text.split(" ")
        try:
            if max(map(len, chunks)) <= CACHED_CHARS:
                known = list(map(self.chunks.__getitem__, chunks))
            else:
                known = [self.chunks[c] if len(c) <= CACHED_CHARS else self.long(c) for c in chunks]
        except UnsafeCut:
            known = [self.chunk(" " + c) for c in safe_parts(text)]
        try:
            return tuple(np.frombuffer(b"".join(side), "<u4").astype("int64") for side in zip(*known))
        except TypeError:  # a None among them
            return None

    def document(self, text: str | None) -> tuple | None:
        """(n_a, n_b, n_groups, n_links, digest, identity A ids, how often, pairs, how often), or None."""
        ids = self.ids(text) if text else None
        if ids is None:
            return None
        a, b = ids
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        # the tokens after which a group ends
        a_last = b_ends[np.minimum(np.searchsorted(b_ends, a_ends), len(b) - 1)] == a_ends
        b_last = a_ends[np.minimum(np.searchsorted(a_ends, b_ends), len(a) - 1)] == b_ends
        a_to, b_to = np.flatnonzero(a_last) + 1, np.flatnonzero(b_last) + 1
        a_from, b_from = np.append(0, a_to[:-1]), np.append(0, b_to[:-1])
        a_many, b_many = a_to - a_from, b_to - b_from

        text_of = np.empty(len(a) + len(b), object)  # an A token stands behind the B tokens of earlier groups, a B token behind the A tokens so far
        text_of[np.arange(len(a)) + np.repeat(b_from, a_many)] = self.a_text[a_last.astype("int8"), a]
        text_of[np.arange(len(b)) + np.repeat(a_to, b_many)] = self.b_text[b_last.astype("int8"), b]
        digest = hashlib.sha256("".join(text_of.tolist())[:-1].encode()).hexdigest()

        identity = (a_many == 1) & (b_many == 1)
        identity[identity] = self.same[a[a_from[identity]]] == b[b_from[identity]]
        ones, ones_n = np.unique(a[a_from[identity]], return_counts=True)
        pairs, pairs_n = self.pairs_of(a, b, *(x[~identity] for x in (a_from, a_many, b_from, b_many)))
        return len(a), len(b), len(a_to), int(a_many @ b_many), digest, ones, ones_n, pairs, pairs_n

    def pairs_of(self, a, b, a_from, a_many, b_from, b_many) -> tuple[np.ndarray, np.ndarray]:
        """Distinct id pairs of groups, and how often they are linked.  Groups of
        very many links count their ids first, so none is written out link by link."""
        wide = a_many * b_many > 4_096
        pairs, count = self.narrow_pairs(a, b, *(x[~wide] for x in (a_from, a_many, b_from, b_many)))
        if wide.any():
            total = Counter(dict(zip(pairs.tolist(), count.tolist())))
            for af, an, bf, bn in zip(*(x[wide].tolist() for x in (a_from, a_many, b_from, b_many))):
                (x, m), (y, n) = np.unique(a[af:af + an], return_counts=True), np.unique(b[bf:bf + bn], return_counts=True)
                total.update(dict(zip((x[:, None] * self.n_b + y[None, :]).ravel().tolist(), (m[:, None] * n[None, :]).ravel().tolist())))
            pairs, count = np.fromiter(total, "int64", len(total)), np.fromiter(total.values(), "int64", len(total))
        return pairs, count

    def narrow_pairs(self, a, b, a_from, a_many, b_from, b_many) -> tuple[np.ndarray, np.ndarray]:
        links = a_many * b_many
        at = np.arange(links.sum()) - np.repeat(np.cumsum(links) - links, links)
        per_b = np.repeat(b_many, links)
        return np.unique(a[np.repeat(a_from, links) + at // per_b] * self.n_b + b[np.repeat(b_from, links) + at % per_b],
                         return_counts=True)


def worker_model(a: str, b: str) -> Aligner:
    """The model of both vocabularies, kept by a Python worker."""
    return kept(("Aligner", a, b), lambda: Aligner(vocabulary_path(a), vocabulary_path(b), pretoken_pattern()))


class TaskCounts:
    """Documents per pair in one task: a vector over A for identity pairs, a
    bounded dictionary for the others."""

    def __init__(self, model: Aligner):
        self.model, self.vector, self.pairs = model, np.zeros(len(model.a_bytes), "int64"), Counter()

    def add(self, ones: np.ndarray, pairs: np.ndarray) -> None:
        """A document's distinct identity ids and other pairs; a pair that is both counts once."""
        self.vector[ones] += 1
        a, b = pairs // self.model.n_b, pairs % self.model.n_b
        twice = self.model.same[a] == b
        if twice.any():
            twice[twice] = np.isin(a[twice], ones)
            pairs = pairs[~twice]
        self.pairs.update(pairs.tolist())

    def flush(self, last: bool) -> tuple[np.ndarray, np.ndarray]:
        """Pairs with their counts, handed on and forgotten; the vector only at the end."""
        pairs, n = np.fromiter(self.pairs, "int64", len(self.pairs)), np.fromiter(self.pairs.values(), "int64", len(self.pairs))
        self.pairs = Counter()
        if last:
            a = np.flatnonzero(self.vector)
            pairs = np.concatenate([pairs, a * self.model.n_b + self.model.same[a]])
            n = np.concatenate([n, self.vector[a]])
        return pairs, n


def links(docs: DataFrame, a: str = A_VOCABULARY, b: str = B_VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored table: rows of kind 0 are documents, those of kind 1 partial counts (pairs, pairs_n)."""
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int32(), *[pa.int64()] * 6, pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
        names = ["kind", "rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "ones", "ones_n", "pairs", "pairs_n"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_model(a, b)
        counts, rid = TaskCounts(model), TaskContext.get().partitionId() << 36
        for batch in without_gc(batches):
            for at in range(0, batch.num_rows, 256):
                some, rows = batch.slice(at, 256), []
                texts = some.column(1).to_pylist()
                model.learn(texts)
                for i, text in zip(some.column(0).to_pylist(), texts):
                    found = model.document(text)
                    if found is None:
                        rows.append((0, rid, i, 0, 0, 0, 0, "", [], [], [], []))
                    else:
                        counts.add(found[5], found[7])
                        rows.append((0, rid, i, *found))
                    rid += 1
                yield batch_of(rows)
                if len(counts.pairs) > FLUSH_PAIRS:
                    yield batch_of([(1, *[None] * 9, *counts.flush(last=False))])
        yield batch_of([(1, *[None] * 9, *counts.flush(last=True))])
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return d.mapInArrow(run, STORED)


def pair_counts(stored: DataFrame) -> DataFrame:
    """(pair, n): in how many documents each pair is linked."""
    rows = stored.where("kind = 1").select(F.explode(F.arrays_zip("pairs", "pairs_n")).alias("p"))
    return rows.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.pairs_n").alias("n"))


def hot_limit(counts: DataFrame, hot_pairs: int) -> int:
    """The least power of two that at most ``hot_pairs`` counts reach (from a histogram by powers of two)."""
    sizes = {r["k"]: r["count"] for r in counts.groupBy((F.length(F.bin("n")) - 1).alias("k")).count().collect()}
    limit, held = max(sizes, default=0) + 1, 0
    while limit > 0 and held + sizes.get(limit - 1, 0) <= hot_pairs:
        limit -= 1
        held += sizes.get(limit, 0)
    return 1 << limit


def align(docs: DataFrame, a: str = A_VOCABULARY, b: str = B_VOCABULARY, id_col: str = "doc_id", text_col: str = "text",
          hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    sc = docs.sparkSession.sparkContext
    stored = written(links(docs, a, b, id_col, text_col), "alignment-links", BATCH_ROWS)
    counts = written(pair_counts(stored), "alignment-counts")
    model = worker_model(a, b)
    n_b, n_a = model.n_b, len(model.a_bytes)
    best, identity = np.zeros(n_a, "int64"), np.zeros(n_a, "int64")
    for r in counts.groupBy(F.floor(F.col("pair") / n_b).cast("int").alias("a")).agg(F.max("n").alias("n")).collect():
        best[r["a"]] = r["n"]
    same = docs.sparkSession.createDataFrame([(int(x * n_b + y),) for x, y in enumerate(model.same) if y >= 0], "pair long")
    for r in counts.join(F.broadcast(same), "pair").collect():  # at most the A vocabulary
        identity[r["pair"] // n_b] = r["n"]
    limit = hot_limit(counts, hot_pairs)
    hot = counts.where(F.col("n") >= limit).toPandas().sort_values("pair")
    shared = sc.broadcast((best, identity, hot["pair"].to_numpy("int64"), hot["n"].to_numpy("int64")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, identity, hot_pair, hot_n = shared.value

        def per_row(column: pa.Array, values: np.ndarray) -> np.ndarray:
            upto = np.concatenate([[0], np.cumsum(values)])
            at = column.offsets.to_numpy()
            return upto[at[1:] - at[0]] - upto[at[:-1] - at[0]]
        for batch in batches:
            ones, ones_n, pairs, pairs_n = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("ones", "ones_n", "pairs", "pairs_n"))
            total = per_row(batch.column("ones"), identity[ones] * ones_n)
            n_best = per_row(batch.column("ones"), (identity[ones] == best[ones]) * ones_n)
            place = np.minimum(np.searchsorted(hot_pair, pairs), max(len(hot_pair) - 1, 0))
            known = hot_pair[place] == pairs if len(hot_pair) else np.zeros(len(pairs), bool)
            n = np.where(known, hot_n[place], 0) if len(hot_pair) else np.zeros(len(pairs), "int64")
            total += per_row(batch.column("pairs"), n * pairs_n)
            n_best += per_row(batch.column("pairs"), (known & (n == best[pairs // n_b])) * pairs_n)
            rows = np.repeat(np.arange(batch.num_rows), np.diff(batch.column("pairs").offsets.to_numpy()))[~known]
            ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=batch.num_rows))]).astype("int32")
            cold = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(
                [pa.array(pairs[~known]), pa.array(pairs_n[~known])], ["pair", "times"]))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")),
                 pa.array(n_best.astype("int64")), pa.array(total.astype("int64")), cold],
                ["rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum", "cold"])
    found = stored.where("kind = 0").mapInArrow(
        run, "rid long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
             "n_best long, count_sum long, cold array<struct<pair:long,times:long>>")
    out = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if limit <= 1:  # every pair's count was looked up
        return found.select(*out)
    found = written(found, "alignment-looked-up", BATCH_ROWS)
    top = docs.sparkSession.createDataFrame([(i, int(n)) for i, n in enumerate(best) if n], "a int, best long")
    rare = (found.select("rid", F.explode("cold").alias("c")).select("rid", "c.pair", "c.times")
            .join(counts.where(F.col("n") < limit), "pair")
            .join(F.broadcast(top), F.floor(F.col("pair") / n_b).cast("int") == F.col("a"))
            .groupBy("rid").agg(F.sum(F.col("n") * F.col("times")).alias("rare_sum"),
                                F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("rare_best")))
    return (found.join(rare, "rid", "left")
            .withColumn("n_best", F.col("n_best") + F.coalesce("rare_best", F.lit(0)))
            .withColumn("count_sum", F.col("count_sum") + F.coalesce("rare_sum", F.lit(0))).select(*out))
