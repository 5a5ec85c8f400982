"""Benchmark decontamination with an Aho-Corasick automaton (operator 11).

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased.
The windows of a benchmark item are its ``WINDOW`` consecutive words, or all of
them if it has fewer.  All distinct windows go into one automaton over word
numbers; every document text is read once, its words are numbered (0 for a word
that no item has), and the automaton names every window that ends at a word.
Hits are word intervals, mapped back to code points of the original text.

The items reach the workers as a broadcast of bounded size: long items are cut
into overlapping segments of ``SEGMENT`` windows, and segments are dealt by hash
into as many shards as keep one automaton at about ``SHARD_WINDOWS`` windows
(and ``SHARD_BYTES`` of words).  Usually that is one shard.  More shards are
scanned one after the other, each adding its hits and items to a table in the
shared folder, so neither the driver nor a worker ever holds more than one.

Edge cases: NULL and wordless texts have no words and no hits; items without
words have no windows; items of a NULL id mark words as hit but are not listed;
an id that occurs on several item rows is one item; repeated documents each
keep their row; without items or documents nothing is hit or returned; input
columns beside the two named ones of each table are ignored.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import kept, slices, written

WINDOW = 10                 # words
SEGMENT = 5_000             # windows of one item row that stay together
SHARD_WINDOWS = 200_000     # windows of one automaton, about 150 bytes a word of each
SHARD_BYTES = 32 << 20
BATCH_ROWS = 1_000          # of an Arrow batch that carries texts between shards

# Byte by byte on UTF-8: A-Z to a-z, other ASCII but digits and a-z to a space; bytes of longer characters stay.
_NORMAL = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b > 0x7F or chr(b).isalnum() else 0x20 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

SCANNED = "id {id}, text binary, n_words long, hits array<int>, items array<string>"


def split_words(text: bytes | None) -> list[bytes]:
    """Normalised words of a UTF-8 text."""
    return text.translate(_NORMAL).split() if text else []


def windows(words: list[bytes], size: int) -> list[tuple[bytes, ...]]:
    return [tuple(words[i:i + size]) for i in range(max(len(words) - size, 0) + 1)] if words else []


def segments(items: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(item, words, n_windows): distinct segments of the items' normalised words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, parts, n = [], [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = split_words(text)
                for at in range(0, max(len(words) - size, 0) + 1 if words else 0, SEGMENT):
                    part = words[at:at + SEGMENT + size - 1]
                    ids.append(item)
                    parts.append(b" ".join(part))
                    n.append(max(len(part) - size, 0) + 1)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(parts, pa.binary()), pa.array(n, pa.int64())],
                                             ["item", "words", "n_windows"])
    d = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return d.mapInArrow(run, "item string, words binary, n_windows long").distinct()


class Matcher:
    """The automaton over the windows of one shard's segments."""

    def __init__(self, rows: list[tuple[str | None, bytes]], size: int):
        import ahocorasick

        self.number = _Numbers()
        items: dict[tuple[int, ...], set[str]] = {}
        for item, words in rows:
            numbered = [self.number.setdefault(w, len(self.number) + 1) for w in words.split(b" ")]
            for window in windows(numbered, size):
                items.setdefault(window, set()).update(() if item is None else (item,))
        self.items = list(items.values())
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE) if items else None
        for k, window in enumerate(items):
            self.automaton.add_word(window, (len(window), k))
        if items:
            self.automaton.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """(first word, after last word) of every window that occurs, and the items with such windows."""
        if self.automaton is None or not words:
            return [], set()
        hits, found = [], set()
        for end, (n, k) in self.automaton.iter(tuple(map(self.number.__getitem__, words))):
            hits.append((end + 1 - n, end + 1))
            found.add(k)
        return hits, set().union(*[self.items[k] for k in found]) if found else set()


class _Numbers(dict):
    """Word numbers from 1; a word of no item is 0 and not stored."""

    def __missing__(self, word: bytes) -> int:
        return 0


def worker_matcher(key: str, shard, size: int) -> Matcher:
    """The shard's automaton, kept by a Python worker."""
    return kept(("Matcher", key), lambda: Matcher(shard.value, size))


def merged(hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint intervals in ascending order; touching ones are joined."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(hits):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def offsets(text: str, intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Code-point spans of word intervals (ascending, disjoint)."""
    starts, ends = {a for a, _ in intervals}, {b - 1 for _, b in intervals}
    at = [(m.start() if k in starts else None, m.end() if k in ends else None) for k, m in enumerate(_WORD.finditer(text))
          if k in starts or k in ends]
    return list(zip([a for a, _ in at if a is not None], [b for _, b in at if b is not None]))


def _scan(docs: DataFrame, rows: list, size: int, first: bool, last: bool) -> DataFrame:
    """One shard over all documents.  ``docs`` has id, text and, unless first,
    the hits (flat word intervals) and items so far; the text is handed on
    unless last."""
    sc, key = docs.sparkSession.sparkContext, uuid.uuid4().hex
    shard = sc.broadcast(rows)
    id_type = dict(docs.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = worker_matcher(key, shard, size).scan
        for batch in slices(batches):
            texts, n, intervals, items, spans = batch.column(1).to_pylist(), [], [], [], []
            before = [[]] * len(texts) if first else batch.column("hits").to_pylist()
            named = [[]] * len(texts) if first else batch.column("items").to_pylist()
            for text, old, old_items in zip(texts, before, named):
                words = split_words(text)
                hits, found = scan(words)
                hits = merged(hits + list(zip(old[::2], old[1::2])))
                n.append(len(words))
                items.append(sorted(found.union(old_items)))
                intervals.append([x for ab in hits for x in ab])
                spans.append([{"start": a, "end": b} for a, b in offsets(text.decode("utf-8", "replace"), hits)] if last and hits else [])
            head = [batch.column(0), pa.array(n, pa.int64())]
            if last:
                n_hit = [sum(x[1::2]) - sum(x[::2]) for x in intervals]
                yield pa.RecordBatch.from_arrays(
                    [*head, pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                    ["id", "n_words", "n_hit", "items", "spans"])
            else:
                yield pa.RecordBatch.from_arrays(
                    [head[0], batch.column(1), head[1], pa.array(intervals, pa.list_(pa.int32())), pa.array(items, pa.list_(pa.string()))],
                    ["id", "text", "n_words", "hits", "items"])
    schema = (f"id {id_type}, n_words long, n_hit long, items array<string>, spans array<struct<start:int,end:int>>" if last
              else SCANNED.format(id=id_type))
    return docs.mapInArrow(run, schema)


def find(docs: DataFrame, items: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
         item_id_col: str = "item_id", item_text_col: str = "text", shard_windows: int = SHARD_WINDOWS) -> DataFrame:
    """(id, n_words, n_hit, items, spans): per document its words, those inside
    an occurring window, the ids of items with occurring windows sorted as
    strings, and the hit stretches as code points of the text."""
    parts = written(segments(items, item_id_col, item_text_col, size), "benchmark-segments")
    total = parts.agg(F.sum("n_windows"), F.sum(F.length("words"))).first()
    n = max(1, math.ceil((total[0] or 0) / shard_windows), math.ceil((total[1] or 0) / SHARD_BYTES))
    dealt = F.pmod(F.xxhash64("item", "words"), F.lit(n))
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    for k in range(n):
        rows = [(r["item"], bytes(r["words"])) for r in parts.where(dealt == k).select("item", "words").collect()]
        d = _scan(d, rows, size, first=k == 0, last=k == n - 1)
        if k < n - 1:
            d = written(d, "benchmark-hits", BATCH_ROWS)
    return d


def remove(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents, columns unchanged, without those that hold a window of an item.
    A document's id names it: rows that repeat an id of a hit document go too."""
    hit = written(find(docs, items, **options).where("n_hit > 0").select("id").distinct(), "benchmark-hit-ids")
    key = docs[options.get("id_col", "doc_id")]
    return docs.join(hit, key.eqNullSafe(hit["id"]), "left_anti")
