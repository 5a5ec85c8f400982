"""Token ids written as ORC and read back (operator 2).

Texts are put in ascending id order by a range partitioning (small keys are
sampled, texts cross one shuffle), encoded in that order, and written as ORC:
ids as an integer list column, which ORC run-length encodes, stripes that can
be read in parallel, row indexes every ``ROW_INDEX`` rows and a Bloom filter on
the document id, so a lookup skips files, stripes and row groups by metadata.
Each task numbers its tokens from 0; the number of tokens before a task comes
from one small sum per task when the files are read.

Edge cases: NULL and empty texts are just the end id; a NULL document id sorts
first; rows with the same id are ordered by text and each keep their row; an
empty table writes no rows; input columns beside the two named are ignored;
special token strings in a text are read as the library's plain call reads
them, or as ordinary text with ``special_as_text``.
"""

from __future__ import annotations

import codecs
import uuid
import zlib
from array import array
from collections.abc import Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.bpe import byte_characters, pretoken_pattern, vocabulary_path
from lectern.llm.chunks import PieceCache, UnsafeCut, run_cutter, safe_parts, without_gc, word_and_marks
from lectern.llm.common import kept, written
from lectern.session import ensure_checkpoint_dir

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
TOKEN_CACHE, CHUNK_CACHE = 200_000, 550_000     # entries of a generation, two are kept
ROW_INDEX = 1_000
STRIPE_BYTES = 64 << 20
ORC_OPTIONS = {"compression": "zstd", "orc.stripe.size": str(STRIPE_BYTES), "orc.row.index.stride": str(ROW_INDEX),
               "orc.create.index": "true", "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01"}
ID = attrgetter("id")
SCHEMA = "doc_id long, part int, before long, n_tokens int, ids array<int>"


class JsonBpe:
    """The tokenizers library over one vocabulary file: the plain call
    ``encode(text, add_special_tokens=False)``, fed with new words only.

    A text is cut into chunks before single spaces and a chunk into pre-tokens;
    each new pre-token goes through the library's BPE model.  Chunks are cached,
    and so are pre-tokens that are no word behind a space: such a word is a chunk
    of its own, and most new ones never come back.  Texts that hold a special token's string, which the plain call
    reads as that token, go through the library whole, unless
    ``special_as_text`` makes them ordinary text.
    """

    def __init__(self, path: str, pattern: str, special_as_text: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.special = () if special_as_text else tuple(
            t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.cut = run_cutter(pattern)
        self.to_chars = "".join(byte_characters())
        self.tokenize = self.tokenizer.model.tokenize
        self.tokens = PieceCache(self.token_ids, TOKEN_CACHE, cut=False)
        self.chunks = PieceCache(self.chunk, CHUNK_CACHE)
        self.space = self.to_chars[0x20]

    def mapped_ids(self, mapped: str) -> bytes:
        return array("I", list(map(ID, self.tokenize(mapped)))).tobytes()

    def token_ids(self, token: str) -> bytes:
        return self.mapped_ids(codecs.charmap_decode(token.encode(), "strict", self.to_chars)[0])

    def chunk(self, chunk: str) -> bytes:
        """Ids of a chunk behind a space.  Letters are one pre-token, and so are the marks behind them."""
        if chunk.isascii() and chunk.isalpha():  # letters stand for themselves
            return self.mapped_ids(self.space + chunk)
        m = word_and_marks(chunk)
        if m is None:
            return self.pieces(" " + chunk)
        word, marks = m.groups()
        return self.chunks[word] + self.tokens[marks] if marks else self.token_ids(" " + word)

    def pieces(self, chunk: str) -> bytes:
        """Ids of a chunk with its leading space."""
        return b"".join([self.tokens[t] for t in self.cut(chunk)])

    def ids(self, text: str) -> bytes:
        for s in self.special:
            if s in text:
                return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        parts = text.split(" ")
        try:
            if len(parts) > 1 and (not parts[0] or parts[0][-1].isspace()):
                raise UnsafeCut
            return self.pieces(parts[0]) + b"".join(map(self.chunks.__getitem__, parts[1:]))
        except UnsafeCut:
            parts = safe_parts(text)
            return b"".join([self.pieces((" " if k else "") + p) for k, p in enumerate(parts)])

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        return (self.ids(t or "") for t in texts)


def worker_model(path: str, special_as_text: bool = False) -> JsonBpe:
    """The vocabulary's model, kept by a Python worker."""
    return kept(("JsonBpe", path, special_as_text), lambda: JsonBpe(path, pretoken_pattern(), special_as_text))


def encode_in_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    vocabulary: str = VOCABULARY, end_id: int = END_ID, special_as_text: bool = False) -> DataFrame:
    """(doc_id, part, before, n_tokens, ids) in ascending id order over the partitions;
    ``before`` counts the ids of the earlier documents of the same partition."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, part, before = worker_model(vocabulary_path(vocabulary), special_as_text), TaskContext.get().partitionId(), 0
        for batch in without_gc(batches):
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                ids = list(model.encode(some.column(1).to_pylist()))
                ends = np.cumsum([0] + [len(b) // 4 + 1 for b in ids])
                flat = np.frombuffer(end.join([*ids, b""]), "<i4")
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(np.full(len(ids), part, "int32")), pa.array(before + ends[:-1]),
                     pa.array(np.diff(ends).astype("int32")), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                    ["doc_id", "part", "before", "n_tokens", "ids"])
                before += int(ends[-1])
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return d.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(run, SCHEMA)


def write_ids(docs: DataFrame, path: str, **options) -> None:
    encode_in_order(docs, **options).write.options(**ORC_OPTIONS).orc(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, part, before, n_tokens, ids); a filter on doc_id reaches the ORC metadata."""
    return spark.read.schema(SCHEMA).orc(path)


def offsets(stored: DataFrame) -> DataFrame:
    """(part, part_start): ids before each part; one row per written part."""
    ends = stored.groupBy("part").agg(F.max(F.col("before") + F.col("n_tokens")).alias("n"))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return ends.select("part", F.coalesce(F.sum("n").over(upto), F.lit(0)).cast("long").alias("part_start"))


def checksums(stored: DataFrame) -> DataFrame:
    """(doc_id, part, before, n_tokens, ids_crc32) from the stored ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            values = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False).astype("<u4"))
            at = lists.offsets.to_numpy()
            crc = [zlib.crc32(values[a:b]) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2),
                                              pa.array(np.diff(at).astype("int64")), pa.array(crc, pa.int64())],
                                             ["doc_id", "part", "before", "n_tokens", "ids_crc32"])
    return stored.select("doc_id", "part", "before", "ids").mapInArrow(run, "doc_id long, part int, before long, n_tokens long, ids_crc32 long")


def store_and_check(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write the files (under the shared folder unless a path is given), read
    them back, and return (doc_id, start, n_tokens, ids_crc32)."""
    spark = docs.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/lectern-ids-{uuid.uuid4().hex}"
    write_ids(docs, path, **options)
    stored = read_ids(spark, path)
    starts = written(offsets(stored), "id-offsets")
    return (checksums(stored).join(starts, "part", "left")
            .select("doc_id", (F.col("before") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32"))
