"""Byte-level BPE through a sentencepiece model built from the vocabulary (operator 9).

The rank file is turned into a sentencepiece BPE model without any training:
each byte string becomes a piece written with one printable character per
byte, scored by its negative rank, under the identity normaliser.  Merging the
best-scored pair first is then merging the lowest rank first, leftmost on
ties, as the rank file asks.  Texts are cut into pre-tokens by the vocabulary's
pattern, each pre-token is encoded on its own, and ids are decoded by the
inverse mapping from piece to bytes.

Edge cases: NULL and empty texts have no ids and decode to no bytes; special
token strings are ordinary text; repeated rows and ids each keep their row;
very long texts are cut at safe places (``chunks``); lone surrogates cannot
occur in Spark strings; input columns beside the two named ones are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lectern.llm.chunks import ChunkCache, groups, pre_token_cutter
from lectern.llm.common import kept, slices

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def byte_characters() -> list[str]:
    """One printable, non-space character per byte: the byte's own Latin-1
    character where that is printable, else the next one from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """The serialised sentencepiece model: piece id = rank."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    chars = byte_characters()
    m = pb.ModelProto()
    for rank, (piece, own) in enumerate(sorted(ranks.items(), key=lambda x: x[1])):
        if rank != own:
            raise ValueError(f"ranks are not consecutive at {own}")
        m.pieces.add(piece="".join(chars[b] for b in piece), score=-float(rank),
                     type=pb.ModelProto.SentencePiece.NORMAL)
    m.pieces.add(piece="<unk>", score=0.0, type=pb.ModelProto.SentencePiece.UNKNOWN)
    t, n = m.trainer_spec, m.normalizer_spec
    t.model_type, t.vocab_size, t.unk_id = pb.TrainerSpec.BPE, len(m.pieces), len(m.pieces) - 1
    t.bos_id = t.eos_id = t.pad_id = -1
    n.name, n.add_dummy_prefix, n.remove_extra_whitespaces, n.escape_whitespaces = "identity", False, False, False
    return m.SerializeToString()


class ByteBpe:
    """Encoder and decoder over one vocabulary; built once per Python worker."""

    def __init__(self, path: str, pattern: str):
        import sentencepiece

        ranks = read_ranks(path)
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(ranks))
        self.pre_tokens = pre_token_cutter(pattern)
        self.to_chars = dict(enumerate(byte_characters()))
        self.pieces = [b for b, _ in sorted(ranks.items(), key=lambda x: x[1])]
        self.cache = ChunkCache(self.encode_chunks, limit=250_000)
        self.digits = [str(i) for i in range(len(self.pieces))]

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        cut = list(map(self.pre_tokens, chunks))
        tokens = list(set().union(*cut))
        mapped = [t.encode("utf-8").decode("latin-1").translate(self.to_chars) for t in tokens]
        ids = self.processor.encode(mapped, num_threads=1) if mapped else []
        of = dict(zip(tokens, (array("I", i).tobytes() for i in ids)))
        return [of[c[0]] if len(c) == 1 else b"".join(map(of.__getitem__, c)) for c in cut]

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        for some in groups([t or "" for t in texts]):
            for ids in self.cache.ids(some):
                yield np.frombuffer(ids, dtype="<u4")

    def decode(self, ids) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))


def worker_model(path: str, pattern: str) -> ByteBpe:
    """The vocabulary's model, kept by a Python worker."""
    return kept(("ByteBpe", path, pattern), lambda: ByteBpe(path, pattern))


def vocabulary_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def pretoken_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text",
           id_type: str = "long") -> DataFrame:
    """(doc_id, ids array<int>): token ids of every whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_model(vocabulary_path(vocabulary), pretoken_pattern())
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [i.astype("int32") for i in model.encode(part.column(1).to_pylist())]
                ends = np.cumsum([0] + [len(i) for i in ids], dtype="int32")
                flat = np.concatenate(ids) if ids else np.empty(0, "int32")
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                                                 ["doc_id", "ids"])
    d = docs.select(docs[id_col].cast(id_type).alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return d.mapInArrow(run, f"doc_id {id_type}, ids array<int>")


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, text binary) from (doc_id, ids): the inverse mapping."""
    id_type = dict(encoded.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_model(vocabulary_path(vocabulary), pretoken_pattern())
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = [model.decode(i.values.to_numpy(zero_copy_only=False).tolist()) if i.is_valid else None
                       for i in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.binary())], ["doc_id", "text"])
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {id_type}, text binary")


def with_ids(docs: DataFrame, keep: list[str], vocabulary: str = VOCABULARY, text_col: str = "text") -> DataFrame:
    """The named columns with ids array<int>, n_tokens and decoded_sha256, the
    digest of the bytes that the ids decode to."""
    schema = T.StructType([docs.schema[c] for c in keep]).add("ids", T.ArrayType(T.IntegerType())).add("n_tokens", "long").add("decoded_sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_model(vocabulary_path(vocabulary), pretoken_pattern())
        for part in slices(batches, 256):
            ids = [i.astype("int32") for i in model.encode(part.column(len(keep)).to_pylist())]
            ends = np.cumsum([0] + [len(i) for i in ids], dtype="int32")
            back = [hashlib.sha256(model.decode(i.tolist())).hexdigest() for i in ids]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-1], pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids))),
                 pa.array(np.diff(ends).astype("int64")), pa.array(back, pa.string())], [*keep, "ids", "n_tokens", "decoded_sha256"])
    return docs.select(*[docs[c] for c in keep], docs[text_col].cast("string").alias("_bpe_text")).mapInArrow(run, schema)


def digests(docs: DataFrame, vocabulary: str = VOCABULARY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode, then decode the
    ids, in one pass so that neither ids nor bytes leave the worker."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = worker_model(vocabulary_path(vocabulary), pretoken_pattern())
        for batch in batches:
            n, h, back = [], [], []
            for array_of_ids in model.encode(batch.column(1).to_pylist()):
                ids = array_of_ids.tolist()
                n.append(len(ids))
                h.append(hashlib.sha256(",".join(map(model.digits.__getitem__, ids)).encode()).hexdigest())
                back.append(hashlib.sha256(model.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(h, pa.string()),
                                              pa.array(back, pa.string())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    d = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return d.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
