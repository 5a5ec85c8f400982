"""Token ids (operators 2 and 9) against the libraries themselves."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

import helpers as H
from lectern.llm import bpe, token_output
from lectern.llm.chunks import groups, run_cutter, word_and_marks


@pytest.fixture(scope="module")
def tik():
    ranks = bpe.read_ranks(P.path(bpe.VOCABULARY))
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def hug():
    return Tokenizer.from_file(P.path(token_output.VOCABULARY))


def odd_texts(n=3000):
    r = random.Random(7)
    parts = ["a", "b'", "'s", " ", " ", "\n", "\t", " ", "　", "é", "1", "٣", "漢", "!", "?", "\x1c", "\x85", "word", " word,", "\n\n"]
    return ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(n)] + [
        "", " ", "  a", "a ", "<|endoftext|>", " <|endoftext|> x", "a\n b", "\n\na  b", " a", H.LONG]


def test_sentencepiece_model_equals_rank_merges(tik):
    model = bpe.worker_model(P.path(bpe.VOCABULARY), P.PATTERN)
    texts = odd_texts()
    for text, ids in zip(texts, model.encode(texts)):
        assert ids.tolist() == tik.encode_ordinary(text)
        assert model.decode(ids.tolist()) == text.encode()


def test_joined_chunks_equal_whole_texts(hug):
    model = token_output.worker_model(P.path(token_output.VOCABULARY))
    texts = odd_texts()
    for text, ids in zip(texts, model.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == hug.encode(text, add_special_tokens=False).ids


def test_special_tokens_as_the_plain_call_reads_them(hug):
    text = "a <|endoftext|> b"
    plain = token_output.worker_model(P.path(token_output.VOCABULARY))
    assert np.frombuffer(plain.ids(text), "<u4").tolist() == hug.encode(text, add_special_tokens=False).ids == [64, 220, 50256, 275]
    ordinary = token_output.worker_model(P.path(token_output.VOCABULARY), special_as_text=True)
    assert np.frombuffer(ordinary.ids(text), "<u4").tolist() == [64, 1279, 91, 437, 1659, 5239, 91, 29, 275]


def test_small_caches_give_the_same_ids(hug, monkeypatch):
    monkeypatch.setattr(token_output, "TOKEN_CACHE", 7)
    monkeypatch.setattr(token_output, "CHUNK_CACHE", 5)
    model = token_output.JsonBpe(P.path(token_output.VOCABULARY), P.PATTERN)
    texts = odd_texts(500) + H.prose(200)
    for text, ids in zip(texts, model.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == hug.encode(text, add_special_tokens=False).ids


def test_plain_runs_equal_the_pattern():
    import regex

    r, cut, pattern = random.Random(3), run_cutter(P.PATTERN), regex.compile(P.PATTERN).findall
    parts = ["a", "B", "é", "×", "1", "23", "٣", "!", "#", "'", "'s", "s", "t", "\n", "\t", "_", "~", "漢", "ª", "²", "\x7f"]
    for _ in range(20_000):
        chunk = "".join(r.choice(parts) for _ in range(r.randint(1, 7))).strip()
        if chunk:
            assert cut(chunk) == pattern(chunk) and cut(" " + chunk) == pattern(" " + chunk)
            if m := word_and_marks(chunk):
                assert [" " + m[1], *filter(None, [m[2]])] == pattern(" " + chunk)
    assert cut("a" * 50_000 + "漢") == ["a" * 50_000 + "漢"]


def test_a_word_is_kept_in_one_cache():
    model = token_output.JsonBpe(P.path(token_output.VOCABULARY), P.PATTERN)
    list(model.encode(H.prose(50) + ["some, words! with### marks", "marks some with words"]))
    assert {"some", "with", "marks", "words"} <= set(model.chunks)
    assert not {" " + c for c in model.chunks} & set(model.tokens)


def test_cache_limit_does_not_change_ids(tik):
    model = bpe.ByteBpe(P.path(bpe.VOCABULARY), P.PATTERN)
    model.cache.limit = 50
    texts = H.prose(400)
    assert [i.tolist() for i in model.encode(texts)] == [tik.encode_ordinary(t) for t in texts]


def test_groups_keep_order_and_bounds():
    texts = ["x" * n for n in (1, 50, 3, 3, 3, 200, 1)]
    got = list(groups(texts, rows=3, chars=60))
    assert [t for g in got for t in g] == texts
    assert all(len(g) <= 3 and (len(g) == 1 or sum(map(len, g)) <= 60) for g in got)


def test_digests_of_odd_rows(spark, tik):
    got = H.by_id(bpe.digests(H.table(spark, H.odd_rows())), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    want = []
    for i, t, _, _ in H.odd_rows():
        ids = tik.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert bpe.digests(H.empty(spark)).count() == 0


def test_encode_then_decode_is_the_text(spark):
    docs = H.table(spark, H.odd_rows())
    got = H.by_id(bpe.decode(bpe.encode(docs)), "doc_id", "text")
    assert [(i, bytes(t)) for i, t in got] == sorted(((i, (t or "").encode()) for i, t, _, _ in H.odd_rows()), key=repr) or \
        sorted((repr(i), bytes(t)) for i, t in got) == sorted((repr(i), (t or "").encode()) for i, t, _, _ in H.odd_rows())


def test_orc_starts_and_checksums(spark, hug, tmp_path):
    texts = H.prose(300)
    docs = H.table(spark, [(i, t, "en", "a") for i, t in enumerate(texts)]).repartition(7)
    path = f"{tmp_path}/ids"
    got = {r["doc_id"]: r for r in token_output.store_and_check(docs, path).collect()}
    start = 0
    for i, t in enumerate(texts):
        ids = hug.encode(t, add_special_tokens=False).ids + [0]
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    one = token_output.read_ids(spark, path).where("doc_id = 17").select("ids").first()[0]
    assert one == hug.encode(texts[17], add_special_tokens=False).ids + [0]


def test_orc_odd_and_empty(spark):
    got = token_output.store_and_check(H.table(spark, H.odd_rows())).collect()
    assert len(got) == len(H.odd_rows())
    rows = sorted(got, key=lambda r: r["start"])
    at = 0
    for r in rows:  # starts are gapless, ids ascending with NULL first
        assert r["start"] == at
        at += r["n_tokens"]
    assert [r["doc_id"] for r in rows][0] is None and [r["doc_id"] for r in rows][1:] == sorted(r["doc_id"] for r in rows[1:])
    assert token_output.store_and_check(H.empty(spark)).count() == 0
