"""Cross-tokenizer alignment (operator 13) against both libraries and plain counting."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

import helpers as H
from lectern.llm import alignment as A
from test_tokens import odd_texts


@pytest.fixture(scope="module")
def libraries():
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {b: chr(b) for b in own}
    chars.update({b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in own)})
    back = {c: b for b, c in chars.items()}
    s = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    a_bytes = lambda i: bytes(back[c] for c in t.id_to_token(i))

    def b_bytes(i):
        piece = s.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if s.is_byte(i) else piece.replace("▁", " ").encode()
    return t, s, a_bytes, b_bytes


def groups_of(text, libraries):
    """List of (A ids, B ids), or None."""
    t, s, a_bytes, b_bytes = libraries
    if not text:
        return None
    a, b = t.encode(" " + text, add_special_tokens=False).ids, s.encode(text)
    ends = []
    for ids, of in ((a, a_bytes), (b, b_bytes)):
        if b"".join(map(of, ids)) != (" " + text).encode():
            return None
        at, e = 0, []
        for i in ids:
            at += len(of(i))
            e.append(at)
        ends.append(e)
    cuts = sorted(set(ends[0]) & set(ends[1]))
    out, i, k = [], 0, 0
    for c in cuts:
        i2, k2 = ends[0].index(c, i) + 1, ends[1].index(c, k) + 1
        out.append((a[i:i2], b[k:k2]))
        i, k = i2, k2
    return out


def brute(rows, libraries):
    found = [(i, groups_of(t, libraries)) for i, t in rows]
    count = Counter()
    for _, g in found:
        count.update({(x, y) for a, b in g or () for x in a for y in b})
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    out = []
    for i, g in found:
        links = [(x, y) for a, b in g or () for x in a for y in b]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g or ())
        out.append((i, sum(len(a) for a, _ in g or ()), sum(len(b) for _, b in g or ()), len(g or ()), len(links),
                    sum(count[x] == best[x[0]] for x in links), sum(count[x] for x in links),
                    hashlib.sha256(text.encode()).hexdigest() if g else ""))
    return sorted(out, key=repr)


def got(df):
    return H.by_id(df, "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def rows():
    texts = odd_texts(400)[:-1] + ["a▁b", "<s> x </s> <unk>", "<|endoftext|>", "漢字かな交じり文", "é \U0001f468‍\U0001f469 x", "a.b,c\nd e.", "Word,\nword."]
    return [(i, t) for i, t in enumerate(texts + H.prose(120))] + [(1, "again one id"), (None, "no id"), (3, None)]


@pytest.mark.parametrize("hot", [300_000, 40, 0])
def test_against_the_libraries(spark, libraries, hot, monkeypatch):
    monkeypatch.setattr(A, "FLUSH_PAIRS", 50)
    some = rows()
    docs = H.table(spark, [(i, t, "en", "a") for i, t in some]).repartition(5)
    assert got(A.align(docs, hot_pairs=hot)) == brute(some, libraries)


def test_given_table(spark, libraries):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    some = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert got(A.align(docs)) == brute(some, libraries)


def test_long_text_and_empty_table(spark, libraries):
    some = [(1, H.LONG), (2, "x" * 30_000 + " y"), (3, "word " * 20_000)]
    assert got(A.align(H.table(spark, [(i, t, "en", "a") for i, t in some]))) == brute(some, libraries)
    assert A.align(H.empty(spark)).collect() == []


def test_new_chunks_are_cut_and_kept_at_once(libraries):
    model = A.Aligner(P.path(A.A_VOCABULARY), P.path(A.B_VOCABULARY), P.PATTERN)
    texts = ["one two, three", "two,\nthree one.", None, "", "a\u2581b one"]
    model.learn(texts)
    assert model.chunks.unknown({c for t in texts if t for c in t.split(" ")}) == set()
    for t in texts:
        want = groups_of(t, libraries)
        ids = model.ids(t) if t else None
        assert (ids is None) == (want is None)
        assert want is None or [i.tolist() for i in ids] == [[x for g in want for x in g[side]] for side in (0, 1)]
