"""Spelling variants (operator 12) against comparison of all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import helpers as H
from lectern.llm import spelling as S
from lectern.llm.queries import op12_spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def near(a, b):
    """One edit, by trying all deletions and replacements."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(count, ratio=5):
    rows = {}
    for w, n in count.items():
        close = [x for x in count if near(w, x)]
        best = min(close, key=lambda x: (-count[x], x), default=None)
        form = best if best is not None and count[best] >= ratio * n else None
        rows[w] = (form, n, len(close), None if form is None else count[form])
    def root(w):
        return w if rows[w][0] is None else root(rows[w][0])
    return sorted((w, f, root(w), n, k, fn) for w, (f, n, k, fn) in rows.items())


def got(df):
    return sorted((r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect())


def words_table(spark, count):
    return spark.createDataFrame(list(count.items()), "word string, n long")


def vocabulary(n, seed=3):
    r, out = random.Random(seed), {}
    base = ["".join(r.choice("abcdeé") for _ in range(r.randint(6, 9))) for _ in range(n)]
    for w in base:
        out[w] = r.randint(5, 2000)
        for _ in range(2):
            i = r.randrange(len(w))
            v = r.choice([w[:i] + w[i + 1:], w[:i] + r.choice("abcdeéÿ") + w[i + 1:], w[:i] + r.choice("abc") + w[i:]])
            if len(v) >= 6:
                out[v] = r.choice([5, 5, 10, 100, 3000])
    return out


@pytest.mark.parametrize("sizes", [{}, {"leaf_words": 20}, {"leaf_words": 15, "group_rows": 7}])
def test_against_all_pairs(spark, sizes):
    count = vocabulary(150)
    assert got(S.group(words_table(spark, count), **sizes)) == brute(count)


def test_anagrams_and_chains(spark):
    r = random.Random(1)
    count = {"".join(r.sample("abcdefgh", 8)): r.randint(5, 9000) for _ in range(300)}
    count.update({w[:3] + "z" + w[4:]: 5 for w in list(count)[:40]})
    chain = "abcdefghij"
    count.update({chain[:k] + "x" * (10 - k): 5 * 5 ** k for k in range(11)})  # 11 links, each five times the one before
    rows = got(S.group(words_table(spark, count), leaf_words=50))
    assert rows == brute(count)
    assert {r[2] for r in rows if r[0] == "x" * 10} == {chain}


def test_reached_boxes_hold_every_edit():
    words = sorted(vocabulary(300))
    seven = [w for w in words if len(w) == 7]
    tree = S.grow(S.letter_counts(seven), 16)
    home = {}
    for leaf, rows, own in S.reached(tree, S.letter_counts(seven), 1):
        if own:
            home.update({seven[k]: leaf for k in rows})
    assert len(home) == len(seven) and len(set(home.values())) > 8
    boxes = {}
    for size, minus in ((7, 1), (6, 0)):
        some = [w for w in words if len(w) == size]
        for leaf, rows, _ in S.reached(tree, S.letter_counts(some), minus):
            for k in rows:
                boxes.setdefault(some[k], set()).add(leaf)
    asked = sum(map(len, boxes.values()))
    assert all(home[p] in boxes[w] for w in boxes for p in seven if near(w, p))
    assert asked < len(boxes) * 16 * 0.8  # boxes are pruned


def test_search_equals_full_distance():
    v = np.unique(S.letter_counts(sorted(w for w in vocabulary(200) if len(w) == 7)), axis=0)
    for q, minus in ((v, 1), (np.unique(S.letter_counts(sorted(w for w in vocabulary(200) if len(w) == 6)), axis=0), 0)):
        found = {(int(a), int(b)) for x, y in S.search(v, q, minus) for a, b in zip(x, y)}
        diff = v[None] - q[:, None]
        want = (np.maximum(diff, 0).sum(2) == 1) & (np.maximum(-diff, 0).sum(2) == minus)
        assert found == {(int(a), int(b)) for a, b in zip(*np.nonzero(want))}


def test_bulk_comparison_equals_one_edit():
    words = sorted(vocabulary(120))
    for size in (6, 7):
        short, long = [w for w in words if len(w) == size], [w for w in words if len(w) in (size, size + 1)]
        for n in (size, size + 1):
            pairs = [(a, b) for a in short for b in long if len(b) == n and a != b]
            got = S.edited_once(S.letters([a for a, _ in pairs]), S.letters([b for _, b in pairs]))
            assert got.tolist() == [near(a, b) for a, b in pairs] == [S.one_edit(a, b) for a, b in pairs] and any(got)


def counted(rows):
    count = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            w = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 199 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 6:
                count[w] += 1
    return {w: n for w, n in count.items() if n >= 5}


def test_query_on_the_smallest_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    count = counted([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert len(count) > 100
    assert got(op12_spelling(spark, "/root/testdata/sf0.001")) == brute(count)


def test_odd_rows_long_words_and_empty(spark, tmp_path):
    long = "x" * 30_000
    rows = H.odd_rows() + [(20, " ".join([long, long + "y", long[:-1] + "z"] * 5) + " Größeren größeren GRößeren größeren größeren grösseren", "de", "a"),
                           (21, "abcdef ABCDEF abcdef9abcdef abcdef àbcdef×÷ñ " * 5, "en", "a")]
    H.table(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    assert got(op12_spelling(spark, str(tmp_path))) == brute(counted([(r[0], r[1]) for r in rows]))
    H.empty(spark).write.parquet(f"{tmp_path}/e/documents.parquet")
    assert op12_spelling(spark, f"{tmp_path}/e").collect() == []
