"""Exact top-k (8), near-duplicate classes (10), license scan (6) against brute force; the pipeline."""

import math
import random

import numpy as np
import pytest

import corpus_pipeline
import helpers as H
from lectern.llm import jaccard, langid, license_scan, pii, topk
from pyspark.sql import functions as F


def brute_topk(rows, k):
    v = [(i, [math.floor(1024 * x) for x in e]) for i, e in rows
         if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for at, (q, a) in enumerate(v):
        if q % 100 == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b)), i) for n, (i, b) in enumerate(v) if n != at)[:k]
            out += [(q, n + 1, i, -x) for n, (x, i) in enumerate(s)]
    return sorted(out)


@pytest.mark.parametrize("block,pack", [(16, 512), (16, 3)])
def test_topk_equals_brute_force(spark, monkeypatch, block, pack):
    r = np.random.default_rng(3)
    centre = r.normal(0, 1, (6, 12))
    rows = [(i, (centre[i % 6] + r.normal(0, 0.2, 12)).round(3).tolist()) for i in range(700)]
    rows += [(1000 + i, rows[0][1]) for i in range(120)] + [(5000, None), (5100, [float("nan")] * 12), (5200, [None] * 12),
                                                             (5300, [float("inf")] + [0.0] * 11), (None, [1.0] * 12), (5400, [0.5, 0.5]), (5401, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' AS block", "1 AS score", "1 AS row")
    monkeypatch.setattr(topk, "BLOCK_ROWS", pack)
    monkeypatch.setattr(topk.blocks, "__defaults__", (block,))
    monkeypatch.setattr(topk.query_groups, "__defaults__", (4,))
    exact = [(i, None if e is None else [None if x is None else float(np.float32(x)) for x in e]) for i, e in rows]
    assert H.by_id(topk.search(df, F.col("vec_id") % 100 == 0), "query_id", "rank", "vec_id", "score") == sorted(brute_topk(exact, 10), key=repr)


def test_topk_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 0.0]), (2, [0.5, 0.5])], "vec_id long, embedding array<float>")
    assert H.by_id(topk.search(df, F.col("vec_id") % 100 == 0), "query_id", "rank", "vec_id") == [(0, 1, 2), (0, 2, 1)]
    assert topk.search(df.limit(0), F.lit(True)).count() == 0


def test_topk_repeated_ids_are_rows_of_their_own(spark):
    rows = [(0, [1.0, 2.0]), (0, [2.0, 1.0]), (0, [1.0, 2.0]), (1, [3.0, 0.0]), (100, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    assert H.by_id(topk.search(df, F.col("vec_id") % 100 == 0), "query_id", "rank", "vec_id", "score") == sorted(brute_topk(rows, 10), key=repr)


def test_topk_huge_components_have_a_result(spark):
    rows = [(0, [1e12, -1e12]), (1, [1e12, 0.0]), (2, [1e300, 1.0]), (3, [-1e12, 0.0]), (4, [1e12, -1e12]), (5, [-1e300, 0.0]), (6, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = H.by_id(topk.search(df, F.col("vec_id") % 100 == 0), "rank", "vec_id", "score")
    top = 2 ** 63 - 1  # scores beyond 64 bits tie at the ends of the range
    assert got == [(1, 1, top), (2, 2, top), (3, 4, top), (4, 6, 0), (5, 3, -top), (6, 5, -top)]


def test_topk_bounds_where_large_terms_cancel(spark, monkeypatch):
    """Rounding of large cancelling products never hides a block that holds a result."""
    r = np.random.default_rng(8)
    rows = []
    for i in range(400):
        big = float(r.integers(1, 50)) * 2.0 ** 40
        rows.append((i, [big, -big, float(r.integers(-3, 4)), 1.0]))
    rows[0] = (0, [2.0 ** 45, 2.0 ** 45, 1.0, 1.0])
    monkeypatch.setattr(topk.blocks, "__defaults__", (8,))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = H.by_id(topk.search(df, F.col("vec_id") == 0), "query_id", "rank", "vec_id", "score")
    assert got == sorted((x for x in brute_topk(rows, 10) if x[0] == 0), key=repr)


def test_topk_large_components_stay_exact():
    a, b = np.array([[2 ** 40, 3]]), np.array([[2 ** 41, 7]])
    assert topk._product(a, b)[0, 0] == 2 ** 63 - 1  # 2 ** 81 + 21, beyond 64 bits
    a, b = np.array([[2 ** 30, 3]]), np.array([[2 ** 30, 7]])
    assert topk._product(a, b)[0, 0] == 2 ** 60 + 21


def brute_classes(rows, n, num, den=100):
    sets = {}
    for i, t, *_ in rows:
        w = H.words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for a in sets:
        for b in sets:
            if a < b and sets[a] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return sorted((i, len(sets[i]), root(i)) for i in sets)


def copies(seed, base=60, each=6):
    """Texts with chains of near copies, exact copies, shared passages and case changes."""
    r, out = random.Random(seed), []
    shared = " ".join(f"s{i}" for i in range(60))
    for t in H.prose(base, seed=seed):
        w = t.split()
        for _ in range(r.randint(1, each)):
            out.append(" ".join(w))
            for _ in range(r.choice([0, 1, 1, 2, 9])):
                w[r.randrange(len(w))] = f"new{r.randrange(10 ** 6)}"
        if r.random() < 0.4:
            out.append(shared + " " + t.upper())
    r.shuffle(out)
    return [(i, t, "en", "a") for i, t in enumerate(out)]


@pytest.mark.parametrize("n,num,chunk", [(3, 90, 1024), (5, 80, 1024), (3, 60, 4), (2, 90, 4)])
def test_classes_equal_brute_force(spark, monkeypatch, n, num, chunk):
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    monkeypatch.setattr(jaccard, "SPAN_CHUNK", chunk)
    rows = copies(n * 100 + num) + [(9000, None, "en", "a"), (9001, "", "en", "a"), (9002, "two words", "en", "a"), (9003, "Two  WORDS", "en", "a")]
    got = H.by_id(jaccard.near_duplicates(H.table(spark, rows), n, num), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute_classes(rows, n, num), key=repr)


def test_classes_without_sampled_order_or_anchors(spark, monkeypatch):
    """The order of tokens and the first round only save work."""
    monkeypatch.setattr(jaccard, "frequent_tokens", lambda *a, **k: (np.empty(0, "uint64"), np.empty(0, "int64")))
    monkeypatch.setattr(jaccard.Bucket, "spanning", lambda self: iter(()))
    monkeypatch.setattr(jaccard, "LEAF", 2)
    monkeypatch.setattr(jaccard, "FANOUT", 2)
    rows = copies(77)
    got = H.by_id(jaccard.near_duplicates(H.table(spark, rows), 3, 80), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute_classes(rows, 3, 80), key=repr)


def test_classes_odd_and_empty(spark):
    got = H.by_id(jaccard.near_duplicates(H.table(spark, H.odd_rows()), 3, 90), "doc_id", "component_id")
    assert (6, 6) in got and (7, 6) in got and (None, None) in got and len(got) == len(H.odd_rows())
    assert jaccard.near_duplicates(H.empty(spark), 3, 90).count() == 0
    docs = H.table(spark, H.odd_rows())
    kept = jaccard.keep_one(docs, 3, 90)
    assert kept.columns == docs.columns
    assert sorted(map(repr, (r["doc_id"] for r in kept.collect()))) == sorted(map(repr, (0, 1, 2, 3, 4, 5, 6, 8, 9, 10, None)))


def test_tree_drops_no_pair():
    r = np.random.default_rng(8)
    base = [r.integers(0, 2 ** 60, 200, dtype="uint64") for _ in range(12)]
    sets = [np.unique(np.concatenate([b[k:], r.integers(0, 2 ** 60, k, dtype="uint64")])) for b in base for k in (0, 5, 9, 15, 30)]
    size = np.array([len(s) for s in sets])
    bits = np.stack([np.frombuffer(jaccard.bitmap(s), "uint64") for s in sets])
    ids = np.arange(len(sets))
    b = jaccard.Bucket(ids, size, bits, np.zeros(len(sets), int), ids, np.zeros(len(sets), int), 90, 100)
    got = {tuple(sorted((int(b.ids[x]), int(b.ids[y])))) for i, j in b.pairs() for x, y in zip(i, j)}
    for x in ids:
        for y in ids[x + 1:]:
            both = len(np.intersect1d(sets[x], sets[y]))
            if 100 * both >= 90 * (size[x] + size[y] - both):
                assert (x, y) in got
    assert len(got) < len(ids) * 10


def brute_cosine(text, idf, other):
    import re
    from collections import Counter
    c = Counter(t for t in re.split(r"[^\w]+|_", text.lower()) if t)
    a = math.sqrt(sum((k * idf.get(t, other)) ** 2 for t, k in c.items()))
    best = None
    for name, m in license_scan.template_terms():
        b = math.sqrt(sum((k * idf[t]) ** 2 for t, k in m.items()))
        cos = sum(k * m[t] * idf[t] ** 2 for t, k in c.items() if t in m) / (a * b) if a else 0.0
        best = min(best or (2.0, ""), (-round(cos, 9), name))
    return best


def test_licenses_and_inheritance(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    files = [(1, "LICENSE", mit), (2, "a/x.py", "code"), (3, "a/b/COPYING", f"intro words\n{gpl}"), (4, "a/b/c/y.py", None),
             (5, "a/b/z.py", f"x\n# {mit}\ny"), (6, "q/LICENSE.txt", "all rights"), (7, "q/r.py", "licensed chaos of many other foreign words here"),
             (8, None, gpl), (9, "a/bb/y.py", ""), (9, "a/bb/y.py", "")]
    df = spark.createDataFrame(files, "doc_id long, path string, text string").selectExpr("*", "'x' AS own", "1 AS distance")
    got = {r["id"]: r for r in license_scan.scan(df).collect()}
    n, counts = license_scan.frequencies(df)
    idf, other = license_scan.weights(n, counts)
    assert n == len(files) and counts["mit"] == 2 and counts["gnu"] == 2
    for i, _, t in files:
        lines = [x for x in (t or "").split("\n") if any(w in x.lower() for w in ("license", "licence"))]
        want = min((brute_cosine(x, idf, other) for x in lines + ([t] if i in (1, 3, 6) else [])), default=(0.0, None))
        assert got[i]["cosine"] == pytest.approx(-want[0], abs=1e-6)
        assert got[i]["own"] == (want[1] if -want[0] >= license_scan.MIN_COSINE else None)
    assert {i: (r["license"], r["license_dir"], r["distance"]) for i, r in got.items()} == {
        1: ("MIT", None, None), 2: ("MIT", "", 1), 3: ("GPL-3.0", None, None), 4: ("GPL-3.0", "a/b", 1), 5: ("MIT", None, None),
        6: ("MIT", "", 1), 7: ("MIT", "", 1), 8: ("GPL-3.0", None, None), 9: ("MIT", "", 2)}
    assert license_scan.scan(df.limit(0)).count() == 0


def test_pipeline_stages_against_brute_force(spark):
    r = random.Random(6)
    rows = [(i, t if i % 9 else f"{t} mail me.{i}@mail.example.com", g, f"s{i % 3}")
            for i, (_, t, *_), g in zip(range(400), copies(6, base=120), (r.choice(["en", "de"]) for _ in range(400)))]
    rows += [(700, None, "en", "s0"), (701, "123 !!", "de", "s0"), (702, "", None, None)]
    docs = H.table(spark, rows, clash=False)
    columns, text = docs.columns, {i: t for i, t, *_ in rows}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    stage = dict(corpus_pipeline.STAGES)
    one = stage["language ID"](spark, docs, "")
    model = langid.train(docs)
    assert one.columns == columns
    keep = {i for (i, *_), (g, s) in zip(rows, langid.predict(model, [t for _, t, *_ in rows])) if g != "und" and s >= 0.2}
    assert {x["doc_id"] for x in one.collect()} == keep and not {700, 701, 702} & keep
    two = stage["n-gram Jaccard join"](spark, one, "")
    kept = sorted(i for i, _, c in brute_classes([x for x in rows if x[0] in keep], 5, 80) if i == c)
    assert two.columns == columns and sorted(x["doc_id"] for x in two.collect()) == kept
    three = stage["PII"](spark, two, "")
    weights = pii.train(two)
    assert three.columns == columns
    for x in three.collect():
        want = pii.masked(text[x["doc_id"]], pii.all_spans(weights, text[x["doc_id"]])[1])
        assert (x["text"], x["n_chars"]) == (want, len(want)) and "@" not in x["text"]
    four = stage["mixing sources"](spark, three, "")
    assert four.columns == columns and {x["doc_id"] for x in four.collect()} <= set(kept)
    last = stage["byte-level BPE"](spark, four, "").collect()
    assert len(last) == four.count() and all(x["n_tokens"] == len(x["ids"]) for x in last)


def test_pipeline_of_nothing(spark):
    docs = H.table(spark, [], clash=False)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0


def test_topk_block_bounds_are_packed_without_a_global_order(spark, monkeypatch):
    plans, write = {}, topk.written

    def seen(df, name, *a, **b):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name, *a, **b)
    monkeypatch.setattr(topk, "written", seen)
    df = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(300)], "vec_id long, embedding array<float>")
    assert topk.search(df, F.col("vec_id") % 100 == 0).count() == 30
    assert "topk-bounds" in plans and not [n for n, p in plans.items() if "SinglePartition" in p]


def test_keep_one_of_repeated_ids_by_text(spark):
    a, b, c = ("alpha beta gamma delta one", "red green blue white two", "sun moon star sky three")
    kept = lambda rows: sorted((r["doc_id"], r["text"]) for r in jaccard.keep_one(
        H.table(spark, [(i, t, "en", "s") for i, t in rows]), 3, 90).collect())
    assert kept([(3, b), (5, a), (5, b), (7, a)]) == [(3, b), (5, a)]
    # one id with unrelated texts keeps both; an equal row and an empty row stay once
    assert kept([(5, a), (5, c), (5, c), (5, ""), (5, ""), (6, c), (8, b)]) == sorted([(5, ""), (5, a), (5, c), (8, b)])
    assert len(jaccard.keep_one(H.table(spark, [(None, a, "en", "s"), (None, a, "en", "s"), (2, a, "en", "s"), (2, a, "en", "s")]), 3, 90).collect()) == 3
