"""Quality rules (1) and mixing (3)."""

import hashlib

import pytest

import helpers as H
from lectern.llm import mixing, quality_rules
from pyspark.sql import functions as F


def brute_base(text):
    w, lines = H.words(text), [x for x in (text or "").split("\n") if H.words(x)]
    seen, cover = {}, set()
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i:i + 8]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            cover.update(k for i in at for k in range(i, i + 8))
    n = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(cover))
    return (*n, n[0] < 20 or 100 * n[4] > 30 * n[0])


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_columns_against_brute_force(spark):
    texts = H.prose(60, vocabulary=6) + [t for _, t, _, _ in H.odd_rows()] + [
        "l1 a\nl1 a\n\n \nl2\nl2 \nl1 a", "a b c d e f g h a b c d e f g h", " ".join("abcdefgh"), " ".join("abcdefgha"),
        "x y z " * 40, "#%$ <b>|</b> & *", "p q r s t u v w " * 2 + "z " * 30]
    df = H.table(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    got = H.by_id(quality_rules.base_columns(df), "doc_id", *BASE)
    assert got == sorted(((i, *brute_base(t)) for i, t in enumerate(texts)), key=repr)


def test_judge_keeps_clean_and_drops_symbols(spark):
    clean = [(i, t, "en", f"s{i % 3}") for i, t in enumerate(H.prose(600, seed=3)) if len(t.split()) >= 25]
    junk = [(10_000 + i, " ".join(w + "%%%" for w in t.split()), "en", "s1") for i, t in enumerate(H.prose(40, seed=4))]
    got = dict(H.by_id(quality_rules.judge(H.table(spark, clean + junk)), "doc_id", "kept"))
    assert all(got[i] for i, *_ in clean)
    assert not any(got[i] for i, *_ in junk)


def test_small_odd_source_keeps_its_own_fences(spark):
    clean = [(i, t, "en", "web") for i, t in enumerate(H.prose(400, seed=3)) if len(t.split()) >= 25]
    code = [(10_000 + i, " ".join(w + "<%>" for w in t.split()), "en", "code") for i, t in enumerate(H.prose(30, seed=4)) if len(t.split()) >= 25]
    odd = [(20_000, " ".join(w + "%%%%%%%%%%%%%%%%%%%%" for w in H.prose(1, seed=9)[0].split() * 9), "en", "code")]
    for few in (code[:1], code[:5], code):  # no size at which a source goes over to other fences
        got = dict(H.by_id(quality_rules.judge(H.table(spark, clean + few)), "doc_id", "kept"))
        assert all(got.values())
    got = dict(H.by_id(quality_rules.judge(H.table(spark, clean + code + odd)), "doc_id", "kept"))
    assert got.pop(20_000) is False and all(got.values())


def test_small_groups_are_held_against_language_and_whole_table(spark):
    clean = [(i, t, "en", "web") for i, t in enumerate(H.prose(400, seed=3)) if len(t.split()) >= 25]
    junk = " ".join(w + "%%%" for w in next(t for t in H.prose(40, seed=4) if len(t.split()) >= 25).split())
    rows = clean + [(10_000, junk, "en", "one"), (10_001, junk, "xx", "one"), (10_002, junk, None, None)]
    got = {r[0]: r[1:] for r in H.by_id(quality_rules.judge(H.table(spark, rows)), "doc_id", "kept", "kept_lang", "kept_all")}
    assert got[10_000] == (True, False, False)
    assert got[10_001] == got[10_002] == (True, True, False)
    assert all(got[i] == (True, True, True) for i, *_ in clean)


def test_judge_odd_and_empty(spark):
    got = quality_rules.judge(H.table(spark, H.odd_rows()))
    assert got.count() == len(H.odd_rows()) and got.where("kept IS NULL").count() == 0
    assert got.where("base_failed AND kept").count() == 0
    assert quality_rules.judge(H.empty(spark)).count() == 0


def test_sketches_merge_and_are_close(spark):
    df = spark.range(20_000).select(F.lit("en").alias("lang"), (F.col("id") % 2).cast("string").alias("source"),
                                    *[(F.col("id") * 3).alias(f"m_{m}") for m in quality_rules.MEASURES])
    whole = quality_rules.sketch(df)
    parts = [quality_rules.sketch(df.where(F.col("m_symbols") % 5 == k)) for k in range(5)]
    cols = ("lang", "source", "measure", "bucket", "n")
    assert H.by_id(quality_rules.merge_sketches(*parts), *cols) == H.by_id(whole, *cols)
    q = quality_rules.quartiles(whole, []).where("measure = 'symbols'").first()
    for got, want in ((q["q1"], 15_000), (q["q3"], 45_000)):
        assert abs(got - want) <= want / 2 ** (quality_rules.SKETCH_BITS - 1)


def resharing(sizes, weights=(5, 2, 1)):
    """Targets by repeated resharing."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: float(weights[k % 3]) for k, s in enumerate(names)}
    cap, target, left = {s: 3.0 * sizes[s] for s in names}, {}, float(sum(sizes.values()))
    open_ = set(names)
    while open_:
        level = left / sum(w[s] for s in open_)
        over = {s for s in open_ if cap[s] < level * w[s]}
        if not over:
            target.update({s: level * w[s] for s in open_})
            break
        target.update({s: cap[s] for s in over})
        left -= sum(cap[s] for s in over)
        open_ -= over
    return target


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 10, "c": 1}, {"a": 1, "b": 1, "c": 1, "d": 1000, None: 5},
                                   {"a": 0, "b": 7}, {"a": 0}, {"z": 9, "y": 2, "x": 2, "w": 500, "v": 1, "u": 1}])
def test_targets_equal_resharing(spark, sizes):
    rows = [(s, v) for s, v in sizes.items()]
    got = {r["source"]: r["target"] for r in mixing.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    want = resharing(sizes) if sum(sizes.values()) else dict.fromkeys(sizes, 0.0)
    assert got.keys() == want.keys()
    for s in want:
        assert got[s] == pytest.approx(want[s], rel=1e-12, abs=1e-12)


def test_mix_emits_what_the_plan_says(spark):
    docs = H.table(spark, H.odd_rows() + [(100 + i, t, "en", "big") for i, t in enumerate(H.prose(200))])
    plan = mixing.plan_mix(docs).collect()
    assert sum(r["copies"] for r in plan) == mixing.mix(docs).count()
    assert mixing.mix(docs).columns == docs.columns
    assert all(r["copies"] <= 3 for r in plan)
    for r in plan:
        u = int(hashlib.md5(f"{mixing.SEED}|{chr(0) if r['doc_id'] is None else r['doc_id']}".encode()).hexdigest()[:8], 16) / 2 ** 32
        assert r["copies"] == int(r["rate"]) + (u < r["rate"] - int(r["rate"]))
    assert H.by_id(mixing.plan_mix(docs.repartition(9)), "doc_id", "copies") == H.by_id(mixing.plan_mix(docs), "doc_id", "copies")


def test_mix_nears_targets_and_handles_empty(spark):
    rows = [(i, t, "en", "abcd"[min(i % 7, 3)]) for i, t in enumerate(H.prose(4000))]
    plan = mixing.plan_mix(H.table(spark, rows)).groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r["taken"] - r["target"]) < 0.1 * r["target"] for r in plan)
    assert mixing.mix(H.empty(spark)).count() == 0 and mixing.plan_mix(H.empty(spark)).count() == 0
