"""Quality ranking (4) and language identification (5): held-out accuracy and odd rows."""

import random
import zlib

import numpy as np

import helpers as H
from pyspark.sql import functions as F
from lectern.llm import langid, quality_rank

SYLLABLES = {"en": ["the", "ing", "tion", "ou", "sh"], "de": ["sch", "ung", "ein", "ü", "ß"], "fr": ["eau", "é", "que", "ou", "ç"],
             "es": ["ción", "ñ", "os", "que", "rr"], "xx": ["zzo", "kaa", "wy", "qo"]}


def text(lang, r, n):
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 3))) for _ in range(n))


def test_language_held_out(spark):
    r = random.Random(2)
    rows = [(i, text(g, r, r.randint(8, 60)), g, "s") for i, g in enumerate(r.choice(list(SYLLABLES)) for _ in range(900))]
    docs = H.table(spark, rows + [(5000 + i, t, g, s) for i, t, g, s in [(0, None, "en", "a"), (1, "12 34 !", "en", "a"), (2, "", None, None)]])
    got = {x["doc_id"]: x for x in langid.identify(docs, langid.train(docs)).collect()}
    held = [(i, g) for i, _, g, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, *_ in rows)
    assert sum(got[i]["lang_pred"] == g for i, g in held) >= 0.97 * len(held)
    assert all((got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0) for i in (5000, 5001, 5002))
    assert all(0 <= x["score"] <= 1 for x in got.values())
    again = {x["doc_id"]: x["lang_pred"] for x in langid.identify(docs.repartition(5), langid.train(docs.repartition(3))).collect()}
    assert again == {i: x["lang_pred"] for i, x in got.items()}


def test_language_odd_empty_and_single(spark):
    odd = H.table(spark, H.odd_rows())
    assert langid.identify(odd, langid.train(odd)).count() == len(H.odd_rows())
    none = langid.train(H.empty(spark))
    assert none["langs"] == [] and langid.predict(none, ["abc", None]) == [("und", 0.0)] * 2
    one = langid.fit(np.stack([langid.vector("abc def")]), ["en"])
    assert langid.predict(one, ["hello", "1"]) == [("en", 1.0), ("und", 0.0)]
    assert langid.keep_identified(odd, none).columns == odd.columns
    assert {r["doc_id"] for r in langid.keep_identified(odd, none).collect()} == {3, 4, 5, 6, 7, 8, 9, None}


def test_trigrams_of_many_texts_equal_each_alone():
    texts = H.prose(20) + ["a", "éé", "1 a 2", "漢字"]
    codes, starts = langid.trigrams(texts)
    for t, a, b in zip(texts, starts, [*starts[1:], len(codes)]):
        assert codes[a:b].tolist() == langid.trigrams([t])[0].tolist()


def test_machine_separates():
    r = np.random.default_rng(1)
    x = np.concatenate([r.normal(1, 0.3, (40, 3)), r.normal(-1, 0.3, (40, 3))])
    y = np.repeat([1.0, -1.0], 40)
    coef = langid.machine(x @ x.T + 1, y)
    assert ((x @ (coef @ x) + coef.sum()) * y > 0).all()


def test_quality_held_out(spark):
    r = random.Random(4)
    good = [(2 * i, t, "en", "a") for i, t in enumerate(H.prose(500, seed=5))]
    bad = [(2 * i + 1, " ".join(w + r.choice(["%%%", "$$$", "###"]) for w in t.split()), "en", "a") for i, t in enumerate(H.prose(200, seed=6))]
    docs = H.table(spark, good + bad)
    labels = spark.createDataFrame([(i, 1, "x") for i, *_ in good] + [(i, 0, "x") for i, *_ in bad] + [(None, 1, "x"), (2, None, "x"), (4, 7, "x")],
                                   "doc_id long, quality int, text string")
    got = {x["doc_id"]: x for x in quality_rank.score(docs, quality_rank.train(docs, labels)).collect()}
    held = [i for i, *_ in good + bad if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum(got[i]["predicted"] == 1 - i % 2 for i in held) >= 0.97 * len(held)
    assert all(x["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, x in got.items())
    assert all(0 <= x["score"] <= 1 and x["predicted"] == int(x["score"] >= 0.3) for x in got.values())


def test_quality_odd_empty_and_one_class(spark):
    odd = H.table(spark, H.odd_rows())
    none = quality_rank.train(odd, spark.createDataFrame([], "doc_id long, quality int"))
    got = quality_rank.score(odd, none).collect()
    assert len(got) == len(H.odd_rows()) and all(abs(x["score"] - 0.3) < 1e-9 for x in got)
    assert quality_rank.score(H.empty(spark), none).count() == 0


def test_pairs_take_every_row_of_the_rarer_class():
    good, bad = np.arange(50, dtype=float)[:, None], -np.arange(1, 8, dtype=float)[:, None]
    d = quality_rank.pairs(good, bad, 4)
    assert d.shape == (28, 1) and (d > 0).all()


def test_rank_learns_from_every_labelled_row(spark):
    n = 30_000  # more than any bound on the rows
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("some plain words "), F.when(F.col("id") % 3 == 0, "# $ % ").otherwise(""),
                                                                      F.col("id").cast("string")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 3 != 0).cast("int").alias("quality"))
    seen, real = [], quality_rank.fit
    quality_rank.fit = lambda rows: seen.append(rows.count()) or real(rows)
    try:
        model = quality_rank.train(docs, labels)
    finally:
        quality_rank.fit = real
    assert seen == [sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(n))]
    got = quality_rank.score(docs, model)
    assert got.join(labels, "doc_id").where("predicted != quality").count() < 0.01 * n


def test_rank_order_statistics(spark):
    r = random.Random(3)
    values = [r.gauss(0, 1) for _ in range(30_000)] + [0.25] * 12_000 + [1e9]
    df, want = spark.createDataFrame([(v,) for v in values], "s double").repartition(4), sorted(values)
    for at in (0, 17_000, 20_000, len(values) - 1):
        assert quality_rank.order_statistic(df, at, len(values)) == (want[at], want[min(at + 1, len(values) - 1)])


def test_rank_pairs_by_join_equal_those_at_hand(spark):
    names, r = quality_rank.NAMES, np.random.default_rng(4)
    x, label = r.integers(0, 9, (50, len(names))).astype(float), np.arange(50) % 3 == 0
    rows = spark.createDataFrame([(i, int(b), *map(float, v)) for i, (v, b) in enumerate(zip(x, label))],
                                 ", ".join(["_id long", "_label int", *[f"{n} double" for n in names]])).repartition(3)
    got = quality_rank.paired(quality_rank.numbered(rows), int(label.sum()), int((~label).sum()), 4)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, quality_rank.pairs(x[label], x[~label], 4).tolist()))


def test_rank_moves_features_and_no_texts(spark, monkeypatch):
    rows = [(i, t + (" %%% ###" if i % 3 else ""), "en", "a") for i, t in enumerate(H.prose(60))]
    docs = H.table(spark, rows + H.odd_rows(), clash=False)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, *_ in rows], "doc_id long, quality int")
    plans, real = [], quality_rank.written
    monkeypatch.setattr(quality_rank, "written", lambda df, *a: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or real(df, *a))
    got = H.by_id(quality_rank.rank(docs, labels), "doc_id", "held_out", "score", "predicted")
    assert plans and not any("Join" in p and "text" in p for p in plans)
    assert got == H.by_id(quality_rank.score(docs, quality_rank.train(docs, labels)), "doc_id", "held_out", "score", "predicted")
