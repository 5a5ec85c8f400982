"""Benchmark decontamination (operator 11) against plain window search."""

import re

import pytest

import helpers as H
from lectern.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def brute(text, items, size=10):
    """(n_words, n_hit, items, spans) of one text."""
    at = [m.span() for m in WORD.finditer(text or "")]
    words = [lower(text[a:b]) for a, b in at]
    hit, found = set(), set()
    for item, body in items:
        w = [lower(x) for x in WORD.findall(body or "")]
        for i in range(max(len(w) - size, 0) + 1 if w else 0):
            win = w[i:i + size]
            for p in range(len(words) - len(win) + 1):
                if words[p:p + len(win)] == win:
                    hit.update(range(p, p + len(win)))
                    if item is not None:
                        found.add(str(item))
    spans, run = [], []
    for k in sorted(hit):
        if run and k == run[-1] + 1:
            run.append(k)
        else:
            spans, run = spans + ([run] if run else []), [k]
    spans += [run] if run else []
    return len(words), len(hit), sorted(found), [(at[r[0]][0], at[r[-1]][1]) for r in spans]


ITEMS = [(1, "The quick brown fox jumps over the lazy dog and then runs far away home"), (2, "Élan vital"), (10, "QUICK brown"),
         (3, None), (4, " .,! "), (5, "a a a a a a a a a a a a"), (None, "no name item here"), (1, "second text of one"),
         (6, "x1 y2"), (2, "élan vital")]
TEXTS = [None, "", "...", "the QUICK, brown-fox", "So: The quick brown fox jumps over the lazy dog and then runs far away home!",
         "fox jumps over the lazy dog and then runs far", "Élan vital, élan vital. \U0001f600 x1\ny2", "a " * 30, "a " * 9,
         "no name item here", "second text of one second text of one", "jumps over the lazy dog and then runs far away home",
         "über x1 y2 élan vital"]


def items_table(spark):
    return spark.createDataFrame([(i, t) for i, t in ITEMS], "item_id long, text string").selectExpr("*", "1 AS hits", "2 AS items", "3 AS doc_id")


def got(df):
    return sorted(((r["id"], r["n_words"], r["n_hit"], r["items"], [tuple(s) for s in r["spans"]]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("shard_windows", [200_000, 8])
def test_against_plain_search(spark, shard_windows, monkeypatch):
    monkeypatch.setattr(D, "SEGMENT", 3)  # items are cut, and dealt to several automata
    rows = [(i, t, "en", "a") for i, t in enumerate(TEXTS)] + H.odd_rows()[:4]
    want = sorted(((i, *brute(t, ITEMS)) for i, t, _, _ in rows), key=repr)
    assert got(D.find(H.table(spark, rows), items_table(spark), shard_windows=shard_windows)) == want


def test_random_texts(spark):
    texts = H.prose(60, vocabulary=6)
    items = [(k, " ".join(t.split()[:n])) for k, (t, n) in enumerate(zip(H.prose(12, seed=1, vocabulary=6), [3, 10, 11, 15, 40, 9, 10, 2, 30, 12, 60, 1]))]
    table = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(((i, *brute(t, items)) for i, t in enumerate(texts)), key=repr)
    assert got(D.find(H.table(spark, [(i, t, "en", "a") for i, t in enumerate(texts)]), table)) == want


def test_empty_tables_and_long_text(spark):
    items = items_table(spark)
    assert D.find(H.empty(spark), items).count() == 0
    rows = D.find(H.table(spark, H.odd_rows()), items.where("false")).collect()
    assert len(rows) == len(H.odd_rows()) and not any(r["n_hit"] for r in rows)
    long = "w " * 300_000 + "the quick brown"
    (r,) = D.find(H.table(spark, [(1, long, "en", "a")]), items).collect()
    assert (r["n_words"], r["n_hit"], r["items"], [tuple(s) for s in r["spans"]]) == (300_003, 2, ["10"], [(600_004, 600_015)])


def test_remove_keeps_clean_documents(spark):
    docs = H.table(spark, [(i, t, "en", "a") for i, t in enumerate(TEXTS)])
    left = D.remove(docs, items_table(spark))
    assert left.columns == docs.columns
    assert [r["doc_id"] for r in left.orderBy("doc_id").collect()] == [i for i, t in enumerate(TEXTS) if not brute(t, ITEMS)[1]]
