"""Personal data (7): rules against the plain patterns, the model on touching numbers."""

import random
import re
import time

import pytest

import helpers as H
from lectern.llm import pii

PLAIN = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))
CARD = "4279055890764913"


def plain(text):
    out = []
    for kind, p in PLAIN:
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and not all(int(x) <= 255 for x in m.group().split(".")):
                continue
            if kind == "card":
                v = [int(c) for c in d][::-1]
                if not 16 <= len(d) <= 19 or (sum(v[0::2]) + sum(sum(divmod(2 * x, 10)) for x in v[1::2])) % 10:
                    continue
            if kind == "phone" and not 8 <= len(d) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_rules_equal_plain_patterns():
    r = random.Random(5)
    parts = ["a", "@", ".", "-", "1", "23", "255", "+", "(", " ", ")", "b.c", "_", CARD, "x@y.z", "é", "\n"]
    for _ in range(20_000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 25)))
        assert pii.base_spans(text) == plain(text), text


def dense(chars):
    r = random.Random(3)
    parts = [CARD, "+1 (269) 555-3296", "+49 30 1234567 ", "10.0.0.1", "2023-10-12", "4524 1326 5264 8763", "x9@b.c", "7", "bob (at) x (dot) y", "1.2.3.4.5"]
    out, n = [], 0
    while n < chars:
        out.append(r.choice(parts) + r.choice([" ", " ", "; ", "\n", "-"]))
        n += len(out[-1])
    return "".join(out)


def seconds(work, *args):
    return min(_timed(work, *args) for _ in range(2))


def _timed(work, *args):
    at = time.process_time()
    work(*args)
    return time.process_time() - at


@pytest.mark.parametrize("make", [
    dense, lambda n: (CARD + " ") * (n // 17), lambda n: "9" * n, lambda n: "a" * n + " (at) b", lambda n: "1." * (n // 2),
    lambda n: "+1 " * (n // 3), lambda n: "12345678a" * (n // 9) + "@x.y", lambda n: "@" * n])
def test_long_texts_take_linear_time(make):
    weights = pii.fit([])
    small, large = (seconds(pii.all_spans, weights, make(n)) for n in (40_000, 320_000))
    assert large < 8 * 2 * small + 0.2


def test_training_takes_linear_time():
    weights = dict(pii.PRIOR)

    def expected(n):
        atoms, cands = pii.candidates(text := (CARD + " ") * n, 0, len(text))
        return seconds(pii._expected, weights, len(atoms), cands)
    assert expected(8_000) < 8 * 2 * expected(1_000) + 0.2
    small, large = (seconds(pii.gold_islands, dense(n)) for n in (40_000, 320_000))
    assert large < 8 * 2 * small + 0.2


def test_all_spans_of_random_texts_by_plain_overlap():
    """Sweeping and bisecting change nothing: candidates that overlap a base span are out, as by comparing all pairs."""
    r, weights = random.Random(11), pii.fit([])
    for _ in range(2_000):
        text = dense(r.randint(5, 120))[r.randint(0, 9):]
        base, spans = pii.all_spans(weights, text)
        assert set(base) <= set(spans)
        more = [s for s in spans if s not in base]
        assert not any(a < y and x < b for _, a, b in more for _, x, y in base)
        inside = pii.Taken(base)
        assert all(inside.overlap(a, a + 1) == any(x <= a < y for _, x, y in base) for a in range(len(text)))


def found(text, weights=None):
    return pii.all_spans(weights or pii.fit([]), text)[1]


def test_touching_numbers_are_separated():
    text = f"call +1 (269) 555-3296 {CARD} now"
    assert pii.base_spans(text) == []
    assert found(text) == [("card", 23, 39), ("phone", 5, 22)]
    assert found(f"{CARD} {CARD}") == [("card", 0, 16), ("card", 17, 33)]
    assert found("bob (at) mail (dot) com") == [("email", 0, 23)]


def test_clean_numbers_are_left_alone():
    for text in ("on 2023-10-12 10:30", "price 1,000,000 and 12 345 678", "id 123456789012", "v 2.0.1", "1234567890123456", "a1b2c3d4e5f6a7b8"):
        assert found(text) == [], text


def brute_best(weights, n, cands):
    """Best segmentation by trying every subset of candidates in order."""
    def go(at):
        best = (0.0, [])
        for c in cands:
            if c[0] >= at:
                v, rest = go(c[1])
                v += pii.score(weights, c[5])
                if v > best[0] + 1e-12:
                    best = (v, [c, *rest])
        return best
    return go(0)[0]


def test_dynamic_programme_finds_the_best_total():
    r, weights = random.Random(9), pii.fit([])
    for _ in range(300):
        text = " ".join(r.choice(["12", "555-3296", "+1", "(269)", "4279", "0558", "9076", "4913", "1.2.3.4"]) for _ in range(r.randint(1, 6)))
        atoms, cands = pii.candidates(text, 0, len(text))
        best = pii.best_segments(weights, len(atoms), cands)
        assert all(a[1] <= b[0] for a, b in zip(best, best[1:]))
        assert abs(sum(pii.score(weights, c[5]) for c in best) - brute_best(weights, len(atoms), cands)) < 1e-9


def test_training_raises_the_likelihood_of_gold():
    islands = [g for t in (f"x {CARD} y", "+1 (644) 555-7859", "17.252.227.210") * 20 for g in pii.gold_islands(t)]
    assert islands
    w = pii.fit(islands)
    for n, cands, gold in islands:
        for c in gold:
            assert pii.score(w, c[5]) > 0
    assert w == pii.fit(islands)


def test_find_and_redact(spark):
    text = f"mail bob.1@mail.example.com, {CARD} {CARD}; ip 1.2.3.4"
    docs = H.table(spark, H.odd_rows() + [(50, text, "en", "a")])
    got = {r["doc_id"]: r for r in pii.find(docs).collect()}
    assert [tuple(s) for s in got[50]["spans"]] == [("email", 5, 27), ("ip", 67, 74), ("card", 29, 45), ("card", 46, 62)]
    assert [tuple(s) for s in got[50]["base"]] == [("email", 5, 27), ("ip", 67, 74)]
    assert pii.find(docs).count() == len(H.odd_rows()) + 1
    red = pii.redact(docs)
    assert red.columns == docs.columns
    assert red.where("doc_id = 50").first()["text"] == "mail <email>, <card> <card>; ip <ip>"
    assert [r["text"] for r in red.where("doc_id = 0").collect()] == [None]
    assert pii.find(H.empty(spark)).count() == 0 and pii.redact(H.empty(spark)).count() == 0
