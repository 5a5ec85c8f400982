"""Spelling variants grouped through k-d trees over letter counts (operator 12).

Two words are near if one inserted, deleted or replaced letter turns one into
the other.  As letter counts, a replacement is plus one in one letter and minus
one in another, an insertion plus one in one letter, so near words lie within
an L1 distance of two, and only words of equal length or lengths one apart can
be near.

* Per word length a top k-d tree cuts the space of letter counts into boxes of
  about ``LEAF_WORDS`` words.  Trees are grown from a hash sample of the words
  (``SAMPLE_WORDS``); the sample decides how even the boxes are, never which
  pairs are found.  Lengths with fewer words are one box.
* Each word is a point of its own box and asks every box, of its length and of
  the next, that one edit can reach.  A box with many words or askers is dealt
  to several tasks, points by points and askers by askers.
* A task grows a k-d tree over its points' letter counts, prunes by the bounds
  of its boxes, and checks the letter order of the words whose counts differ
  by exactly one edit.

A word's form is its near word of largest count, if that is ``RATIO`` times the
word's; forms are followed to the root by pointer doubling (counts grow along
forms, so the number of rounds is logarithmic in the logarithm of the largest).

Edge cases: NULL and letterless texts have no words; repeated rows count again;
ties of counts go to the smaller word in code-point order; words of any length
are compared whole; an empty table gives no rows; input columns beside the two
named ones are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import written

MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
LEAF_WORDS = 16_000         # words of a box of a top tree
MAX_LEAVES = 16_384         # boxes of all top trees together (they are broadcast)
SAMPLE_WORDS = 50_000       # words that the top trees are grown from
GROUP_ROWS = 20_000         # points, and askers, of one task's group
GROUP_CHARS = 4_000_000
FEW_PAIRS = 64              # word pairs of two vectors that are compared in bulk
SPLIT_LETTERS = 8           # letters that vary most, among which a node of a tree is split
BUCKET = 96                 # letter-count vectors of a bucket of a task's tree

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Letters of a word: a-z and the letters of Latin-1, one byte each in Latin-1.
LETTERS = [*range(0x61, 0x7B), *range(0xC0, 0x100)]
_DIM = np.full(256, -1, "int16")
_DIM[LETTERS] = np.arange(len(LETTERS))


def occurrences(docs: DataFrame, edit: Callable[[Column, Column], Column] | None = None, min_length: int = MIN_LENGTH,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word): one row per occurrence of a run of at least ``min_length`` letters,
    A-Z lower-cased; ``edit(document id, run)`` may change a run first."""
    pattern = rf"[A-Za-zÀ-ÿ]{{{min_length},}}"
    d = docs.select(F.col(id_col).cast("string").alias("id"),
                    F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(pattern), F.lit(0))).alias("word"))
    d = d.select("id", F.when(F.col("word").rlike("[A-Z]"), F.translate("word", UPPER, LOWER)).otherwise(F.col("word")).alias("word"))
    word = edit(F.coalesce("id", F.lit("")), F.col("word")) if edit else F.col("word")
    return d.select(word.alias("word")).where(F.length("word") >= min_length)


def vocabulary(occurring: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words with at least ``min_count`` occurrences."""
    return occurring.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


# --- letter counts and trees -------------------------------------------------------------------

def letter_counts(words: list[str]) -> np.ndarray:
    """(words x letters) counts."""
    out = np.zeros((len(words), len(LETTERS)), "int32")
    if words:
        sizes = np.fromiter(map(len, words), "int64", len(words))
        dims = _DIM[np.frombuffer("".join(words).encode("latin-1"), "uint8")]
        np.add.at(out, (np.repeat(np.arange(len(words)), sizes), dims), 1)
    return out


def best_split(v: np.ndarray) -> tuple[int, int] | None:
    """(letter, count), of the letters that vary most, so that counts up to it
    hold as near to half of the rows as any; None if all rows are equal."""
    best, spread = None, v.var(0)
    for d in [d for d in np.argsort(-spread, kind="stable")[:SPLIT_LETTERS].tolist() if spread[d] > 0]:
        upto = np.cumsum(np.bincount(v[:, d]))[:-1]
        t = int(np.abs(upto - len(v) / 2).argmin())
        off = abs(int(upto[t]) - len(v) / 2)
        if 0 < upto[t] < len(v) and (best is None or off < best[0]):
            best = off, d, t
    return None if best is None else best[1:]


def grow(v: np.ndarray, leaves: int) -> tuple:
    """A tree with about ``leaves`` leaves: (letter, count, low side, high side), or () for a leaf."""
    split = best_split(v) if leaves > 1 and len(v) > 1 else None
    if split is None:
        return ()
    low = v[:, split[0]] <= split[1]
    share = min(max(round(leaves * low.mean()), 1), leaves - 1)
    return (*split, grow(v[low], share), grow(v[~low], leaves - share))


def reached(tree: tuple, v: np.ndarray, minus: int) -> Iterator[tuple[int, np.ndarray, bool]]:
    """(leaf, rows of ``v``, own) for every leaf whose box some row reaches by
    at most one letter more and ``minus`` letters fewer.  ``own`` leaves hold
    the rows' vectors themselves.  Leaves are numbered from the low side."""
    leaf = 0

    def walk(node: tuple, rows: np.ndarray, box: dict[int, tuple[int, int]]):
        nonlocal leaf
        if not node:
            up = sum((np.maximum(lo - v[rows, d], 0) for d, (lo, _) in box.items()), np.zeros(len(rows), "int32"))
            down = sum((np.maximum(v[rows, d] - hi, 0) for d, (_, hi) in box.items()), np.zeros(len(rows), "int32"))
            own = (up == 0) & (down == 0)
            if own.any():
                yield leaf, rows[own], True
            if (other := ~own & (up <= 1) & (down <= minus)).any():
                yield leaf, rows[other], False
            leaf += 1
            return
        d, t, low, high = node
        lo, hi = box.get(d, (0, 1 << 30))
        yield from walk(low, rows[v[rows, d] <= t + minus], {**box, d: (lo, min(hi, t))})
        yield from walk(high, rows[v[rows, d] >= t], {**box, d: (max(lo, t + 1), hi)})

    yield from walk(tree, np.arange(len(v)), {})


def search(points: np.ndarray, asked: np.ndarray, minus: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs (asked, point) whose counts differ by one letter more and
    ``minus`` letters fewer.  Rows of ``points`` are distinct, and all their
    words are 1 - ``minus`` letters longer than the asking ones: a squared
    distance of 1 + ``minus`` is then exactly such an edit."""
    used = np.flatnonzero(points.any(0) | asked.any(0))
    largest = max(points.max(initial=0), asked.max(initial=0))
    exact = "float32" if largest < 1_000 else "float64"  # sums of squares stay whole numbers
    p, q = points[:, used].astype(exact), asked[:, used].astype(exact)
    p2, q2 = np.einsum("ij,ij->i", p, p), np.einsum("ij,ij->i", q, q)

    def node(rows: np.ndarray) -> tuple:
        """(least counts, greatest counts, (low side, high side) or (rows, points, squares))."""
        box = p[rows].min(0), p[rows].max(0)
        split = best_split(points[rows]) if len(rows) > BUCKET else None
        if split is None:
            return *box, None, (rows, p[rows].T.copy(), p2[rows])
        low = points[rows, split[0]] <= split[1]
        return *box, (node(rows[low]), node(rows[~low])), None

    def walk(at: tuple, ask: np.ndarray):
        lo, hi, sides, bucket = at
        some = q[ask]
        off = some - np.clip(some, lo, hi)
        ask = ask[np.einsum("ij,ij->i", off, off) <= 1 + minus]
        if not len(ask):
            return
        if sides:
            yield from walk(sides[0], ask)
            yield from walk(sides[1], ask)
            return
        rows, columns, squares = bucket
        for k in range(0, len(ask), 1_024):
            one = ask[k:k + 1_024]
            i, j = np.nonzero(q2[one][:, None] + squares[None, :] - 2 * (q[one] @ columns) == 1 + minus)
            if len(i):
                yield one[i], rows[j]

    if len(points) and len(asked):
        tree = node(np.arange(len(points)))
        for at in range(0, len(asked), 8_192):
            yield from walk(tree, np.arange(at, min(at + 8_192, len(asked))))


def one_edit(short: str, long: str) -> bool:
    """Whether one inserted letter, or for equal lengths one replaced letter, turns ``short`` into ``long``."""
    i = next((k for k, (x, y) in enumerate(zip(short, long)) if x != y), len(short))
    return short[i + (len(short) == len(long)):] == long[i + 1:]


def in_order(asking: list[str], points: list[str], fewer: str | None, more: str) -> Iterator[tuple[str, str]]:
    """Near pairs (asking, point) among words whose counts differ by the letter
    ``more`` and, for equal lengths, the letter ``fewer``.  Small sets are
    compared pair by pair; large ones look their edits up, one letter at a time."""
    if len(asking) * len(points) <= 4 * (len(asking) + len(points)):
        yield from ((w, p) for w in asking for p in points if one_edit(w, p))
        return
    if fewer is None:
        known = set(asking)
        for p in points:
            yield from ((w, p) for w in {p[:i] + p[i + 1:] for i, c in enumerate(p) if c == more} & known)
        return
    known = set(points)
    for w in asking:
        yield from ((w, p) for p in {w[:i] + more + w[i + 1:] for i, c in enumerate(w) if c == fewer} & known)


def letters(words: list[str]) -> np.ndarray:
    """Words of one length as a matrix of Latin-1 bytes."""
    return np.frombuffer("".join(words).encode("latin-1"), "uint8").reshape(len(words), -1)


def edited_once(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """``one_edit`` row by row."""
    if short.shape[1] == long.shape[1]:
        return (short != long).sum(1) == 1
    upto = np.logical_and.accumulate(short == long[:, :-1], axis=1)            # equal up to and with this letter
    behind = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1)[:, ::-1]
    return behind[:, 0] | upto[:, -1] | (upto[:, :-1] & behind[:, 1:]).any(1)


def near_in_group(points: list[str], asking: list[str], minus: int) -> Iterator[tuple[str, str]]:
    """Near pairs (asking, point); all points have one length, all asking words
    that length or, for ``minus`` 0, one less."""
    def by_vector(words: list[str]) -> tuple:
        """Distinct vectors; the words in their order; each vector's first word and number of words."""
        vectors, place, many = np.unique(letter_counts(words), axis=0, return_inverse=True, return_counts=True)
        ordered = np.array(words, object)[np.argsort(place.ravel(), kind="stable")]
        return vectors, ordered, letters(ordered.tolist()), np.cumsum(many) - many, many
    if not points or not asking:
        return
    (pv, p_words, p_letters, p_at, p_many), (qv, q_words, q_letters, q_at, q_many) = by_vector(points), by_vector(asking)
    step = max(1, GROUP_CHARS // len(points[0]))
    for qs, ps in search(pv, qv, minus):
        pairs = q_many[qs] * p_many[ps]
        few = pairs <= FEW_PAIRS  # compared in bulk
        n, q0, p0, per = (x[few] for x in (pairs, q_at[qs], p_at[ps], p_many[ps]))
        of = np.repeat(np.arange(len(n)), n)
        k = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        q1, p1 = q0[of] + k // per[of], p0[of] + k % per[of]
        for at in range(0, len(q1), step):
            q, p = q1[at:at + step], p1[at:at + step]
            near = edited_once(q_letters[q], p_letters[p])
            yield from zip(q_words[q[near]].tolist(), p_words[p[near]].tolist())
        for q, p in zip(qs[~few].tolist(), ps[~few].tolist()):
            diff = pv[p] - qv[q]
            yield from in_order(q_words[q_at[q]:q_at[q] + q_many[q]].tolist(), p_words[p_at[p]:p_at[p] + p_many[p]].tolist(),
                                chr(LETTERS[diff.argmin()]) if minus else None, chr(LETTERS[diff.argmax()]))


# --- the distributed join ----------------------------------------------------------------------

def top_trees(words: DataFrame, leaf_words: int = LEAF_WORDS) -> dict[int, tuple]:
    """Tree by word length, for the lengths that have more than ``leaf_words`` words."""
    sizes = {r["length"]: r["count"] for r in words.groupBy(F.length("word").alias("length")).count()
             .where(F.col("count") > leaf_words).collect()}
    if not sizes:
        return {}
    total = sum(sizes.values())
    leaf_words = max(leaf_words, math.ceil(total / MAX_LEAVES))
    at = F.pmod(F.xxhash64("word", F.lit("kd-sample")), F.lit(1_000_000)) < min(1.0, SAMPLE_WORDS / total) * 1_000_000
    rows = words.where(at & F.length("word").isin(list(sizes))).select("word").collect() if len(sizes) <= 1_000 else \
        [r for r in words.where(at).select("word").collect() if len(r["word"]) in sizes]
    by_length: dict[int, list[str]] = {}
    for r in rows:
        by_length.setdefault(len(r["word"]), []).append(r["word"])
    return {n: grow(letter_counts(sorted(some)), math.ceil(sizes[n] / leaf_words)) for n, some in by_length.items()}


def _routes(v: np.ndarray, size: int, trees: dict[int, tuple]) -> list[tuple]:
    """(length, leaf, role, own, rows) of words with letter counts ``v`` and length ``size``."""
    out, home = [], np.zeros(len(v), "int64")
    for leaf, r, own in reached(trees.get(size, ()), v, minus=1):
        if own:
            home[r] = leaf
            out += [(size, leaf, 0, True, r), (size, leaf, 1, True, r)]
    for leaf, r, own in reached(trees.get(size, ()), v, minus=1):
        if not own:
            out.append((size, leaf, 1, False, r[home[r] < leaf]))
    return out + [(size + 1, leaf, 2, False, r) for leaf, r, _ in reached(trees.get(size + 1, ()), v, minus=0)]


def routed(words: DataFrame, trees: dict[int, tuple]) -> DataFrame:
    """(length, leaf, role, own, word, n): role 0 a point of its own box; 1 asks
    for replacements, in its own box (own) and the later boxes of its length; 2 asks
    for insertions in the boxes of the next length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_numpy()
            sizes = np.fromiter(map(len, words), "int64", len(words))
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                step = max(1, min(4_096, GROUP_CHARS // size))
                for at in range(0, len(rows), step):
                    some = rows[at:at + step]
                    out = _routes(letter_counts(words[some].tolist()), size, trees)
                    of = some[np.concatenate([r for *_, r in out])]
                    column = lambda k, dtype: pa.array(np.concatenate([np.full(len(o[4]), o[k], dtype) for o in out]))  # noqa: E731,B023
                    yield pa.RecordBatch.from_arrays(
                        [column(0, "int64"), column(1, "int64"), column(2, "int32"), column(3, "bool"),
                         pa.array(words[of].tolist(), pa.string()), pa.array(n[of])], ["length", "leaf", "role", "own", "word", "n"])
    return words.select("word", "n").mapInArrow(run, "length long, leaf long, role int, own boolean, word string, n long")


def dealt(routes: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Routes with the task group (length, leaf, pp, ap): a box's points are cut
    into parts by hash, its askers too, and each part of the one meets each of
    the other.  Boxes that nobody asks, or without points, are left out."""
    parts = lambda is_point: F.greatest(
        F.ceil(F.sum(F.when(is_point, 1).otherwise(0)) / group_rows),
        F.ceil(F.sum(F.when(is_point, F.length("word")).otherwise(0)) / GROUP_CHARS))
    point = F.col("role") == 0
    sizes = (routes.groupBy("length", "leaf").agg(parts(point).alias("points"), parts(~point).alias("askers"))
             .where("points > 0 AND askers > 0"))
    j = routes.join(written(sizes, "spelling-boxes"), ["length", "leaf"])
    own_part = lambda n: F.array(F.pmod(F.xxhash64("word"), F.col(n)))
    every = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    j = j.withColumn("pp", F.explode(F.when(point, own_part("points")).otherwise(every("points"))))
    return j.withColumn("ap", F.explode(F.when(point, every("askers")).otherwise(own_part("askers")))).drop("points", "askers")


def near_pairs(words: DataFrame, leaf_words: int = LEAF_WORDS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(a, a_n, b, b_n): every pair of near words of (word, n) once."""
    routes = written(routed(words, top_trees(words, leaf_words)), "spelling-routes")

    def run(group: pa.Table) -> pa.Table:
        words, role, own = group["word"].to_pylist(), group["role"].to_pylist(), group["own"].to_pylist()
        count = dict(zip(words, group["n"].to_pylist()))
        asking = lambda k: [w for w, r in zip(words, role) if r == k]
        at_home = {w for w, r, o in zip(words, role, own) if r == 1 and o}
        pairs = [(a, b) for a, b in near_in_group(asking(0), asking(1), minus=1)
                 if a not in at_home or a < b]  # within its own box a pair is found from both sides
        pairs += near_in_group(asking(0), asking(2), minus=0)
        return pa.table([pa.array([a for a, _ in pairs], pa.string()), pa.array([count[a] for a, _ in pairs], pa.int64()),
                         pa.array([b for _, b in pairs], pa.string()), pa.array([count[b] for _, b in pairs], pa.int64())],
                        names=["a", "a_n", "b", "b_n"])

    return dealt(routes, group_rows).groupBy("length", "leaf", "pp", "ap").applyInArrow(run, "a string, a_n long, b string, b_n long")


# --- forms and roots ---------------------------------------------------------------------------

def forms(words: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n): the near word of largest count (ties: the
    smaller word), if its count is ``ratio`` times the word's."""
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")).unionAll(
        pairs.select("b", "a", "a_n"))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("k"), "near")).alias("best"))
    takes = -F.col("best.k") >= F.col("n") * ratio
    return words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(takes, F.col("best.near")).alias("form"), F.when(takes, -F.col("best.k")).alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: the last word along the forms, by pointer doubling."""
    at = written(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-forms")
    while True:
        c, r = at.alias("c"), at.alias("r")
        step = written(c.join(r, F.col("c.root") == F.col("r.word"), "left").select(
            "c.word", F.coalesce("r.root", "c.root").alias("root"), F.col("r.root").isNotNull().alias("moved")), "spelling-roots")
        if step.where("moved").isEmpty():
            return step.drop("moved")
        at = step.drop("moved")


def group(words: DataFrame, ratio: int = RATIO, leaf_words: int = LEAF_WORDS, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every row of ``words`` (word, n)."""
    words = written(words, "spelling-words")
    formed = written(forms(words, near_pairs(words, leaf_words, group_rows), ratio), "spelling-near")
    last = roots(formed)
    return formed.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, edit: Callable[[Column, Column], Column] | None = None, min_length: int = MIN_LENGTH,
             min_count: int = MIN_COUNT, ratio: int = RATIO, id_col: str = "doc_id", text_col: str = "text", **sizes) -> DataFrame:
    """``group`` over the vocabulary of the documents."""
    return group(vocabulary(occurrences(docs, edit, min_length, id_col, text_col), min_count), ratio, **sizes)
