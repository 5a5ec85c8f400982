"""Placement through the anchor index against the fold over all tables and questions."""

import random
import time

import pytest

from lectern.operators import placement as P
from lectern.operators import tables as TB


def bounds(text, a, z):
    if text is None or a is None or z is None or not a and not z:
        return None
    p = text.find(a)
    e = text.find(z, p + len(a)) if p >= 0 else -1
    return None if e < 0 else (p, e + len(z))


def fold(texts, tables):
    """Every table against every question."""
    texts, unplaced = list(texts), []
    for n, a, z, md in tables:
        for i, t in enumerate(texts):
            if (b := bounds(t, a, z)) is not None:
                texts[i] = t.replace(t[b[0]:b[1]], md)
                break
        else:
            unplaced.append(n)
    return texts, unplaced


def random_case(seed):
    r = random.Random(seed)
    word = lambda n: "".join(r.choice("abé|- ") for _ in range(r.randint(0, n)))
    texts = [r.choice([None, word(30), word(12)]) if r.random() < 0.1 else word(30) for _ in range(r.randint(0, 8))]
    tables = [(k, r.choice([None, "", word(2), word(3)]) if r.random() < 0.2 else word(3), word(2), f"|{word(4)}|\n") for k in range(r.randint(0, 12))]
    return texts, tables


@pytest.mark.parametrize("block", range(5))
def test_index_equals_fold(block):
    for seed in range(block * 400, block * 400 + 400):
        texts, tables = random_case(seed)
        assert P.place(texts, tables) == fold(texts, tables)
        flags = P.candidates(texts, [(a, z) for _, a, z, _ in tables if a is not None and z is not None])
        assert flags == [any(bounds(t, a, z) for _, a, z, _ in tables) for t in texts]


def test_distributed_equals_fold(spark):
    docs = {d: random_case(d) for d in range(60)}
    qs = [(d, 0 if i % 2 else 1, i, "s", f"q{i}", t) for d, (texts, _) in docs.items() for i, t in enumerate(texts)]
    ts = [(d, n, a, z, md) for d, (_, tables) in docs.items() for n, a, z, md in tables]
    questions = spark.createDataFrame(qs, "doc_id int, section_order int, pos int, section string, question_id string, text string")
    tables = spark.createDataFrame(ts, "doc_id int, table_no int, a string, z string, md string")
    placed, unplaced = P.place_anchored(questions, tables, part_rows=2)
    want_q, want_u = [], []
    for d, (texts, tabs) in docs.items():
        order = sorted(range(len(texts)), key=lambda i: (0 if i % 2 else 1, i))
        out, left = fold([texts[i] for i in order], tabs)
        want_q += [(d, i, t) for i, t in zip(order, out)]
        want_u += [(d, n) for n in left]
    assert sorted(((r.doc_id, r.pos, r.text) for r in placed.collect()), key=repr) == sorted(want_q, key=repr)
    assert sorted((r.doc_id, r.table_no) for r in unplaced.collect()) == sorted(want_u)


def test_work_grows_with_the_input_not_its_square():
    """Twice the questions and tables take about twice the time; a fold over all pairs takes four times."""
    def case(n):
        r = random.Random(n)
        texts = [f"Question {i}: k{i}a " + " ".join(r.choice(("x", "yy", "zzz")) for _ in range(40)) + f" k{i}z end" for i in range(n)]
        tables = [(i, f"k{i}a", f"k{i}z", f"| t{i} |\n") for i in r.sample(range(2 * n), n)]  # half of them fit nowhere
        return texts, tables

    def seconds(n):
        texts, tables = case(n)
        at = time.process_time()
        P.candidates(texts, [t[1:3] for t in tables])
        out, unplaced = P.place(texts, tables)
        assert len(unplaced) == sum(t[0] >= n for t in tables) and sum("| t" in t for t in out) == n - len(unplaced)
        return time.process_time() - at
    seconds(500)
    small, large = (min(seconds(n) for _ in range(3)) for n in (3_000, 24_000))
    assert large < 8 * small * 2.5


def test_both_results_read_one_table(spark, tmp_path):
    """The fold is in neither result's plan: both only read what was written."""
    qs = spark.createDataFrame([("d", 0, 1, "А", "A1", "x H y T z")],
                               "doc_id string, section_order int, pos bigint, section string, question_id string, text string")
    tabs = spark.createDataFrame([("d", 1, [["H"], ["T"]]), ("d", 2, [["no"], ["T"]])], "doc_id string, table_no int, rows array<array<string>>")
    for df in TB.place_tables(qs, tabs):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CoGroup" not in plan and any("placed-tables" in f for f in df.inputFiles())


def test_lists_of_a_batch_with_empty_and_null_ones():
    import pyarrow as pa
    from lectern.operators.placement import each, in_slices
    kind = pa.list_(pa.struct([("a", pa.string()), ("n", pa.int64()), ("z", pa.string())]))
    lists = pa.array([[{"a": "x", "n": 1, "z": "y"}], [], None, [{"a": None, "n": 2, "z": ""}, {"a": "p", "n": 3, "z": "q"}]], kind)
    want = [[["x"], ["y"]], [[], []], [[], []], [[None, "p"], ["", "q"]]]
    assert list(each(lists, "a", "z")) == want and list(each(lists.slice(1), "a", "z")) == want[1:]
    sizes = [b.num_rows for b in in_slices(pa.RecordBatch.from_arrays([pa.array(range(10))], ["i"]), 4)]
    assert sizes == [4, 4, 2]  # one batch for many documents
