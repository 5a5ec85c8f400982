"""Row-bounded prefix scans: equal results for any cut, and few rows in the carry step."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lectern.operators import segment as SEG
from lectern.operators.scan import prefix_scan, row_chunks


def rows(n=3000, seed=5):
    """One long document on sparse pages, one of medium length, many short ones."""
    r = random.Random(seed)
    out = [("long", p, y, k) for k, (p, y) in enumerate((r.randrange(10**6), r.randrange(3)) for _ in range(n))]
    out += [("mid", 7, 0, k) for k in range(300)]  # all at one page and height
    out += [(f"d{d}", p, 0, p) for d in range(40) for p in range(d % 5)]
    return [(d, p, y, k, None if r.random() < 0.7 else r.randrange(100), r.randrange(9)) for d, p, y, k in out]


SCHEMA = "doc string, page int, y int, no int, mark int, n int"
def order():
    return F.struct("page", "y", "no")



def brute(data):
    out, last, total = [], {}, {}
    for d, p, y, k, mark, n in sorted(data, key=lambda x: x[:4]):
        last[d] = mark if mark is not None else last.get(d)
        total[d] = total.get(d, 0) + n
        out.append((d, p, y, k, last[d], total[d]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk,most", [(1, 4096), (7, 4096), (100, 4096), (100, 5), (10**6, 4096)])
def test_scan_is_the_same_for_any_cut(spark, chunk, most):
    data = rows()
    df = row_chunks(spark.createDataFrame(data, SCHEMA).repartition(6), ["doc"], order(), chunk, most)
    got = prefix_scan(df.withColumn("_o", order()), ["doc"], "_o", "_chunk", last={"run": F.col("mark")}, sums={"total": F.col("n")})
    assert sorted((tuple(r) for r in got.select("doc", "page", "y", "no", "run", "total").collect()), key=repr) == brute(data)


def test_chunks_are_bounded_in_rows_and_ordered(spark):
    df = row_chunks(spark.createDataFrame(rows(20_000), SCHEMA), ["doc"], order(), 1000)
    sizes = {(r["doc"], r["_chunk"]): r["count"] for r in df.groupBy("doc", "_chunk").count().collect()}
    of_long = [n for (d, _), n in sizes.items() if d == "long"]
    assert 12 <= len(of_long) <= 30 and max(of_long) < 2500  # one carry row a chunk, not one a page
    assert all(k == 0 for d, k in sizes if d != "long")
    bounds = df.where("doc = 'long'").groupBy("_chunk").agg(F.min(order()).alias("a"), F.max(order()).alias("b")).orderBy("_chunk").collect()
    assert all(tuple(x["b"]) < tuple(y["a"]) for x, y in zip(bounds, bounds[1:]))


def test_chunks_do_not_depend_on_partitions(spark):
    data = rows()
    one = row_chunks(spark.createDataFrame(data, SCHEMA).coalesce(1), ["doc"], order(), 50)
    many = row_chunks(spark.createDataFrame(data, SCHEMA).repartition(9, "no"), ["doc"], order(), 50)
    assert sorted(map(repr, one.collect())) == sorted(map(repr, many.collect()))


def test_one_line_pages(spark):
    pages = [("e", p, f"line {p}\n" if p % 3 else f"half {p} ") for p in range(0, 40_000, 13)]
    df = spark.createDataFrame(pages, "doc_id string, page_no int, text string")
    want = "".join(t for _, _, t in pages).split("\n")
    for chunk in (64, 1000):
        got = {r["line_no"]: r["line"] for r in SEG.page_lines(df, page_chunk=chunk).collect()}
        assert got == dict(enumerate(want))


def test_short_keys_are_scanned_without_a_join(spark):
    data = [x for x in rows() if x[0] != "long"]
    df = row_chunks(spark.createDataFrame(data, SCHEMA), ["doc"], order(), 1000)
    got = prefix_scan(df.withColumn("_o", order()), ["doc"], "_o", "_chunk", last={"run": F.col("mark")}, sums={"total": F.col("n")})
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((tuple(r) for r in got.select("doc", "page", "y", "no", "run", "total").collect()), key=repr) == brute(data)


def test_a_long_key_is_dealt_by_chunk_after_a_join_on_the_keys(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    df = df.hint("merge").join(df.select("doc").distinct(), "doc", "left_semi")  # now dealt by doc
    df = row_chunks(df, ["doc"], order(), 100).withColumn("_o", order())
    got = prefix_scan(df, ["doc"], "_o", "_chunk", last={"run": F.col("mark")}, sums={"total": F.col("n")})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(doc#\d+, _chunk#\d+L?, \d+\)", plan)
    assert sorted((tuple(r) for r in got.select("doc", "page", "y", "no", "run", "total").collect()), key=repr) == brute(rows())
