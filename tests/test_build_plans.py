"""The build broadcasts only the fixed dimension tables: tables that grow with the exams never go to the driver."""

import pytest
from pyspark.sql import functions as F

from lectern import build
from lectern.operators import assets, scan
from lectern.plans import build_queries as BQ


def file_broadcasts(df):
    """The broadcasts in the plan of ``df`` that read files."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(x) - len(x.lstrip(" :+-")) for x in lines]
    out = []
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            out += [x.strip() for x in lines[i:end] if "FileScan" in x]
    return out


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """(the broadcasts of the steps that the build writes, its outputs) over 60 customers, as files of a few KB."""
    sf_dir = str(tmp_path_factory.mktemp("sf"))
    spark.range(60).select(F.col("id").alias("c_custkey"), F.concat(F.lit("Customer "), F.col("id").cast("string")).alias("c_name"),
                           F.lit("FURNITURE").alias("c_mktsegment")).coalesce(1).write.parquet(f"{sf_dir}/customer.parquet")
    found = {}
    with pytest.MonkeyPatch.context() as patch:
        for module, name in ((build, "write_table"), (assets, "materialize"), (scan, "materialize")):
            def seen(spark, df, what, write=getattr(module, name)):
                found.setdefault(what, []).extend(file_broadcasts(df))
                return write(spark, df, what)
            patch.setattr(module, name, seen)
        result = BQ._built(spark, sf_dir)
    return found, result


def test_steps_and_images_broadcast_no_table_that_grows(built):
    found, result = built
    assert {"page-lines", "consult-blocks", "answers", "image-catalogue", "image-near-text", "image-metadata", "replaced-images"} <= found.keys()
    assert {k: v for k, v in found.items() if v} == {}
    assert file_broadcasts(result.images) == []
    assert result.images.count() == 3 * 60


def test_problems_broadcast_no_table_that_grows(built):
    _, result = built
    assert file_broadcasts(result.problems) == []
    none = result.problems.where("problem = 'no answer'").count()
    assert none == 2 * 6  # В1 of every eleventh exam, in two languages


def test_records_broadcast_no_table_that_grows(built):
    _, result = built
    assert file_broadcasts(result.records) == []
    exams = [k for k in range(60) if k % len(BQ.SUBJECTS) != len(BQ.SUBJECTS) - 1]
    want = sum((1 if k % 10 == 0 else 2) * (2 if k % 7 == 0 else 1) * (2 if k % 11 == 0 else 3) for k in exams)
    assert result.records.count() == want
