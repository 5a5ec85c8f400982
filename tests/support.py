"""Paths and helpers that the tests share (a module of its own: two folders hold a ``conftest``)."""

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


def one_col(spark, values, fn, ddl="s string"):
    """Apply a column builder to a list of values and return the results."""
    df = spark.createDataFrame([(v,) for v in values], ddl)
    name = ddl.split()[0]
    return [r[0] for r in df.select(fn(name).alias("out")).collect()]
