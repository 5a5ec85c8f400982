"""The training-data queries against their DuckDB oracles on the smallest tables."""

import duckdb
import pytest

from lectern.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def rounded(row):
    return tuple(round(v, 9) if isinstance(v, float) else v for v in row)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(ORACLE[name]())
    at = [[d[0] for d in cur.description].index(c) for c in cols]
    want = sorted((rounded(r[i] for i in at) for r in cur.fetchall()), key=repr)
    assert sorted((rounded(r[c] for c in cols) for r in df.collect()), key=repr) == want
