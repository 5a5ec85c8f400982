"""Atomic append (K1, K2, U1) and the quarantine of bad lines."""

import json

import pytest
from pyspark.sql import functions as F

from lectern import schemas
from lectern.sources import readers, sinks


def records(spark, ids, parts=4):
    meta = ("c", "geo", "2023", "rus", "A", 1, "x")
    rows = [([("system", [("text", "s", None)]), ("user", [("text", f"q {i}", None)])], "t", f"id{i}", meta) for i in ids]
    return spark.createDataFrame(rows, schemas.RECORD).repartition(parts)


def ids(spark, path):
    return sorted(r["id"] for r in readers.read_records(spark, path).select("id").collect())


def failing(df, bad):
    """The records, but the task that meets ``bad`` fails."""
    return df.withColumn("target", F.when(F.col("id") == bad, F.raise_error(F.lit("lost"))).otherwise(F.col("target")))


def test_failed_writer_leaves_nothing_and_the_rerun_adds_once(spark, tmp_path):
    path = f"{tmp_path}/set"
    sinks.create_dataset(spark, path)
    sinks.append_records(records(spark, range(5)), path, batch_id="first")
    some = records(spark, range(100, 140), parts=8)
    with pytest.raises(Exception, match="lost"):
        sinks.append_records(failing(some, "id117"), path, batch_id="second")
    assert ids(spark, path) == sorted(f"id{i}" for i in range(5))
    assert sinks.append_records(some, path, batch_id="second") is True
    want = sorted(f"id{i}" for i in [*range(5), *range(100, 140)])
    assert ids(spark, path) == want
    assert sinks.append_records(some, path, batch_id="second") is False  # a retried job
    assert ids(spark, path) == want


def test_failure_between_writing_and_commit(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/set"
    sinks.create_dataset(spark, path)
    with monkeypatch.context() as m:
        m.setattr(sinks, "_commit", lambda *a: (_ for _ in ()).throw(OSError("driver lost")))
        with pytest.raises(OSError):
            sinks.append_records(records(spark, range(9)), path, batch_id="b")
    sinks.append_records(records(spark, [50]), path, batch_id="other")
    assert ids(spark, path) == ["id50"]  # the part files of the lost attempt lie there unread
    sinks.append_records(records(spark, range(9)), path, batch_id="b")
    assert ids(spark, path) == sorted(f"id{i}" for i in [*range(9), 50])


def test_two_attempts_at_once_count_once(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/set"
    sinks.create_dataset(spark, path)
    with monkeypatch.context() as m:  # both attempts look before either commits
        m.setattr(sinks, "committed", lambda *a: {})
        assert [sinks.append_records(records(spark, range(3)), path, batch_id="b") for _ in range(2)] == [True, False]
    assert ids(spark, path) == ["id0", "id1", "id2"]


def test_without_a_batch_id_records_are_stored_twice(spark, tmp_path):
    path = f"{tmp_path}/set"
    sinks.create_dataset(spark, path)
    for _ in range(2):
        sinks.append_records(records(spark, [1]), path)
    assert ids(spark, path) == ["id1", "id1"]
    with pytest.raises(ValueError):
        sinks.append_records(records(spark, [1]), path, batch_id="../x")
    sinks.create_dataset(spark, path, rewrite=True)
    assert ids(spark, path) == []


def test_bad_lines_are_kept_apart(spark, tmp_path):
    path = f"{tmp_path}/lines"
    records(spark, range(3), 1).write.json(path)
    good = json.dumps({"id": "x", "input": [], "target": None, "metadata": {"points": 2}})
    bad = ["{not json", json.dumps({"id": "y", "input": "text", "metadata": {}}), json.dumps({"input": [], "metadata": {}}),
           json.dumps({"id": "z", "metadata": {}}), json.dumps({"id": "z", "input": []}), good[:-5]]
    with open(f"{path}/part-extra.json", "w") as f:
        f.write("\n".join([good, *bad, "", "  "]) + "\n")
    got, rejects = readers.read_records_checked(spark, path)
    assert sorted(r["id"] for r in got.collect()) == ["id0", "id1", "id2", "x"]
    rows = rejects.collect()
    assert {r["file"] for r in rows} == {"part-extra.json"}
    assert sorted(r["problem"] for r in rows) == ["no id", "no input", "no metadata", "not a record", "not a record", "not a record"]
    assert {r["raw"] for r in rows if r["problem"] == "not a record"} == {bad[0], bad[1], bad[5]}
