"""Scoring rules."""

from pyspark.sql import functions as F

from lectern.functions.score import match_targets, weighted_accuracy
from lectern.operators import scoring as SC


def _score(spark, completion, targets, location="end", ignore_case=True):
    df = spark.createDataFrame([(completion, targets)], "c string, t array<string>")
    r = df.select(match_targets(F.col("c"), F.col("t"), location, ignore_case).alias("m")).first().m
    return r.matched, r.answer


def test_locations(spark):
    assert _score(spark, "... ANSWER: 4", ["4"], "end")[0]
    assert not _score(spark, "... ANSWER: 4", ["4"], "begin")[0]
    assert not _score(spark, "... ANSWER: 4", ["4"], "exact")[0]
    assert _score(spark, "... ANSWER: 4", ["4"], "any")[0]
    assert _score(spark, "... ANSWER: 4", ["x", "4"], "end") == (True, "4")
    assert _score(spark, "answer: Чад", ["ЧАД"], "end", True)[0]
    assert not _score(spark, "answer: Чад", ["ЧАД"], "end", False)[0]


def test_weighted_accuracy(spark):
    df = spark.createDataFrame([(1, 1), (0, 2), (2, 2)], "value int, points int")
    assert abs(df.agg(weighted_accuracy()).first()[0] - 0.6) < 1e-12
    empty = df.where("false")
    assert SC.overall_accuracy(empty).first()[0] == 0.0
    zero = spark.createDataFrame([(0, 0)], "value int, points int")
    assert zero.agg(weighted_accuracy()).first()[0] is None


def test_score_join(spark):
    recs = spark.createDataFrame([("r1", "4", 1), ("r2", "B", 2)], "id string, target string, points int")
    comp = spark.createDataFrame([("r1", "m", "so ANSWER: 4"), ("r2", "m", "ANSWER: a")], "id string, model string, completion string")
    s = SC.score(recs, comp)
    got = sorted((r.id, r.value) for r in s.collect())
    assert got == [("r1", 1), ("r2", 0)]
    (row,) = SC.result_table(s, ["model"]).collect()
    assert row.questions == 2 and abs(row.weighted_accuracy - 1 / 3) < 1e-12


def test_prompts_from_records(spark):
    from lectern import schemas
    recs = spark.createDataFrame(
        [([("system", [("text", "info", None)]), ("user", [("text", "А1. Q", None), ("image", None, "data:x")])],
          "1", "r1", ("c", "phy", "2023", "rus", "A", 1, "k"))], schemas.RECORD)
    (row,) = SC.prompts(recs).collect()
    assert row.system == "info" and row.images == ["data:x"] and row.target == "1"
    assert row.prompt.startswith("А1. Q\n\nBefore answering") and row.prompt.endswith("to the question.")
