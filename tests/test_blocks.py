"""Answer and comment attribution from blocks."""

from support import SF_SMALL
from lectern.operators import blocks as BL
from lectern.plans import block_queries as BQ

SCHEMA = "doc_id string, page_no int, block_no int, x0 double, y0 double, text string"


def test_reference_case(spark):
    rows = [("c", 1, 0, 141.0, 100.0, "А1. Вопрос.\nОтвет: 1"),
            ("c", 1, 1, 410.0, 100.0, "Комментарий к"),
            ("c", 1, 2, 410.0, 120.0, "вопросу 1")]
    got = BL.attribute_blocks(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [(r.question_id, r.answer, r.comment) for r in got] == [("А1", "1", "Комментарий к вопросу 1")]


def test_fixture_rules(spark):
    rows = [("c", 1, 0, 410.0, 5.0, "до"),
            ("c", 1, 1, 141.0, 100.5, "А1. Вопрос"),
            ("c", 1, 2, 410.0, 100.4, "к1"),
            ("c", 1, 3, 140.0, 150.0, "А9. Граница"),
            ("c", 2, 0, 141.0, 10.0, "Ответ: чад"),
            ("c", 2, 1, 410.0, 20.0, "к2"),
            ("c", 2, 2, 141.0, 30.0, "А2 без точки"),
            ("c", 2, 3, 141.0, 40.0, "Ответ: 7")]
    got = BL.attribute_blocks(spark.createDataFrame(rows, SCHEMA), chunk_rows=2).collect()
    assert [(r.question_id, r.answer, r.comment) for r in got] == [("А1", "7", "к1 к2")]


def test_chunk_invariance(spark):
    a = sorted(map(tuple, BQ.q_attribute_blocks(spark, SF_SMALL).collect()))
    b = sorted(map(tuple, BQ.q_attribute_blocks(spark, SF_SMALL, chunk_rows=2).collect()))
    assert a == b and len(a) > 0
