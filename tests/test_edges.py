"""Empty and odd inputs: nothing may raise under ANSI mode."""

from support import one_col
from lectern.functions import text as T
from lectern.operators import blocks as BL
from lectern.operators import segment as SEG
from lectern.operators import tables as TB


def test_text_edges(spark):
    vals = ["", "1)", "1);", " 1) ", "x 1)1)1)", "\n", None]
    assert one_col(spark, vals, T.reorder_options) == ["", "\n1)", "\n1);", "\n1)", "x\n1)\n1)\n1)", "\n", None]
    assert one_col(spark, vals, T.answer_text) == [None] * 7
    assert one_col(spark, ["", "   ", "\n\n"], T.clean_text) == ["", "", ""]


def test_empty_frames(spark):
    pages = spark.createDataFrame([], "doc_id string, page_no int, text string")
    cls = SEG.classify_lines(SEG.page_lines(pages), SEG.EXAM_RULES)
    assert SEG.items(cls).count() == 0 and SEG.section_info(cls).count() == 0
    blocks = spark.createDataFrame([], "doc_id string, page_no int, block_no int, x0 double, y0 double, text string")
    assert BL.attribute_blocks(blocks).count() == 0
    docs = spark.createDataFrame([("d", "")], "doc_id string, text string")
    assert SEG.items(SEG.classify_lines(SEG.document_lines(docs), SEG.EXAM_RULES)).count() == 0


def test_single_row_table_and_no_tables(spark):
    cells = spark.createDataFrame([("d", 0, 0, 0, "only")], "doc_id string, table_no int, row_no int, col_no int, text string")
    (md,) = TB.table_rows(cells).select(TB.markdown("rows")).first()
    assert md == "| only |\n| --- |\n"
    qs = spark.createDataFrame([("d", 0, 1, "А", "А1", "text only")],
                               "doc_id string, section_order int, pos bigint, section string, question_id string, text string")
    none = cells.where("false").groupBy("doc_id", "table_no").count().selectExpr(
        "doc_id", "table_no", "array(array('x')) AS rows")
    placed, unplaced = TB.place_tables(qs, none)
    assert [r.text for r in placed.collect()] == ["text only"] and unplaced.count() == 0
