"""The reference's own test inputs (FIXTURES.md section 1), run through our operators."""

from lectern.operators import assets as AS
from lectern.operators import segment as SEG
from lectern.operators import tables as TB


def test_question_extraction_case(spark):
    pages = spark.createDataFrame([("d", 1, "Часть А\nА1. Question 1\nА2. Question 2\nЧасть В\nВ1. Question 3")],
                                  "doc_id string, page_no int, text string")
    cls = SEG.classify_lines(SEG.page_lines(pages), SEG.EXAM_RULES)
    got = {(r.section, r.question_id): r.text for r in SEG.items(cls).collect()}
    assert got == {("А", "А1"): "А1. Question", ("А", "А2"): "А2. Question", ("В", "В1"): "В1. Question"}
    assert {r.section for r in SEG.section_info(cls).collect()} == {"А", "В"}


def test_image_extraction_case(spark):
    imgs = spark.createDataFrame([("d", 1, 1, "png", b"fake_image_data", 10.0, 10.0, 110.0, 110.0)],
                                 "doc_id string, page_no int, img_no int, format string, content binary, "
                                 "x0 double, y0 double, x1 double, y1 double")
    (row,) = AS.describe(imgs).collect()
    assert row.filename == "page1_img1.png" and row.size == len(b"fake_image_data")
    assert row.image_url == "data:image/png;base64,ZmFrZV9pbWFnZV9kYXRh"


def test_table_extraction_case(spark):
    cells = spark.createDataFrame([("d", 0, 0, 0, "header1"), ("d", 0, 0, 1, "header2"),
                                   ("d", 0, 1, 0, "value1"), ("d", 0, 1, 1, "value2")],
                                  "doc_id string, table_no int, row_no int, col_no int, text string")
    (row,) = TB.table_rows(cells).select("table_no", TB.csv_text("rows").alias("csv")).collect()
    assert (row.table_no, row.csv) == (0, "header1,header2\nvalue1,value2\n")
