"""Segmentation (S1, W1-W3, A1-A3) on hand-made exams and chunk invariance."""

from support import SF_SMALL
from lectern.operators import segment as SEG
from lectern.plans import text_queries as TQ


def _pages(spark, pages):
    return spark.createDataFrame([("d", i + 1, t) for i, t in enumerate(pages)],
                                 "doc_id string, page_no int, text string")


def test_fixture_exam(spark):
    text = "Вступление\nЧасть А\nИнфо\nА1. Раз\nдва\nА2. Ещё\nA3. латинская\nА1. Три\nЧастка В\nВ1. Х"
    # split over pages in the middle of a line: pages are concatenated first
    pages = [text[:20], text[20:45], text[45:]]
    cls = SEG.classify_lines(SEG.page_lines(_pages(spark, pages)), SEG.EXAM_RULES, line_chunk=2)
    got = sorted((r.section, r.question_id, r.pos, r.text) for r in SEG.items(cls).collect())
    assert got == [("А", "А1", 3, "А1. Три"), ("А", "А2", 5, "А2. Ещё A3. латинская"), ("В", "В1", 9, "В1. Х")]
    info = {r.section: r.general_info for r in SEG.section_info(cls).collect()}
    assert info == {"А": "Инфо", "В": ""}


def test_repeated_header_fold(spark):
    text = "Часть А\ni1\ni2\nА1. a\nЧасть А\nj\nА2. b\nЧасть А\nk"
    cls = SEG.classify_lines(SEG.page_lines(_pages(spark, [text])), SEG.EXAM_RULES)
    info = {r.section: r.general_info for r in SEG.section_info(cls).collect()}
    assert info == {"А": "i1 i2jk\n"}


def test_question_in_other_section_letter(spark):
    text = "Часть А\nВ1. under A\nЧасть В\nВ3. real"
    cls = SEG.classify_lines(SEG.page_lines(_pages(spark, [text])), SEG.EXAM_RULES)
    got = sorted((r.section, r.question_id) for r in SEG.items(cls).collect())
    assert got == [("А", "В1"), ("В", "В3")]


def test_page_lines_across_pages(spark):
    pages = ["ab", "c\nd", "", "e\n", "f"]
    got = sorted((r.line_no, r.line) for r in SEG.page_lines(_pages(spark, pages), page_chunk=2).collect())
    assert got == [(0, "abc"), (1, "de"), (2, "f")]


def test_chunk_size_does_not_change_results(spark):
    for q in (TQ.q_segment_lines, TQ.q_section_info):
        big = sorted(map(tuple, q(spark, SF_SMALL).collect()))
        small = sorted(map(tuple, q(spark, SF_SMALL, line_chunk=3).collect()))
        assert big == small and len(big) > 0
