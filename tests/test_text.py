"""Rule cases for the text operators."""

from support import one_col
from lectern.functions import text as T


def test_clean_text_rules(spark):
    cases = {
        "a\n\nb": "ab",
        "a \n b": "ab",
        "a\n1) b\n8) c\n10) d": "a\n1) b 8) c 10) d",
        "x\nА) y\nA) z": "x\nА) y A) z",
        "всѐ ": "всё",
        "a  b": "a b",
        "a\n  b": "a b",
        "a \nb": "a b",
        " \nb": " b",
        "  lead": "lead",
        "no\u00a0\u00a0break": "no\u00a0break",
    }
    got = one_col(spark, list(cases), T.clean_text)
    assert got == list(cases.values())
    assert one_col(spark, [None], T.clean_text) == [None]


def test_strip_footnotes_rules(spark):
    cases = {
        "Question 1": "Question",
        "H2O2": "H2O",
        "А1. Текст ДРТ–2023 г. 5": "А1. Текст",
        "x ДРТ-2023 г.": "x ДРТ-2023 г.",
        "ответ 21453.": "ответ 21453.",
        "a ДРТ–2023 г.\nb": "ab",
    }
    assert one_col(spark, list(cases), T.strip_footnotes) == list(cases.values())


def test_reorder_options_rules(spark):
    cases = {
        "Q\n1) a;\n3) c;\n2) b. Tail": "Q\n1) a;\n2) b.\n3) c;\nTail",
        "Q 2) b; 1) a; 3) 3.5.": "Q 2) b;\n1) a;\n3) 3.\n5.",
        "Q 1) a 10) j 2) b;": "Q\n1) a\n2) b;\n10) j",
        "Q 11) k; 2) b": "Q 1\n1) k;\n2) b",
        "no options": "no options",
    }
    assert one_col(spark, list(cases), T.reorder_options) == list(cases.values())


def test_normalise_question(spark):
    cases = {
        "А1. Question 1\n": "А1. Question",
        "А2. Вопрос\n2) б;\n1) а;\n3) в.\nДРТ–2023 г. 4\n": "А2. Вопрос\n2) б;\n1) а;\n3) в.",
    }
    assert one_col(spark, list(cases), T.normalise_question) == list(cases.values())


def test_answer_and_block_id(spark):
    got = one_col(spark, ["А1. Вопрос.\nОтвет: 1", "Ответ:  чад ", "нет", "Ответ: a\rb"], T.answer_text)
    assert got == ["1", "ЧАД", None, "A\rB"]
    got = one_col(spark, ["А1. Вопрос", "А2 без точки", "A1. latin", "В12.x"], T.block_question_id)
    assert got == ["А1", None, None, "В12"]


def test_data_uri_has_no_breaks(spark):
    df = spark.createDataFrame([(bytes(range(80)), "png")], "content binary, fmt string")
    (uri,) = df.select(T.data_uri("content", "fmt")).first()
    assert uri.startswith("data:image/png;base64,") and "\n" not in uri and "\r" not in uri
    import base64
    assert base64.b64decode(uri.split(",", 1)[1]) == bytes(range(80))


def test_prompt_keeps_dollar(spark):
    (p,) = one_col(spark, ["cost $1 \\1"], T.prompt_text)
    assert p.startswith("cost $1 \\1\n\nBefore answering")
    assert p.endswith("where $ANSWER is the answer to the question.")


def test_fixed_letters_are_cyrillic():
    from lectern import dims
    from lectern.operators import segment as SEG
    assert [hex(ord(c)) for c in T.PROTECTED_MARKERS[7:]] == ["0x410", "0x411", "0x412", "0x413", "0x414"]
    assert [hex(ord(c)) for c, _ in dims.SECTION_LATIN] == ["0x410", "0x412"]
    assert [lat for _, lat in dims.SECTION_LATIN] == ["A", "B"]
    assert "А" in SEG.EXAM_RULES.item and "В" in SEG.EXAM_RULES.item and "A" not in SEG.EXAM_RULES.item
    assert dims.LETTER_EXAMPLES[0][1][0] == "O" and dims.LETTER_EXAMPLES[0][1][1] == "б"
    assert "–" in T.FOOTER_PATTERN and dims.GEO_2023_IMAGE_QUESTIONS[0][0] == "А"
