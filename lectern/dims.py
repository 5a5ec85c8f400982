"""Small fixed dimension tables (D11, D12) as DataFrames.

They are tiny and constant, so joins against them are broadcast: their size
does not grow with the corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the source data for equal results.
# Subject -> two-digit code, in the source order.
SUBJECT_CODES = [
    ("rus", "01"), ("bel", "02"), ("phy", "03"), ("mth", "04"), ("chm", "05"),
    ("bio", "06"), ("eng", "07"), ("ger", "08"), ("esp", "09"), ("fra", "10"),
    ("bhi", "11"), ("soc", "12"), ("geo", "13"), ("whi", "14"), ("chi", "15"),
]
# Languages, in the order records are produced.
LANGUAGES = ["rus", "bel"]
# Section letters: Cyrillic А (U+0410), В (U+0412) -> Latin A, B; sections in
# this order.
SECTION_LATIN = [("А", "A"), ("В", "B")]
# Answer dictionary used for Belarusian records.
ANSWER_TRANSLATIONS = [
    ("bel", "ПОЛИТИКА", "ПАЛІТЫКА"),
    ("bel", "МЕЖЛЕДНИКОВЬЕ", "МІЖЛЕДАВІКОЎЕ"),
]
# Letter examples appended to the system text.  The Russian one starts with a
# Latin "O" (U+004F), as in the source.
LETTER_EXAMPLES = [
    ("rus", "Oбразец написания букв: А Б В Г Д Е Ё Ж З И Й К Л М Н О П Р С Т У Ф Х Ц Ч Ш Щ Ъ Ы Ь Э Ю Я"),
    ("bel", "Узор напісання літар: А Б В Г Д Е Ё Ж З І Й К Л М Н О П Р С Т У Ў Ф Х Ц Ч Ш Ы Ь Э Ю Я"),
]
# Geography 2023 exam profile: image position (1-based) -> question id.
GEO_2023_IMAGE_QUESTIONS = (
    "А4 А1 А7 А7 А7 А7 А7 А5 А6 А7 А13 А14 А10 А11 А12 А15 В3 В4 В4 В1 В6 В8 В7 В5 В12 В20").split()
# Geography 2023: tables dropped, and text fixes applied in this order.
GEO_2023_EXCLUDED_TABLES = [0]
GEO_2023_TEXT_FIXES = [
    (3, 1, "П ольшча", "Польшча"),
    (4, 1, "С амой", "Самой"),
    (4, 2, "С амай", "Самай"),
]
# Error messages of the exam catalogue checks.
MSG_BAD_SUBJECT = "Subject '{}' is not a valid subject code."
MSG_BAD_LANGUAGE = "Language '{}' is not a valid language."
MSG_FILE_EXISTS = "Output file already exists. Use rewrite=True to overwrite it."
# ---------------------------------------------------------------------------


def subject_codes(spark: SparkSession) -> DataFrame:
    """Subject -> two-digit code (15 rows, broadcast)."""
    return F.broadcast(spark.createDataFrame(SUBJECT_CODES, "subject string, code string"))


def languages(spark: SparkSession) -> DataFrame:
    """The two record languages with their output order."""
    return F.broadcast(spark.createDataFrame(
        [(lang, i) for i, lang in enumerate(LANGUAGES)], "language string, lang_order int"))


def section_letters(spark: SparkSession) -> DataFrame:
    """Cyrillic section letter -> Latin letter and section order."""
    return F.broadcast(spark.createDataFrame(
        [(c, lat, i) for i, (c, lat) in enumerate(SECTION_LATIN)],
        "section string, section_lat string, section_order int"))


def answer_translations(spark: SparkSession) -> DataFrame:
    """The Belarusian answer dictionary."""
    return F.broadcast(spark.createDataFrame(ANSWER_TRANSLATIONS, "language string, answer string, translated string"))


def letter_examples(spark: SparkSession) -> DataFrame:
    """The letter example appended to the system text, per language."""
    return F.broadcast(spark.createDataFrame(LETTER_EXAMPLES, "language string, letters string"))


def geo_2023_position_map(spark: SparkSession) -> DataFrame:
    """Image position -> question id for the geography 2023 exam."""
    rows = [("geo", "2023", i + 1, q) for i, q in enumerate(GEO_2023_IMAGE_QUESTIONS)]
    return F.broadcast(spark.createDataFrame(rows, "subject string, year string, position int, question_id string"))


def geo_2023_excluded_tables(spark: SparkSession) -> DataFrame:
    """Tables dropped for the geography 2023 exam."""
    return F.broadcast(spark.createDataFrame(
        [("geo", "2023", t) for t in GEO_2023_EXCLUDED_TABLES], "subject string, year string, table_no int"))


def geo_2023_text_fixes(spark: SparkSession) -> DataFrame:
    """Ordered text fixes for the geography 2023 exam."""
    return F.broadcast(spark.createDataFrame(
        [("geo", "2023", t, s, a, b) for t, s, a, b in GEO_2023_TEXT_FIXES],
        "subject string, year string, table_no int, seq int, `from` string, `to` string"))


def section_latin(section) -> F.Column:
    """P2 as an expression: Cyrillic section letter -> Latin, else unchanged."""
    m = F.create_map(*[x for pair in SECTION_LATIN for x in (F.lit(pair[0]), F.lit(pair[1]))])
    col = F.col(section) if isinstance(section, str) else section
    return F.coalesce(F.try_element_at(m, col), col)
