"""Registered queries for block attribution and answer parsing, with oracles."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lectern.functions import text as T
from lectern.operators import blocks as BL
from lectern.plans import oracle_text as O
from lectern.plans.tables import table

# ---------------------------------------------------------- attribute_blocks
# events as consult blocks: user = document, day since 2024-01-01 = page,
# value = y0, event id = block number.  "signup" opens a question
# "А<n>." (n from the event id), "purchase" carries an answer, "error" is a
# comment; "view" sits on the question band's edge (x0 = 140) and "click" on
# the comment band's edge (x0 = 402), so both are outside the open bands.


def _event_blocks(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    et = F.col("event_type")
    x0 = (F.when(et.isin("signup", "purchase"), 141.0).when(et == "error", 410.0)
          .when(et == "view", 140.0).otherwise(402.0))
    text = (F.when(et == "signup", F.concat(F.lit("А"), (F.col("event_id") % 5 + 1).cast("string"),
                                            F.lit(". Вопрос "), F.col("props")))
            .when(et == "purchase", F.concat(F.lit("итог\nОтвет: "), et, F.lit(" "), F.col("props")))
            .otherwise(F.concat(F.col("props"), F.lit(" "))))
    return e.select(F.col("user_id").alias("doc_id"),
                    F.datediff(F.to_date("ts"), F.lit("2024-01-01")).alias("page_no"),
                    F.col("event_id").alias("block_no"), x0.alias("x0"),
                    F.col("value").alias("y0"), text.alias("text"))


def q_attribute_blocks(spark: SparkSession, sf_dir: str, chunk_rows: int = BL.CHUNK_ROWS):
    return BL.attribute_blocks(_event_blocks(spark, sf_dir), chunk_rows=chunk_rows)


def sql_attribute_blocks() -> str:
    S = O.S
    blocks = f"""
    SELECT user_id AS doc_id, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS page_no,
           event_id AS block_no, value AS y0,
           CASE WHEN event_type IN ('signup', 'purchase') THEN 141.0 WHEN event_type = 'error' THEN 410.0
                WHEN event_type = 'view' THEN 140.0 ELSE 402.0 END AS x0,
           CASE WHEN event_type = 'signup' THEN 'А' || CAST(event_id % 5 + 1 AS VARCHAR) || '. Вопрос ' || props
                WHEN event_type = 'purchase' THEN 'итог' || chr(10) || 'Ответ: ' || event_type || ' ' || props
                ELSE props || ' ' END AS text
    FROM events"""
    return attribution_sql(blocks)


def attribution_sql(blocks: str) -> str:
    """The plain whole-document form of block attribution over ``blocks``
    (doc_id, page_no, block_no, x0, y0, text)."""
    S = O.S
    band = f"""
    SELECT *, x0 > 140 AND x0 < 142 AS in_q,
           CASE WHEN x0 > 140 AND x0 < 142 THEN nullif(regexp_extract(text, {O.q('^([АВ]' + O.D + r'+)\.')}, 1), '') END AS qid_here,
           CASE WHEN x0 > 140 AND x0 < 142 AND regexp_matches(text, {O.q('Ответ:' + S + '*.')})
                THEN regexp_extract(text, {O.q('Ответ:' + S + '*(.+)')}, 1) END AS ans_raw
    FROM ({blocks}) WHERE (x0 > 140 AND x0 < 142) OR (x0 > 402 AND x0 < 440)"""
    scan = f"""
    SELECT *, last_value(qid_here IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY page_no, round_even(y0, 0), x0, block_no
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS question_id,
           row_number() OVER (PARTITION BY doc_id ORDER BY page_no, round_even(y0, 0), x0, block_no) AS rn
    FROM ({band})"""
    answer = O.clean_text(O.strip(O.upper(O.strip('ans_raw'))))
    comment = O.clean_text(O.strip("coalesce(string_agg(CASE WHEN NOT in_q THEN " + O.strip("text")
                                   + " END, ' ' ORDER BY rn), '')"))
    return f"""
    SELECT doc_id, question_id, coalesce(arg_max({answer}, rn) FILTER (WHERE ans_raw IS NOT NULL), '') AS answer,
           {comment} AS comment
    FROM ({scan}) WHERE question_id IS NOT NULL GROUP BY doc_id, question_id"""


# -------------------------------------------------------------- answer_parse
# benchmark items as question blocks: "<letter><item_id>. <text> Ответ: <text>"
# with a Cyrillic А, Cyrillic В or Latin A by item_id % 3; x0 = 140 + item_id % 3.


def q_answer_parse(spark: SparkSession, sf_dir: str):
    b = table(spark, sf_dir, "benchmark")
    letter = F.element_at(F.array(F.lit("А"), F.lit("В"), F.lit("A")), (F.col("item_id") % 3 + 1).cast("int"))
    text = F.concat(letter, F.col("item_id").cast("string"), F.lit(". "), F.col("text"),
                    F.lit(" Ответ: "), F.col("text"))
    x0 = F.lit(140) + F.col("item_id") % 3
    bands = BL.EXAM_BANDS
    in_band = (x0 > bands.question[0]) & (x0 < bands.question[1])
    return b.select("item_id", in_band.alias("in_band"),
                    T.block_question_id(text).alias("question_id"),
                    T.answer_text(text).alias("answer"))


def sql_answer_parse() -> str:
    text = ("(CASE item_id % 3 WHEN 0 THEN 'А' WHEN 1 THEN 'В' ELSE 'A' END || CAST(item_id AS VARCHAR) || '. ' "
            "|| text || ' Ответ: ' || text)")
    raw = f"regexp_extract({text}, {O.q('Ответ:' + O.S + '*(.+)')}, 1)"
    answer = O.clean_text(O.strip(O.upper(O.strip(raw))))
    return f"""
    SELECT item_id, (140 + item_id % 3) > 140 AND (140 + item_id % 3) < 142 AS in_band,
           nullif(regexp_extract({text}, {O.q('^([АВ]' + O.D + r'+)\.')}, 1), '') AS question_id,
           CASE WHEN regexp_matches({text}, {O.q('Ответ:' + O.S + '*.')}) THEN {answer} END AS answer
    FROM benchmark"""
