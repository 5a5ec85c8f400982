"""Registered queries for the text operators and segmentation, with oracles.

Each ``q_*`` takes ``(spark, sf_dir)`` and returns a DataFrame; each
``sql_*`` returns DuckDB SQL over the driver's views with the same columns.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lectern.functions import text as T
from lectern.operators import segment as SEG
from lectern.plans import oracle_text as O
from lectern.plans.tables import DOC_HEADER, DOC_ITEM, separator, separator_sql, table

# ---------------------------------------------------------------- clean_text


def q_clean_text(spark: SparkSession, sf_dir: str):
    """F1 on documents whose ", " became one of ten whitespace separators and
    whose "è" became the Cyrillic "ѐ"."""
    d = table(spark, sf_dir, "documents")
    noisy = F.replace(F.replace("text", F.lit(", "), F.concat(F.lit(","), separator(F.col("doc_id")))),
                      F.lit("è"), F.lit("ѐ"))
    return d.select("doc_id", T.clean_text(noisy).alias("cleaned"))


def sql_clean_text() -> str:
    noisy = f"replace(replace(text, ', ', ',' || {separator_sql('doc_id')}), 'è', 'ѐ')"
    return f"SELECT doc_id, {O.clean_text(noisy)} AS cleaned FROM documents"


# ----------------------------------------------------------- strip_footnotes

def _footer_noisy():
    year = (F.lit(2000) + F.col("doc_id") % 30).cast("string")
    body = F.replace("text", F.lit(".\n"), F.concat(F.lit(". ДРТ–"), year, F.lit(" г.\n")))
    return F.concat(body, F.lit(" "), F.col("doc_id").cast("string"), F.lit(" \n"))


_FOOTER_NOISY_SQL = ("replace(text, '.' || chr(10), '. ДРТ–' || CAST(2000 + doc_id % 30 AS VARCHAR) || ' г.' || chr(10))"
                     " || ' ' || CAST(doc_id AS VARCHAR) || ' ' || chr(10)")


def q_strip_footnotes(spark: SparkSession, sf_dir: str):
    """F2 on documents with a footer after every line-ending dot and the doc id
    appended."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", T.strip_footnotes(_footer_noisy()).alias("stripped"))


def sql_strip_footnotes() -> str:
    return f"SELECT doc_id, {O.strip_footnotes(_FOOTER_NOISY_SQL)} AS stripped FROM documents"


# ----------------------------------------------------------- reorder_options

def _order_options(spark, sf_dir, noisy: bool):
    """Per order: "Order <key>:" and one option "<linenumber>) p<partkey>;" per
    line in part order, then " total <n> lines."  With ``noisy`` the options
    are separated by the ten separators, a footer follows the stem and a
    number is appended."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    piece = F.concat(F.col("l_linenumber").cast("string"), F.lit(") p"), F.col("l_partkey").cast("string"), F.lit(";"))
    g = li.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("l_partkey", "l_linenumber", piece.alias("p")))).alias("ps"),
        F.count("*").alias("n"))
    sep = separator(F.col("l_orderkey")) if noisy else F.lit(" ")
    opts = F.array_join(F.transform("ps", lambda x, i: F.when(i == 0, x["p"]).otherwise(
        F.concat(sep, x["p"]))), "")
    stem = F.concat(F.lit("Order "), F.col("l_orderkey").cast("string"), F.lit(":"))
    if noisy:
        stem = F.concat(stem, F.lit(" ДРТ–2023 г."))
    text = F.concat(stem, F.lit(" "), opts, F.lit(" total "), F.col("n").cast("string"), F.lit(" lines."))
    if noisy:
        text = F.concat(text, F.lit(" "), (F.col("l_orderkey") % 97).cast("string"), F.lit("\n"))
    return g.select("l_orderkey", text.alias("text"))


def _order_options_sql(noisy: bool) -> str:
    sep = separator_sql("l_orderkey") if noisy else "' '"
    stem = "'Order ' || CAST(l_orderkey AS VARCHAR) || ':'" + (" || ' ДРТ–2023 г.'" if noisy else "")
    tail = " || ' ' || CAST(l_orderkey % 97 AS VARCHAR) || chr(10)" if noisy else ""
    return ("SELECT l_orderkey, " + stem + " || ' ' || replace(string_agg(CAST(l_linenumber AS VARCHAR) || ') p' || "
            f"CAST(l_partkey AS VARCHAR) || ';', chr(1) ORDER BY l_partkey, l_linenumber), chr(1), {sep}) || ' total ' || "
            f"CAST(count(*) AS VARCHAR) || ' lines.'{tail} AS text FROM lineitem GROUP BY l_orderkey")


def q_reorder_options(spark: SparkSession, sf_dir: str):
    """F3/O2 on per-order option lists."""
    return _order_options(spark, sf_dir, False).select(
        "l_orderkey", T.reorder_options("text").alias("reordered"))


def sql_reorder_options() -> str:
    return f"SELECT l_orderkey, reordered FROM ({O.reorder_options(_order_options_sql(False), 'text', 'reordered')})"


def q_normalise_question(spark: SparkSession, sf_dir: str):
    """F4 (F2, then F1, then F3) on noisy per-order option lists."""
    return _order_options(spark, sf_dir, True).select(
        "l_orderkey", T.normalise_question("text").alias("normalised"))


def sql_normalise_question() -> str:
    src = (f"SELECT l_orderkey, {O.clean_text(O.strip_footnotes('text'))} AS t "
           f"FROM ({_order_options_sql(True)})")
    return f"SELECT l_orderkey, normalised FROM ({O.reorder_options(src, 't', 'normalised')})"


def q_long_option_numbers(spark: SparkSession, sf_dir: str):
    """O2 with option numbers of 20 and more digits, leading zeros and Arabic-Indic digits, per part."""
    key = F.col("p_partkey").cast("string")
    text = F.concat(F.col("p_name"), F.lit(": 1) a; 1"), F.lit("0" * 20), key, F.lit(") b; 000"), key, F.lit(") c; 2"),
                    F.repeat(F.lit("0"), (F.col("p_partkey") % 25).cast("int")), F.lit(") d; \u0663) e; and more"))
    return table(spark, sf_dir, "part").select("p_partkey", text.alias("text")).select(
        "p_partkey", T.reorder_options("text").alias("reordered"))


def sql_long_option_numbers() -> str:
    src = (f"SELECT p_partkey, p_name || ': 1) a; 1{'0' * 20}' || p_partkey || ') b; 000' || p_partkey || ') c; 2' || "
           "repeat('0', (p_partkey % 25)::INTEGER) || ') d; \u0663) e; and more' AS text FROM part")
    return f"SELECT p_partkey, reordered FROM ({O.reorder_options(src, 'text', 'reordered')})"


# ------------------------------------------------------------- segmentation

DOC_RULES = SEG.SegmentRules(header=DOC_HEADER, item=DOC_ITEM)


def _doc_classified(spark, sf_dir, line_chunk=SEG.LINE_CHUNK):
    d = table(spark, sf_dir, "documents")
    return SEG.classify_lines(SEG.document_lines(d), DOC_RULES, line_chunk=line_chunk)


def q_segment_lines(spark: SparkSession, sf_dir: str, line_chunk: int = SEG.LINE_CHUNK):
    """Every item of every document, normalised."""
    return SEG.items(_doc_classified(spark, sf_dir, line_chunk))


def q_section_info(spark: SparkSession, sf_dir: str, line_chunk: int = SEG.LINE_CHUNK):
    """A2: section info of every section of every document."""
    return SEG.section_info(_doc_classified(spark, sf_dir, line_chunk))


def lines_sql(source: str = "documents", header: str = DOC_HEADER, item: str = DOC_ITEM) -> str:
    """CTEs ``lines``, ``marked``, ``cls``: classified lines of ``source``
    (doc_id, text) with a whole-document window (the plain form)."""
    return f"""
lines AS (
  SELECT doc_id, line_no, line,
         regexp_full_match(line, {O.q(header)}) AS is_header,
         regexp_extract(line, {O.q(header)}, 1) AS hdr,
         regexp_extract(line, {O.q(item)}, 1) AS qid
  FROM (SELECT doc_id, generate_subscripts(parts, 1) - 1 AS line_no, {O.strip('unnest(parts)')} AS line
        FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM {source}))
),
marked AS (
  SELECT *,
         max(CASE WHEN is_header THEN line_no END) OVER w AS run_start,
         max(CASE WHEN is_header OR qid <> '' THEN line_no END) OVER w AS seg_start
  FROM lines
  WINDOW w AS (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
cls AS (
  SELECT m.doc_id, m.line_no, m.line, m.is_header, m.run_start, h.hdr AS section, m.seg_start,
         CASE WHEN s.is_header THEN 'H' ELSE 'Q' END AS seg_kind, s.qid AS question_id
  FROM marked m
  JOIN lines h ON h.doc_id = m.doc_id AND h.line_no = m.run_start
  JOIN lines s ON s.doc_id = m.doc_id AND s.line_no = m.seg_start
)"""


_LINES_SQL = lines_sql()


def sql_segment_lines(lines_cte: str | None = None) -> str:
    inst = """SELECT doc_id, seg_start, any_value(section) AS section, any_value(question_id) AS question_id,
                     string_agg(line || chr(10), '' ORDER BY line_no) AS raw
              FROM cls WHERE seg_kind = 'Q' AND NOT is_header GROUP BY doc_id, seg_start"""
    won = f"""SELECT doc_id, section, question_id, arg_max(raw, seg_start) AS raw, min(seg_start) AS pos
              FROM ({inst}) GROUP BY doc_id, section, question_id"""
    src = f"SELECT doc_id, section, question_id, pos, {O.clean_text(O.strip_footnotes('raw'))} AS t FROM ({won})"
    return (f"WITH {lines_cte or _LINES_SQL} SELECT doc_id, section, question_id, pos, text FROM "
            f"({O.reorder_options(src, 't', 'text')})")


def sql_section_info(lines_cte: str | None = None) -> str:
    runs = """SELECT h.doc_id, h.section, h.run_start,
                     coalesce(r.raw, '') AS raw, coalesce(r.has_q, false) AS has_q
              FROM (SELECT doc_id, section, run_start FROM cls WHERE is_header) h
              LEFT JOIN (SELECT doc_id, run_start,
                                coalesce(string_agg(CASE WHEN seg_kind = 'H' THEN line || chr(10) END, '' ORDER BY line_no), '') AS raw,
                                bool_or(seg_kind = 'Q') AS has_q
                         FROM cls WHERE NOT is_header GROUP BY doc_id, run_start) r
              USING (doc_id, run_start)"""
    step = O.clean_text("(acc || r.raw)")
    fold = (f"list_reduce(list(struct_pack(raw := raw, has_q := has_q) ORDER BY run_start), "
            f"lambda acc, r: CASE WHEN r.has_q THEN {step} ELSE acc || r.raw END, '')")
    return (f"WITH {lines_cte or _LINES_SQL} SELECT doc_id, section, {fold} AS general_info "
            f"FROM ({runs}) GROUP BY doc_id, section")


# --------------------------------------------------------------- page_lines
# S1 on real text: each document is cut into pages of 1,000 characters (so
# lines run across page breaks, and some pages hold no newline at all); the
# lines rebuilt from the pages must be the lines of the uncut text.

PAGE_CHARS = 1000


def q_page_lines(spark: SparkSession, sf_dir: str):
    d = table(spark, sf_dir, "documents")
    n_pages = F.greatest(F.ceil(F.length("text") / PAGE_CHARS), F.lit(1)).cast("int")
    pages = d.select("doc_id", F.posexplode(F.transform(
        F.sequence(F.lit(0), n_pages - 1),
        lambda i: F.substring("text", i * PAGE_CHARS + 1, PAGE_CHARS))).alias("i", "text")) \
        .select("doc_id", (F.col("i") + 1).alias("page_no"), "text")
    return SEG.page_lines(pages)


def sql_page_lines() -> str:
    return ("SELECT doc_id, CAST(generate_subscripts(parts, 1) - 1 AS BIGINT) AS line_no, unnest(parts) AS line "
            "FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)")
