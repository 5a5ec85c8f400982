"""Tables: cells -> rows, Markdown and CSV text, corrections, placement.

A6, P14, P15, J5, J8, W6, K5, V4 of the survey.  Rows are kept as
``ARRAY<ARRAY<STRING>>`` (cells cleaned with F1); the CSV text is written and
read back by expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import clean_text, strip
from lectern.operators.placement import place_anchored

def table_rows(cells: DataFrame, clean: bool = True) -> DataFrame:
    """``(doc_id, table_no, row_no, col_no, text)`` -> ``(doc_id, table_no,
    rows)`` with rows and cells in order.  Rows are grouped first, so no
    single array holds more than one table."""
    cell = clean_text("text") if clean else F.col("text")
    rows = (cells.groupBy("doc_id", "table_no", "row_no")
            .agg(F.array_sort(F.collect_list(F.struct("col_no", cell.alias("t")))).alias("_c"))
            .select("doc_id", "table_no", "row_no", F.transform("_c", lambda c: c["t"]).alias("cells")))
    return (rows.groupBy("doc_id", "table_no")
            .agg(F.array_sort(F.collect_list(F.struct("row_no", "cells"))).alias("_r"))
            .select("doc_id", "table_no", F.transform("_r", lambda r: r["cells"]).alias("rows")))


def _line(cells: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |\n"))


def markdown(rows) -> Column:
    """Header row as is (newlines kept), a ``---`` rule, then body rows
    with cells stripped and newlines as ``<br>``."""
    rows = F.col(rows) if isinstance(rows, str) else rows
    header = F.element_at(rows, 1)
    rule = F.transform(header, lambda _: F.lit("---"))
    body = F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0)))
    body_text = F.array_join(F.transform(body, lambda r: _line(F.transform(
        r, lambda c: F.replace(strip(c), F.lit("\n"), F.lit("<br>"))))), "")
    return F.concat(_line(header), _line(rule), body_text)


def _csv_cell(c: Column) -> Column:
    needs = c.rlike("[,\"\r\n]")
    return F.when(needs, F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)


def csv_text(rows) -> Column:
    """K5: rows as CSV without header or index, ``\\n`` after every row.  A
    cell is quoted when it holds a comma, quote, CR or LF; a row that is a
    single empty cell is written ``""``."""
    rows = F.col(rows) if isinstance(rows, str) else rows

    def row(r):
        joined = F.array_join(F.transform(r, _csv_cell), ",")
        single_empty = (F.size(r) == 1) & (F.element_at(r, 1) == "")
        return F.concat(F.when(single_empty, F.lit('""')).otherwise(joined), F.lit("\n"))
    return F.array_join(F.transform(rows, row), "")


def anchors(rows) -> tuple[Column, Column]:
    """J5 anchors: the first cell of the first row, and the last line of the
    last cell of the last row."""
    rows = F.col(rows) if isinstance(rows, str) else rows
    first = F.element_at(F.element_at(rows, 1), 1)
    last = F.element_at(F.split(F.element_at(F.element_at(rows, -1), -1), "\n", -1), -1)
    return first, last


def apply_fixes(spark, tables: DataFrame, fixes: DataFrame, keys: list[str], col: str = "csv") -> DataFrame:
    """Literal replacements applied in ``seq`` order, each on the result of
    the one before.  ``fixes``: keys + seq, from, to.  The fixes are grouped
    per key first, so the join is one-to-one; whether it is broadcast is left
    to the planner's size check."""
    f = (fixes.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("seq", "from", "to"))).alias("_fx")))
    j = tables.join(f, keys, "left")
    fixed = F.aggregate(F.coalesce("_fx", F.array().cast("array<struct<seq:int,from:string,to:string>>")),
                        F.col(col), lambda acc, x: F.replace(acc, x["from"], x["to"]))
    return j.withColumn(col, fixed).drop("_fx")


_CSV_CELL = r'("(?:[^"]|"")*"|[^,\n"]*)(,|\n)'


def csv_rows(csv) -> Column:
    """The rows of a CSV text written by :func:`csv_text`: cells matched one
    after another with the comma or newline that ends each, then gathered."""
    csv = F.col(csv) if isinstance(csv, str) else csv
    cells = F.zip_with(F.regexp_extract_all(csv, F.lit(_CSV_CELL), 1), F.regexp_extract_all(csv, F.lit(_CSV_CELL), 2),
                       lambda c, e: F.struct(F.when(F.startswith(c, F.lit('"')), F.replace(
                           c.substr(F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c).alias("cell"), e.alias("end")))
    none = F.array().cast("array<string>")
    start = F.struct(F.array().cast("array<array<string>>").alias("rows"), none.alias("row"))

    def add(acc, x):
        row = F.array_append(acc["row"], x["cell"])
        ends = x["end"] == "\n"
        return F.struct(F.when(ends, F.array_append(acc["rows"], row)).otherwise(acc["rows"]).alias("rows"),
                        F.when(ends, none).otherwise(row).alias("row"))
    return F.aggregate(cells, start, add)["rows"]


def fix_tables(spark, tables: DataFrame, fixes: DataFrame, keys: list[str]) -> DataFrame:
    """J8 on tables kept as rows: the fixes work on a table's CSV text (so one
    can reach across cells), and the text becomes rows again.  Tables without
    fixes are not touched."""
    mine = tables.join(fixes.select(*keys).distinct(), keys, "left_semi").withColumn("csv", csv_text("rows"))
    fixed = apply_fixes(spark, mine, fixes, keys).withColumn("rows", csv_rows("csv")).select(*tables.columns)
    return tables.join(fixes.select(*keys).distinct(), keys, "left_anti").unionByName(fixed)


def drop_tables(tables: DataFrame, excluded: DataFrame, keys: list[str]) -> DataFrame:
    """Remove named tables (anti join with a small exclusion table)."""
    return tables.join(excluded, keys, "left_anti")


def place_tables(questions: DataFrame, tables: DataFrame) -> tuple[DataFrame, DataFrame]:
    """J5 + W6 + V4, per document.

    ``questions``: doc_id, section, pos, question_id, text, plus
    ``section_order``.  ``tables``: doc_id, table_no, rows.  Tables are taken in
    ``table_no`` order; each goes into the first question (section order, then
    position) whose text holds its first anchor followed by its second, and
    replaces every copy of that span by the Markdown table.  Later tables see
    the changed text.  Returns ``(questions, unplaced)``: the questions with
    their final text, and ``(doc_id, table_no)`` of tables that matched none.
    Both are read from tables written once; see :mod:`lectern.operators.placement`.
    """
    a, z = anchors("rows")
    return place_anchored(questions, tables.select("doc_id", "table_no", a.alias("a"), z.alias("z"), markdown("rows").alias("md")))
