"""Answers and comments from positioned text blocks.

Blocks are read per document in the order (page, y0 rounded half-to-even, x0,
block number).  A block in the question band that starts with an id and a dot
opens that question; an ``Ответ:`` in the question band sets its answer (the
last one wins); every block in the comment band appends to its comment.  The
current question carries across pages.

Input:  doc_id, page_no, block_no, x0, y0, text  (x1, y1 unused)
Output: doc_id, question_id, answer, comment
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import BLOCK_QID_PATTERN, answer_text, block_question_id, clean_text, strip
from lectern.operators.scan import CHUNK_ROWS, prefix_scan, row_chunks


@dataclass(frozen=True)
class Bands:
    """Open intervals of x0 for question blocks and comment blocks."""
    question: tuple[float, float] = (140.0, 142.0)
    comment: tuple[float, float] = (402.0, 440.0)


# The consult layout.  Question blocks have 140 < x0 < 142,
# comment blocks 402 < x0 < 440.
EXAM_BANDS = Bands()


def reading_order() -> F.Column:
    """O1: the sort key of a block within its document."""
    return F.struct(F.col("page_no").alias("p"), F.bround("y0", 0).alias("y"),
                    F.col("x0").alias("x"), F.col("block_no").alias("b"))


def attribute_blocks(blocks: DataFrame, bands: Bands = EXAM_BANDS,
                     qid_pattern: str = BLOCK_QID_PATTERN, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Answers and comments per (document, question).

    The forward fill of the current question runs through the chunked prefix
    scan with chunks of about ``chunk_rows`` blocks, so a document of very many
    pages, or a page (or one height of it) with very many blocks, is scanned by
    many tasks and sends one row a chunk to the carry step.
    """
    in_q = (F.col("x0") > bands.question[0]) & (F.col("x0") < bands.question[1])
    in_c = (F.col("x0") > bands.comment[0]) & (F.col("x0") < bands.comment[1])
    b = (blocks.where(in_q | in_c)                                   # P12
         .select("doc_id", "text", in_q.alias("in_q"), reading_order().alias("ord")))
    b = row_chunks(b, ["doc_id"], "ord", chunk_rows)
    b = b.withColumn("qid_here", F.when(F.col("in_q"), block_question_id("text", qid_pattern)))
    scanned = prefix_scan(b, ["doc_id"], "ord", "_chunk", last={"question_id": F.col("qid_here")})  # W4
    scanned = scanned.where(F.col("question_id").isNotNull())
    ans = F.when(F.col("in_q"), answer_text("text"))
    # Per scan chunk first (rows already sit by document and chunk), then per
    # question: a question with very many comment blocks is not assembled
    # block by block in one task.
    per_chunk = scanned.groupBy("doc_id", "question_id", "_chunk").agg(
        F.max(F.when(ans.isNotNull(), F.struct(F.col("ord").alias("o"), ans.alias("a")))).alias("_ans"),  # A4
        F.array_sort(F.collect_list(F.when(~F.col("in_q"), F.struct(
            F.col("ord").alias("o"), strip("text").alias("t"))))).alias("_com"))
    piece = F.when(F.size("_com") > 0, F.array_join(F.transform("_com", lambda c: c["t"]), " "))
    grouped = per_chunk.groupBy("doc_id", "question_id").agg(
        F.max("_ans").alias("_ans"),
        F.array_sort(F.collect_list(F.when(piece.isNotNull(), F.struct(
            F.col("_chunk").alias("k"), piece.alias("t"))))).alias("_com"))                           # A5
    comment = clean_text(strip(F.array_join(F.transform("_com", lambda c: c["t"]), " ")))
    return grouped.select("doc_id", "question_id",
                          F.coalesce(F.col("_ans.a"), F.lit("")).alias("answer"),
                          comment.alias("comment"))
