"""Document segmentation: page text -> lines -> sections, items, section info.

S1, P13, W1-W3, A1-A3 of the survey.  The reference walks lines with a state
machine; here the state becomes two forward fills (current header run, current
segment) computed by :func:`lectern.operators.scan.prefix_scan`, followed by
grouping.

Output tables
  items:        doc_id, section, question_id, pos, text
  section_info: doc_id, section, general_info
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import clean_text, normalise_question, strip
from lectern.operators.scan import prefix_scan, row_chunks

LINE_CHUNK = 65536    # lines per scan chunk (a few MB of text): bounds the task size of one document
PAGE_CHUNK = 4096     # pages per scan chunk for the page-offset sum


@dataclass(frozen=True)
class SegmentRules:
    """What marks a section header and an item start.

    ``header``: a line matching it starts a header run; group 1 is the section.
    ``item``: a non-header line whose group 1 is non-empty starts an item with
    that id.  Patterns are Java regexes applied to the stripped line.
    """
    header: str
    item: str


# The exam profile.  A header line is "Часть А", "Часть В",
# "Частка А" or "Частка В" (Cyrillic letters); the section is the letter.  An
# item starts with a Cyrillic А or В followed by digits.
EXAM_RULES = SegmentRules(header=r"^(?:Часть|Частка) ([АВ])$", item=r"(?U)^([АВ]\d+)")


def page_lines(pages: DataFrame, doc_col: str = "doc_id", page_col: str = "page_no",
               text_col: str = "text", page_chunk: int = PAGE_CHUNK) -> DataFrame:
    """Pages -> ``(doc_id, line_no, line)`` as if all pages of a document
    were concatenated without separator and split on ``\\n``.

    Each page is split on its own; a page's line offset is the running count
    of newlines on the pages before it.  Only the first and last fragment of a
    page can continue across a page break, so only those are regrouped.
    """
    p = pages.select(F.col(doc_col).alias("doc_id"), F.col(page_col).alias("page_no"),
                     F.col(text_col).alias("text"))
    p = p.withColumn("_nl", F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))))
    p = prefix_scan(row_chunks(p, ["doc_id"], "page_no", page_chunk), ["doc_id"], "page_no", "_chunk",
                    sums={"_nl_upto": F.col("_nl")})
    frags = p.select(
        "doc_id", "page_no", "_nl",
        (F.col("_nl_upto") - F.col("_nl")).alias("_offset"),
        F.posexplode(F.split("text", "\n", -1)).alias("idx", "frag"))
    frags = frags.withColumn("line_no", (F.col("_offset") + F.col("idx")).cast("bigint"))
    edge = (F.col("idx") == 0) | (F.col("idx") == F.col("_nl"))
    inner = frags.where(~edge).select("doc_id", "line_no", F.col("frag").alias("line"))
    joined = (frags.where(edge)
              .groupBy("doc_id", "line_no")
              .agg(F.array_join(F.transform(
                  F.array_sort(F.collect_list(F.struct("page_no", "frag"))),
                  lambda x: x["frag"]), "").alias("line")))
    return inner.unionByName(joined)


def document_lines(docs: DataFrame, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Lines of single-text documents: ``(doc_id, line_no, line)``."""
    return (docs.select(F.col(doc_col).alias("doc_id"),
                        F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("line_no", "line"))
            .withColumn("line_no", F.col("line_no").cast("bigint")))


def classify_lines(lines: DataFrame, rules: SegmentRules, line_chunk: int = LINE_CHUNK) -> DataFrame:
    """Attach the current header run and the current segment to every
    line after the first header.

    Adds ``run_start`` (line of the header), ``section``, ``seg_start`` (line
    of the header or item start the line belongs to), ``seg_kind`` ('H' for
    section info, 'Q' for an item), ``question_id`` and ``chunk`` (the scan
    chunk, which :func:`segments` uses to assemble text in two steps).
    """
    ln = lines.withColumn("line", strip("line"))
    sec = F.regexp_extract("line", rules.header, 1)
    is_header = F.col("line").rlike(rules.header)
    qid = F.regexp_extract("line", rules.item, 1)
    ln = ln.select("doc_id", "line_no", "line",
                   is_header.alias("is_header"),
                   F.when(is_header, sec).alias("_hdr"),
                   F.when(~is_header & (qid != ""), qid).alias("_qid"),
                   F.floor(F.col("line_no") / line_chunk).alias("_chunk"))
    seg_mark = F.when(F.col("is_header"), F.struct(F.lit("H").alias("kind"), F.lit(None).cast("string").alias("qid"))) \
        .when(F.col("_qid").isNotNull(), F.struct(F.lit("Q").alias("kind"), F.col("_qid").alias("qid")))
    scanned = prefix_scan(
        ln, ["doc_id"], "line_no", "_chunk",
        last={"_run": F.when(F.col("is_header"), F.struct(F.col("line_no").alias("start"), F.col("_hdr").alias("section"))),
              "_seg": F.when(seg_mark.isNotNull(), F.struct(F.col("line_no").alias("start"), seg_mark.alias("m")))})
    return (scanned.where(F.col("_run").isNotNull())
            .select("doc_id", "line_no", "line", "is_header",
                    F.col("_run.start").alias("run_start"), F.col("_run.section").alias("section"),
                    F.col("_seg.start").alias("seg_start"), F.col("_seg.m.kind").alias("seg_kind"),
                    F.col("_seg.m.qid").alias("question_id"), F.col("_chunk").alias("chunk")))


def _ordered_text(only=None):
    """Lines of a group in order, each followed by a newline (rows where
    ``only`` is false are left out)."""
    part = F.struct(F.col("line_no").alias("n"), F.col("line").alias("t"))
    if only is not None:
        part = F.when(only, part)
    parts = F.array_sort(F.collect_list(part))
    return F.array_join(F.transform(parts, lambda x: F.concat(x["t"], F.lit("\n"))), "")


def segments(classified: DataFrame) -> DataFrame:
    """One row per segment: a header run's info block (kind 'H', its lines
    after the header) or an item instance (kind 'Q').  ``raw`` is the
    segment's lines, each followed by a newline.  Items and section info are
    both derived from this one grouping."""
    # Two steps: the lines of a segment inside one scan chunk are joined where
    # they already are (the rows are partitioned by document and chunk), then
    # the per-chunk pieces are joined; a segment spanning many chunks is not
    # assembled line by line in one task.
    pieces = (classified.groupBy("doc_id", "seg_start", "chunk")
              .agg(F.max("seg_kind").alias("seg_kind"), F.max("section").alias("section"),
                   F.max("question_id").alias("question_id"), F.max("run_start").alias("run_start"),
                   _ordered_text(~F.col("is_header")).alias("raw")))
    return (pieces.groupBy("doc_id", "seg_start")
            .agg(F.max("seg_kind").alias("seg_kind"), F.max("section").alias("section"),
                 F.max("question_id").alias("question_id"), F.max("run_start").alias("run_start"),
                 F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "raw"))),
                                          lambda x: x["raw"]), "").alias("raw")))


def items_of(segs: DataFrame, normalise: bool = True) -> DataFrame:
    """A1 + A3 from segments: one row per (doc_id, section, question_id).

    An id seen again in the same section keeps the text of its last instance
    and the position of its first; ``pos`` is the line number of the first
    instance.
    """
    won = (segs.where(F.col("seg_kind") == "Q")
           .groupBy("doc_id", "section", "question_id")
           .agg(F.max_by("raw", "seg_start").alias("raw"), F.min("seg_start").alias("pos")))
    text = normalise_question("raw") if normalise else F.col("raw")
    return won.select("doc_id", "section", "question_id", "pos", text.alias("text"))


def section_info_of(segs: DataFrame) -> DataFrame:
    """A2 from segments: section info folded over the header runs of a
    section, in order.  A run adds its info lines raw; when an item follows in
    that run, the whole text so far is cleaned (also when the run has no info
    lines)."""
    runs = (segs.groupBy("doc_id", "run_start")
            .agg(F.max("section").alias("section"),
                 F.max(F.when(F.col("seg_kind") == "H", F.col("raw"))).alias("raw"),
                 F.max((F.col("seg_kind") == "Q").cast("int")).alias("has_q")))
    folded = (runs.groupBy("doc_id", "section")
              .agg(F.array_sort(F.collect_list(F.struct(
                  "run_start", F.coalesce("raw", F.lit("")).alias("raw"), "has_q"))).alias("runs")))
    info = F.aggregate("runs", F.lit(""), lambda acc, r: F.when(
        r["has_q"] == 1, clean_text(F.concat(acc, r["raw"]))).otherwise(F.concat(acc, r["raw"])))
    return folded.select("doc_id", "section", info.alias("general_info"))


def items(classified: DataFrame, normalise: bool = True) -> DataFrame:
    """A1 + A3 from classified lines (see :func:`items_of`)."""
    return items_of(segments(classified), normalise)


def section_info(classified: DataFrame) -> DataFrame:
    """A2 from classified lines (see :func:`section_info_of`)."""
    return section_info_of(segments(classified))
