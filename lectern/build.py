"""End to end: layout tables of many exams -> chat-style records.

The Spark form of "add a subject in both languages": one plan over every exam
in the catalogue instead of a loop.  Per-exam special cases (which image goes
to which question, dropped tables, text fixes) are *data*: small tables keyed
by (subject, year), joined where they apply.

Steps: segment the test documents (S1, W1-W3, A1-A3) -> place their tables
(A6, J8, P14, J5) -> answers from the consult documents' blocks (O1, W4, A4,
A5) -> images of the Russian test document, numbered, assigned and replaced
(W5, J3, J6, J9, P16-P18) -> records (J1, J2, P1-P9).  Problems go to a report
instead of stopping the job (V1-V6).
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern import dims
from lectern.operators import assets as AS
from lectern.operators import blocks as BL
from lectern.operators import records as R
from lectern.operators import segment as SEG
from lectern.operators import tables as TB
from lectern.session import materialize as write_table, shuffled


@dataclass
class ExamInputs:
    """``exam_docs``: doc_id, subject, year, language (NULL for consult), kind
    ('test' | 'consult').  ``page_text``: doc_id, page_no, text.  ``blocks``:
    doc_id, page_no, block_no, x0, y0, x1, y1, text.  ``images``: doc_id,
    page_no, img_no, format, content, x0, y0, x1, y1.  ``table_cells``:
    doc_id, table_no, row_no, col_no, text.  ``edited_images``: doc_id,
    filename, content."""
    exam_docs: DataFrame
    page_text: DataFrame
    blocks: DataFrame
    images: DataFrame | None = None
    table_cells: DataFrame | None = None
    edited_images: DataFrame | None = None


@dataclass
class Profiles:
    """Per-exam data: ``position_map`` (subject, year, position, question_id),
    ``excluded_tables`` (subject, year, table_no), ``text_fixes`` (subject,
    year, table_no, seq, from, to)."""
    position_map: DataFrame | None = None
    excluded_tables: DataFrame | None = None
    text_fixes: DataFrame | None = None

    @classmethod
    def reference(cls, spark: SparkSession) -> "Profiles":
        """The one exam profile the source defines (geography 2023)."""
        return cls(dims.geo_2023_position_map(spark), dims.geo_2023_excluded_tables(spark),
                   dims.geo_2023_text_fixes(spark))


@dataclass
class BuildResult:
    records: DataFrame        # input, target, id, metadata + ordering columns
    problems: DataFrame       # doc_id, question_id, problem
    unplaced_tables: DataFrame  # doc_id, table_no
    images: DataFrame | None  # image info: subject, year, filename, question_id, image_url, size, nearby_text


def build_records(spark: SparkSession, inputs: ExamInputs, canary: str, profiles: Profiles | None = None,
                  rules: SEG.SegmentRules = SEG.EXAM_RULES, bands: BL.Bands = BL.EXAM_BANDS,
                  materialize: bool = True) -> BuildResult:
    """Build records for every exam in ``inputs.exam_docs``.

    With ``materialize`` the tables that several steps or outputs read (documents,
    lines, segments, placed questions, blocks, answers, image metadata in three
    steps, so that no stage holds many sorts; no bytes) are written once as
    Parquet to the session's checkpoint folder and read back: nothing is run
    once per output, and a lost executor later in the job does not send Spark
    back to the page text.
    """
    profiles = profiles or Profiles()
    docs = inputs.exam_docs
    # A document listed n times is processed once; its records are repeated n times at the end.
    tests = (docs.where(F.col("kind") == "test").groupBy("doc_id", "subject", "year", "language")
             .agg(F.count(F.lit(1)).cast("int").alias("times")))
    consults = docs.where(F.col("kind") == "consult").select("doc_id", "subject", "year").distinct()
    if materialize:
        tests, consults = write_table(spark, tests, "tests"), write_table(spark, consults, "consults")

    # Questions and section info of every test document.
    pages = shuffled(inputs.page_text).join(tests.select("doc_id"), "doc_id", "left_semi")
    lines = SEG.page_lines(pages)
    if materialize:
        lines = write_table(spark, lines, "page-lines")
    segs = SEG.segments(SEG.classify_lines(lines, rules))
    if materialize:
        segs = write_table(spark, segs, "segments")
    questions = SEG.items_of(segs)
    info = SEG.section_info_of(segs)

    # Tables placed into questions (per test document, in table order).
    unplaced = None
    if inputs.table_cells is not None:
        tabs = TB.table_rows(inputs.table_cells.join(tests.select("doc_id"), "doc_id", "left_semi"))
        tabs = tabs.join(tests.select("doc_id", "subject", "year"), "doc_id")
        if profiles.excluded_tables is not None:
            tabs = TB.drop_tables(tabs, profiles.excluded_tables, ["subject", "year", "table_no"])
        if profiles.text_fixes is not None:
            tabs = TB.fix_tables(spark, tabs, profiles.text_fixes, ["subject", "year", "table_no"])
        qs = questions.join(dims.section_letters(spark).select("section", "section_order"), "section", "left") \
            .withColumn("section_order", F.coalesce("section_order", F.lit(99))) \
            .withColumn("pos", F.col("pos").cast("bigint"))
        placed, unplaced = TB.place_tables(qs, tabs.select("doc_id", "table_no", "rows"))
        questions = placed.select("doc_id", "section", "question_id", "pos", "text")
    if materialize:
        questions = write_table(spark, questions, "questions")

    # Answers: one consult document per (subject, year), shared by both languages.
    blocks = shuffled(inputs.blocks).join(consults.select("doc_id"), "doc_id", "left_semi")
    if materialize:
        blocks = write_table(spark, blocks, "consult-blocks")
    attributed = BL.attribute_blocks(blocks, bands)
    answers = shuffled(attributed).join(consults, "doc_id").select("subject", "year", "question_id", "answer", "comment")
    if materialize:
        answers = write_table(spark, answers, "answers")

    # Images of the Russian test document: numbered, placed near text and
    # assigned on metadata only; then the bytes are joined, edited copies in
    # place of the originals they replace, and each URI is built once.
    image_info = None
    if inputs.images is not None:
        rus = tests.where(F.col("language") == "rus").select("doc_id", "subject", "year").distinct()
        meta = shuffled(inputs.images.drop("content")).join(rus, "doc_id").withColumn(
            "filename", AS.image_file_name("page_no", "img_no", "format"))
        if materialize:
            meta = write_table(spark, meta, "image-catalogue")
        spans = inputs.blocks.select("doc_id", "page_no", F.col("block_no").alias("span_id"),
                                     "x0", "y0", "x1", "y1", "text")
        near = AS.nearby_text(meta.select("doc_id", "page_no", F.col("img_no").alias("img_id"),
                                          "x0", "y0", "x1", "y1"), spans)
        if materialize:
            near = write_table(spark, near, "image-near-text")
        meta = shuffled(meta).join(near.withColumnRenamed("img_id", "img_no"), ["doc_id", "page_no", "img_no"], "left")
        if profiles.position_map is not None:
            meta = AS.assign_by_position(meta, profiles.position_map, ["subject", "year"])
        else:
            meta = meta.withColumn("question_id", F.lit(None).cast("string"))
        if materialize:
            meta = write_table(spark, meta, "image-metadata")
        image_info = AS.attach_uris(meta, inputs.images, edited=inputs.edited_images).select(
            "doc_id", "subject", "year", "page_no", "img_no", "filename", "format",
            "question_id", "image_url", "size", "nearby_text")

    records = R.assemble_records(
        spark, tests, questions, info, answers,
        image_info.where(F.col("question_id").isNotNull()) if image_info is not None else None, canary)
    problems = R.validation_report(tests.drop("times"), questions, answers, meta if image_info is not None else None)
    none = F.lit(None).cast("string").alias("question_id")
    problems = problems.unionByName(R.catalogue_rejects(spark, tests.select("doc_id", "subject", "language", "year"))
                                    .select("doc_id", none, F.col("error").alias("problem")))          # V1, V5
    if image_info is not None:
        problems = problems.unionByName(meta.where(F.col("question_id").isNull()).select(
            "doc_id", F.col("filename").alias("question_id"), F.lit("image without question").alias("problem")))
        sources = inputs.images.select("doc_id").distinct().where(
            F.col("doc_id").endswith(".pdf") & ~AS.image_source_ok(F.col("doc_id")))
        problems = problems.unionByName(sources.select("doc_id", none, F.lit("unsupported image source").alias("problem")))  # V6
    if unplaced is None:
        unplaced = spark.createDataFrame([], "doc_id string, table_no bigint")
    return BuildResult(records, problems, unplaced, image_info)


def write_records(spark: SparkSession, result: BuildResult, path: str, rewrite: bool = False,
                  append: bool = False, batch_id: str | None = None) -> bool:
    """K2 + K1: start (or, with ``append``, extend) a data set folder and write
    the records as JSON lines in the reference order (language, section,
    question position).  With a ``batch_id`` a repeated call adds nothing
    (False is returned)."""
    from lectern.sources import sinks
    if not append:
        sinks.create_dataset(spark, path, rewrite=rewrite)
    elif batch_id is not None and batch_id in sinks.committed(spark, path):
        return False
    # written once: the sort looks at its rows twice
    result = replace(result, records=write_table(spark, result.records, "records"))
    return sinks.append_records(R.sample_columns(R.in_reference_order(result.records)), path, batch_id=batch_id)
