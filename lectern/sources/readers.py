"""Sources (S1-S7): layout tables, image files, records.

Every reader passes an explicit schema; nothing is inferred.  Parquet is the
default format of the layout tables: predicates and column pruning reach the
scan (``content`` bytes are read only by queries that ask for them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern import schemas
from lectern.operators.assets import edited_key
from lectern.operators.records import parse_document_path
from lectern.sources.sinks import committed


def read_table(spark: SparkSession, path: str, schema, fmt: str = "parquet") -> DataFrame:
    """Any layout table with an explicit schema (Parquet by default)."""
    return spark.read.schema(schema).format(fmt).load(path)


def read_page_text(spark, path, fmt="parquet"):        # S1 input
    """S1 input: doc_id, page_no, text."""
    return read_table(spark, path, schemas.PAGE_TEXT, fmt)


def read_blocks(spark, path, fmt="parquet"):           # S2
    """Positioned text blocks."""
    return read_table(spark, path, schemas.BLOCKS, fmt)


def read_images(spark, path, fmt="parquet"):           # S3
    """S3: embedded images with bytes and boxes."""
    return read_table(spark, path, schemas.IMAGES, fmt)


def read_table_cells(spark, path, fmt="parquet"):      # S4
    """Table cells."""
    return read_table(spark, path, schemas.TABLE_CELLS, fmt)


def read_image_files(spark: SparkSession, folder: str, edited_only: bool = False) -> DataFrame:
    """Image files named ``page{p}_img{i}.{ext}`` (or ``*_edit.*``) in
    per-document folders; returns doc folder, file name, numbers and bytes."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if edited_only:
        r = r.option("pathGlobFilter", "*_edit.*")
    df = r.load(folder)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    pat = r"^page(\d+)_img(\d+)(?:_edit)?\.([^.]+)$"
    return df.select(
        F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("doc_id"),
        (edited_key(F.col("path")) if edited_only else name).alias("filename"),
        F.regexp_extract(name, pat, 1).cast("int").alias("page_no"),
        F.regexp_extract(name, pat, 2).cast("int").alias("img_no"),
        F.regexp_extract(name, pat, 3).alias("format"),
        "content")


def exam_catalogue_from_paths(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """S6 inverse over a table of document paths."""
    return paths.select(path_col, parse_document_path(F.col(path_col)).alias("p")).select(path_col, "p.*")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines records with the fixed record schema: those of the
    committed batches, or of all files of a folder that has no manifest."""
    folders = sorted(committed(spark, path).values())
    return spark.read.schema(schemas.RECORD).json(folders or path)


def read_records_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S7 with quarantine: (records, rejects).  A line that is not JSON, does
    not fit the record schema or lacks the id, the input or the metadata is a
    reject: (file, raw, problem).  Nothing is dropped: every line that is not
    blank is in one of the two.  Both share one permissive read; the caller
    may persist it by writing either."""
    schema = T.StructType([*schemas.RECORD.fields, T.StructField("_raw", T.StringType())])
    folders = sorted(committed(spark, path).values())
    lines = (spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_raw").json(folders or path)
             .select("*", F.col("_metadata.file_name").alias("_file")))
    problem = (F.when(F.col("_raw").isNotNull(), "not a record")
               .when(F.col("id").isNull(), "no id").when(F.col("input").isNull(), "no input")
               .when(F.col("metadata").isNull(), "no metadata"))
    marked = lines.withColumn("_problem", problem)
    records = marked.where(F.col("_problem").isNull()).select(*[f.name for f in schemas.RECORD.fields])
    rejects = marked.where(F.col("_problem").isNotNull()).select(
        F.col("_file").alias("file"),
        F.coalesce("_raw", F.to_json(F.struct(*[f.name for f in schemas.RECORD.fields]))).alias("raw"), F.col("_problem").alias("problem"))
    return records, rejects


def read_completions(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Model completions for scoring: id, model, completion."""
    return read_table(spark, path, schemas.COMPLETIONS, fmt)
