"""Explicit schemas of the layout tables and the record.

JSON inference would sort struct fields and drop always-absent ones, so the
record schema is always given when reading records back.
"""

from pyspark.sql import types as T

EXAM_DOCS = T.StructType([
    T.StructField("doc_id", T.StringType()), T.StructField("subject", T.StringType()),
    T.StructField("code", T.StringType()), T.StructField("year", T.StringType()),
    T.StructField("language", T.StringType()), T.StructField("kind", T.StringType())])

PAGE_TEXT = T.StructType([
    T.StructField("doc_id", T.StringType()), T.StructField("page_no", T.IntegerType()),
    T.StructField("text", T.StringType())])

_BOX = [T.StructField(n, T.DoubleType()) for n in ("x0", "y0", "x1", "y1")]

BLOCKS = T.StructType([
    T.StructField("doc_id", T.StringType()), T.StructField("page_no", T.IntegerType()),
    T.StructField("block_no", T.IntegerType()), *_BOX, T.StructField("text", T.StringType())])

IMAGES = T.StructType([
    T.StructField("doc_id", T.StringType()), T.StructField("page_no", T.IntegerType()),
    T.StructField("img_no", T.IntegerType()), T.StructField("format", T.StringType()),
    T.StructField("content", T.BinaryType()), *_BOX])

TABLE_CELLS = T.StructType([
    T.StructField("doc_id", T.StringType()), T.StructField("table_no", T.IntegerType()),
    T.StructField("row_no", T.IntegerType()), T.StructField("col_no", T.IntegerType()),
    T.StructField("text", T.StringType())])

COMPLETIONS = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("model", T.StringType()),
    T.StructField("completion", T.StringType())])

CONTENT_PART = T.StructType([
    T.StructField("type", T.StringType()), T.StructField("text", T.StringType()),
    T.StructField("image", T.StringType())])

MESSAGE = T.StructType([
    T.StructField("role", T.StringType()), T.StructField("content", T.ArrayType(CONTENT_PART))])

METADATA = T.StructType([
    T.StructField("comments", T.StringType()), T.StructField("subject", T.StringType()),
    T.StructField("year", T.StringType()), T.StructField("language", T.StringType()),
    T.StructField("section", T.StringType()), T.StructField("points", T.IntegerType()),
    T.StructField("canary", T.StringType())])

RECORD = T.StructType([
    T.StructField("input", T.ArrayType(MESSAGE)), T.StructField("target", T.StringType()),
    T.StructField("id", T.StringType()), T.StructField("metadata", METADATA)])
