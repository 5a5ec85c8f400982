"""Sinks (K1-K5): records as JSON lines, images and their metadata.

Writes are partitioned and parallel.  A data set is a folder:

    data/<batch>.<attempt>/part-*    the part files of one attempt to append a batch
    _manifest/<batch>.json           one small file per batch: the attempt that counts

Appending stages an attempt's part files in a folder of their own and then
creates the batch's manifest file, by a rename that fails if it is there.
Readers (``readers.read_records``) take the attempts that the manifest names, so
a batch is seen whole or not at all, and a retried job adds nothing twice; what
a failed attempt left behind is never read.
"""

from __future__ import annotations

import json
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.dims import MSG_FILE_EXISTS

RECORD_COLUMNS = ["input", "target", "id", "metadata"]


def create_dataset(spark, path: str, rewrite: bool = False) -> str:
    """K2: start a data set folder.  Without ``rewrite`` an existing folder is
    an error; with it, the folder is emptied (an empty write in overwrite mode).
    """
    from lectern.schemas import RECORD
    empty = spark.createDataFrame([], RECORD)
    if rewrite:
        empty.write.mode("overwrite").json(path)
        return path
    try:
        empty.write.mode("errorifexists").json(path)
    except AnalysisException as e:
        if "PATH_ALREADY_EXISTS" in str(e):
            raise ValueError(MSG_FILE_EXISTS) from e
        raise
    return path


MANIFEST = "_manifest"


def _file_system(spark, path: str):
    """(Hadoop classes, the path's file system)."""
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs
    return fs, fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def committed(spark, path: str) -> dict[str, str]:
    """Batches of the data set with the folder of the attempt that counts."""
    fs, files = _file_system(spark, path)
    if not files.exists(fs.Path(f"{path}/{MANIFEST}")):
        return {}
    names = [f.getPath().toString() for f in files.listStatus(fs.Path(f"{path}/{MANIFEST}")) if f.getPath().getName().endswith(".json")]
    rows = [json.loads(r["value"]) for r in spark.read.text(names).collect()] if names else []
    return {r["batch"]: f"{path}/{r['folder']}" for r in rows}


def _commit(spark, path: str, batch: str, folder: str) -> bool:
    """Create the batch's manifest file; False if another attempt was first."""
    fs, files = _file_system(spark, path)
    staged, final = (fs.Path(f"{path}/{MANIFEST}/{n}") for n in (f".{uuid.uuid4().hex}", f"{batch}.json"))
    out = files.create(staged, False)
    out.write(bytearray(json.dumps({"batch": batch, "folder": folder}), "utf-8"))
    out.close()
    context = fs.FileContext.getFileContext(files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    no_overwrite = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    try:
        context.rename(files.makeQualified(staged), files.makeQualified(final), no_overwrite)
    except Py4JJavaError as e:
        files.delete(staged, False)
        if "FileAlreadyExistsException" in e.java_exception.toString():
            return False
        raise
    return True


def append_records(records: DataFrame, path: str, partition_by: tuple[str, ...] = (), batch_id: str | None = None) -> bool:
    """K1 + U1: append records as JSON lines (UTF-8, not escaped), all or none.

    ``batch_id`` names what is appended: a batch that is already in the data
    set is not added again (False is returned).  Without it every call is a
    batch of its own, and adding the same records twice stores them twice.
    With ``partition_by`` (e.g. ``("subject", "year")``, taken from the
    metadata) an attempt is laid out by those values, so readers can prune
    whole exams."""
    spark = records.sparkSession
    if batch_id is not None and not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", batch_id):
        raise ValueError(f"batch id {batch_id!r} must be made of letters, digits, dots, underscores and hyphens")
    batch = batch_id or uuid.uuid4().hex
    if batch_id is not None and batch in committed(spark, path):
        return False
    folder = f"data/{batch}.{uuid.uuid4().hex}"
    out = records.select(*RECORD_COLUMNS)
    if partition_by:
        out = out.select("*", *[F.col(f"metadata.{c}").alias(f"_{c}") for c in partition_by])
        out.write.mode("errorifexists").partitionBy(*[f"_{c}" for c in partition_by]).json(f"{path}/{folder}")
    else:
        out.write.mode("errorifexists").json(f"{path}/{folder}")
    return _commit(spark, path, batch, folder)


def _exam_partitions(images: DataFrame) -> list[str]:
    """Subject and year where the images carry them, else the document."""
    return ["subject", "year"] if {"subject", "year"} <= set(images.columns) else ["doc_id"]


def save_images(images: DataFrame, path: str, partition_by: tuple[str, ...] | None = None) -> None:
    """K3: image bytes with their names, as Parquet with a BINARY column.
    Saving an exam again replaces that exam's images and leaves all others."""
    by = list(partition_by or _exam_partitions(images))
    cols = list(dict.fromkeys(["doc_id", "filename", "format", "content", *by]))
    (images.select(*cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(path))


def save_image_info(images: DataFrame, path: str) -> None:
    """K4: image metadata (no bytes) as JSON lines; exams saved earlier stay."""
    by = _exam_partitions(images)
    cols = [c for c in ("doc_id", "filename", "image_url", "page_no", "format", "size", "nearby_text", "question_id")
            if c in images.columns]
    (images.select(*dict.fromkeys([*cols, *by])).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).json(path))
