"""SparkSession helpers.

``build_session`` is what tests, ``bench.py`` and the examples use.  On a real
cluster the session comes from the platform; the library itself never creates
one and only reads settings from the session it is handed.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for the plans in this package.  AQE coalesces the small
# shuffles of per-document aggregates and splits skewed join partitions;
# UTC keeps timestamps comparable with the DuckDB oracle.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "lectern", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session for local runs and tests."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    conf["spark.driver.memory"] = os.environ.get("LECTERN_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder named by the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    it is; a cluster session without it is an error (a machine-local folder
    would not survive the loss of that machine).  Only in local mode, when it
    is unset (local runs, tests), a fresh scratch folder is created and set.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (sessions without a SparkContext)
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            raise ValueError("spark.checkpoint.dir is not set; it must name a shared folder") from None
        return shared
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    current = sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir is not set; on a cluster it must name a shared folder")
        current = tempfile.mkdtemp(prefix="lectern-ckpt-")
        atexit.register(shutil.rmtree, current, ignore_errors=True)
    sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def shuffled(df):
    """``df`` for a join with another table that grows with the corpus: a
    sort-merge join at every size.  The planner would go by the size of
    compressed files, and a few MB of Parquet make hundreds of MB of hash table
    on the driver.  A broadcast hint on the other table still wins."""
    return df.hint("merge")


def materialize(spark: SparkSession, df, name: str):
    """Write ``df`` once as Parquet under the checkpoint folder and read it
    back: lineage is cut (a lost executor later does not rerun the plan) and,
    unlike ``checkpoint()``, the plan is computed only once."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lectern-{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
