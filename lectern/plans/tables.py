"""Access to the driver's parquet tables and the adaptations shared by the
registered queries and their oracle SQL.

The driver's tables hold no exams, so each query adapts one of them the same
way in Spark and in SQL: markers, bands and anchors become parameters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a driver table; the same plan at every size."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Fixed test parameters of the adaptations (ours, not the reference's).
# Ten separators put in place of ", " in documents, chosen by doc_id % 10.
SEPARATORS = [" ", "  ", "\n", "\n\n", " \n ", "\t", "\n  ", "\r\n", "\n2) ", " \n"]


def separator(key: Column) -> Column:
    """Spark form: the separator for ``key % 10``."""
    return F.element_at(F.array(*[F.lit(s) for s in SEPARATORS]), (key % 10 + 1).cast("int"))


def separator_sql(key: str) -> str:
    arms = " ".join(f"WHEN {i} THEN {_sql_str(s)}" for i, s in enumerate(SEPARATORS))
    return f"(CASE ({key}) % 10 {arms} END)"


def _sql_str(s: str) -> str:
    """A SQL expression for an arbitrary string (control characters as chr)."""
    out, buf = [], ""
    for ch in s:
        if ch.isprintable() and ch != "'":
            buf += ch
        else:
            if buf:
                out.append("'" + buf + "'")
                buf = ""
            out.append(f"chr({ord(ch)})")
    if buf:
        out.append("'" + buf + "'")
    return "(" + " || ".join(out or ["''"]) + ")"


sql_str = _sql_str

# Segmentation rules for `documents`: a header is a one-word line ending in a
# dot (the section is the word); an item starts with one of a few common
# words followed by a word, and its id is that word plus the next letter.
DOC_HEADER = r"^(\p{L}+)\.$"
DOC_ITEM = r"^((?:The|Der|Die|De|La|Le|El) \p{L})"
