"""Table placement with an anchor index.

A table goes into the first question of its document that holds its first
anchor and, behind it, its last anchor; every copy of that span becomes the
table's Markdown.  Tables are taken in order and later ones see changed text, so
the result is that of a fold over the document's tables.  Testing each table
against each question would cost tables x text; here:

1. questions are dealt by (document, part), parts of bounded rows and
   characters, and meet the anchors of their document.  One Aho-Corasick pass
   over a question's text finds every anchor in it.  A question that no table
   fits never changes, so it is done; the others are candidates.
2. per document, the candidates' anchors are kept in postings (anchor -> ordered
   questions).  A table walks the shorter posting of its two anchors to its
   first fit; only the question that took it is scanned again.

Both steps read each text about once, plus once for each table it takes.  Step 2
is the only one that sees a document whole, and it sees its candidates only.

Both results, the placed questions and the unplaced tables, come from one
tagged table that is written once to the shared folder.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.session import materialize

PART_ROWS = 4_096            # questions of a document that meet its anchors in one task
PART_CHARS = 16_000_000
OUT_ROWS = 4_096             # rows of an Arrow batch that goes back to Spark
QUESTION = ["section_order", "pos", "section", "question_id", "text"]
_QUESTION_DDL = "doc_id {id}, section_order int, pos bigint, section string, question_id string, text string"


class AnchorIndex:
    """Anchors of a document's tables, found in a text by one pass."""

    def __init__(self, anchors: Iterable[str]):
        import ahocorasick

        known = {a for a in anchors if a}
        self.automaton = ahocorasick.Automaton() if known else None
        for a in known:
            self.automaton.add_word(a, a)
        if known:
            self.automaton.make_automaton()

    def scan(self, text: str | None) -> dict[str, tuple[int, int]]:
        """First and last start of every anchor that the text holds."""
        found: dict[str, tuple[int, int]] = {}
        if text and self.automaton is not None:
            for end, a in self.automaton.iter(text):
                start = end + 1 - len(a)
                found[a] = (found[a][0] if a in found else start, start)
        return found


def fits(found: dict[str, tuple[int, int]], a: str, z: str) -> bool:
    """Whether the anchors stand in this order in the scanned text (empty ones stand anywhere, both empty nowhere)."""
    if not a and not z or a and a not in found:
        return False
    behind = found[a][0] + len(a) if a else 0
    return not z or z in found and found[z][1] >= behind


def put(text: str, a: str, z: str, md: str | None) -> str | None:
    """The text with every copy of its first span from ``a`` to ``z`` replaced."""
    p = text.find(a)
    end = text.find(z, p + len(a)) + len(z)
    return None if md is None else text.replace(text[p:end], md)


def candidates(texts: list[str | None], pairs: Iterable[tuple[str, str]]) -> list[bool]:
    """Whether any table's anchors fit each text."""
    after: dict[str, set[str]] = {}
    for a, z in pairs:
        if a or z:
            after.setdefault(a, set()).add(z)
    index = AnchorIndex({x for a, zs in after.items() for x in (a, *zs)})

    def any_fit(text: str | None) -> bool:
        if text is None:
            return False
        found = index.scan(text)
        for a in [*found, ""]:
            zs = after.get(a)
            if zs and any(fits(found, a, z) for z in (zs if len(zs) <= len(found) + 1 else [z for z in [*found, ""] if z in zs])):
                return True
        return False
    return [any_fit(t) for t in texts]


def place(texts: list[str | None], tables: list[tuple[int, str | None, str | None, str | None]]) -> tuple[list[str | None], list[int]]:
    """(texts with the tables, numbers of the unplaced tables); both inputs in
    order, a table being (number, first anchor, last anchor, Markdown)."""
    texts = list(texts)
    index = AnchorIndex(x for _, a, z, _ in tables for x in (a, z) if x)
    found = [index.scan(t) for t in texts]
    postings: dict[str, list[int]] = {}
    for q, f in enumerate(found):
        for x in f:
            postings.setdefault(x, []).append(q)
    unplaced = []
    for number, a, z, md in tables:
        if a is None or z is None or not a and not z:
            unplaced.append(number)
            continue
        some = min((postings.get(x, []) for x in (a, z) if x), key=len)
        q = next((q for q in some if fits(found[q], a, z)), None)
        if q is None:
            unplaced.append(number)
            continue
        texts[q] = put(texts[q], a, z, md)
        old, found[q] = found[q], index.scan(texts[q])
        for x in old.keys() - found[q].keys():
            del postings[x][bisect_left(postings[x], q)]
        for x in found[q].keys() - old.keys():
            insort(postings.setdefault(x, []), q)
    return texts, unplaced


def each(lists: pa.ListArray, *names: str) -> Iterator[list[list]]:
    """The named fields of every list's structs; a NULL list has none."""
    cols, at = [c for n, c in zip([f.name for f in lists.type.value_type], lists.flatten().flatten()) if n in names], 0
    for n in pc.fill_null(pc.list_value_length(lists), 0).to_pylist():
        yield [c.slice(at, n).to_pylist() for c in cols]
        at += n


def in_slices(batch: pa.RecordBatch, rows: int = OUT_ROWS) -> Iterator[pa.RecordBatch]:
    """One batch for many documents, in slices that bound what Spark unpacks at a time."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def place_anchored(questions: DataFrame, tables: DataFrame, part_rows: int = PART_ROWS) -> tuple[DataFrame, DataFrame]:
    """(placed questions, unplaced tables).  ``questions``: doc_id,
    section_order, pos, section, question_id, text.  ``tables``: doc_id,
    table_no, a, z, md.  A NULL anchor or text fits nothing."""
    spark, id_type = questions.sparkSession, dict(questions.dtypes)["doc_id"]
    ddl = _QUESTION_DDL.format(id=id_type)
    q = questions.select("doc_id", F.col("section_order").cast("int").alias("section_order"),
                         F.col("pos").cast("bigint").alias("pos"), "section", "question_id", "text")
    t = tables.select(F.col("doc_id").cast(id_type).alias("doc_id"), F.col("table_no").cast("bigint").alias("table_no"), "a", "z", "md")
    t = materialize(spark, t, "table-anchors")

    # Parts of each document that has tables.
    by_doc = t.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("table_no", "a", "z", "md"))).alias("ts"))
    sizes = (q.join(t.select("doc_id").distinct(), "doc_id", "left_semi").groupBy("doc_id")
             .agg(F.greatest(F.ceil(F.count(F.lit(1)) / part_rows), F.ceil(F.sum(F.length("text")) / PART_CHARS), F.lit(1)).alias("_parts")))
    sizes = materialize(spark, sizes, "question-parts")
    q = q.join(sizes, "doc_id", "left").withColumn("_part", F.pmod(F.xxhash64("section", "question_id", "pos"), F.col("_parts")))
    parts = q.where("_parts IS NOT NULL").groupBy("doc_id", "_part").agg(F.collect_list(F.struct(*QUESTION)).alias("qs"))
    pairs = by_doc.select("doc_id", F.array_distinct(F.transform("ts", lambda x: F.struct(x["a"].alias("a"), x["z"].alias("z")))).alias("ts"))

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, qs, ts = (batch.column(c) for c in ("doc_id", "qs", "ts"))
            marks: list[bool] = []
            for (texts,), (a, z) in zip(each(qs, "text"), each(ts, "a", "z")):
                marks += candidates(texts, [x for x in zip(a, z) if None not in x])
            yield from in_slices(pa.RecordBatch.from_arrays(
                [docs.take(pc.list_parent_indices(qs)), *qs.flatten().flatten(), pa.array(marks, pa.bool_())],
                ["doc_id", *QUESTION, "candidate"]))
    flagged = parts.join(pairs, "doc_id").select("doc_id", "qs", "ts").mapInArrow(flag, ddl + ", candidate boolean")
    flagged = materialize(spark, flagged, "flagged-questions")

    # One row per candidate (kind q, its final text) or unplaced table (kind u).
    order = F.array_sort(F.collect_list(F.struct(*QUESTION)))
    cands = flagged.where("candidate").groupBy("doc_id").agg(order.alias("qs"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, qs, ts = (batch.column(c) for c in ("doc_id", "qs", "ts"))
            texts, unplaced, of = [], [], []
            for i, ((some,), tables) in enumerate(zip(each(qs, "text"), each(ts, "table_no", "a", "z", "md"))):
                some, left = place(some, list(zip(*tables)))
                texts += some
                unplaced += left
                of += [i] * len(left)
            rows, n, m = qs.flatten().flatten(), len(texts), len(unplaced)
            yield from in_slices(pa.RecordBatch.from_arrays(
                [docs.take(pc.list_parent_indices(qs)), *rows[:-1], pa.array(texts, pa.string()), pa.array(["q"] * n, pa.string()),
                 pa.nulls(n, pa.int64())], ["doc_id", *QUESTION, "kind", "table_no"]))
            yield from in_slices(pa.RecordBatch.from_arrays(
                [docs.take(pa.array(of, pa.int64())), *[pa.nulls(m, c.type) for c in rows], pa.array(["u"] * m, pa.string()),
                 pa.array(unplaced, pa.int64())], ["doc_id", *QUESTION, "kind", "table_no"]))
    tagged = by_doc.join(cands, "doc_id", "left").select("doc_id", "qs", "ts").mapInArrow(fold, ddl + ", kind string, table_no bigint")
    tagged = materialize(spark, tagged, "placed-tables")

    placed = (tagged.where("kind = 'q'").select("doc_id", *QUESTION)
              .unionByName(flagged.where("NOT candidate").select("doc_id", *QUESTION))
              .unionByName(q.where("_parts IS NULL").select("doc_id", *QUESTION)))
    return placed, tagged.where("kind = 'u'").select("doc_id", "table_no")
