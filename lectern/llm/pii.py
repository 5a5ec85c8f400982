"""Personal data by rules and a semi-Markov conditional random field (operator 7).

Rules (``base_spans``) find emails, IP addresses, payment cards and phone
numbers, leftmost and non-overlapping per kind; a match that fails its test is
dropped and not retried.  That loses numbers that touch each other, as in
``+1 (269) 555-3296 4524132264652876``.  The model adds what was lost:

* an *island* is a maximal run of digits and the characters that join digit
  groups; its *atoms* are the digit groups;
* a candidate segment is up to ``MAX_ATOMS`` neighbouring atoms that pass the
  test of a kind; features describe the whole span (group lengths, separators,
  leading plus sign, what stands around it), so they can see what per-character
  labels cannot;
* an island is scored by the sum of its segments' scores, atoms outside segments
  scoring 0; bounded-length dynamic programming finds the best segmentation,
  boundaries and kinds at once.

Weights are trained on a hash sample of about ``SAMPLE_DOCS`` documents: islands
that the rules explain wholly (every digit group of six or more digits in a
rule's span; at most ``TRAIN_ISLANDS`` distinct ones, chosen by hash, of at most
``TRAIN_ATOMS`` groups) are the gold segmentations, and the log-likelihood (segment-level
forward-backward) is maximised around prior weights.  Base spans always stay;
a found segment is added when it overlaps none of them.  Email addresses
written with "(at)" and "(dot)" are candidates of a one-atom island.

Offsets are code points, end exclusive.  Edge cases: NULL and empty texts have
no spans; repeated rows get the same spans; an empty table trains nothing and
keeps the prior weights; input columns beside the two named are ignored; long
digit runs and long islands cost time linear in their length.
"""

from __future__ import annotations

import math
import pickle
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import slices, unit_hash

KINDS = ("email", "ip", "card", "phone")
MAX_ATOMS = 8
SAMPLE_DOCS = 4_000
TRAIN_ISLANDS, TRAIN_ATOMS = 20_000, 64     # distinct islands of the sample that are fitted on, and their length
STEPS, RATE, PRIOR_STRENGTH = 25, 0.3, 1.0

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# An address starts at a digit that no digit precedes: a run is matched from its start or not at all.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ISLAND = re.compile(r"[+(]{0,2}[0-9](?:[\x20().+-]{0,3}[0-9])*+")
_GROUP = re.compile(r"[0-9]+")
_SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]+(?:(?:\.| ?[\[(](?:dot|DOT)[\])] ?)[A-Za-z0-9-]+)+")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def is_ip(s: str) -> bool:
    parts = s.split(".")
    return len(parts) == 4 and all(p and len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def is_card(s: str) -> bool:
    d = _digits(s)
    return 16 <= len(d) <= 19 and luhn(d)


def is_phone(s: str) -> bool:
    return 8 <= len(_digits(s)) <= 15


def base_emails(text: str) -> Iterator[Span]:
    """Matches of the email rule, found from each "@" outwards: the local part
    is the run before it (not reaching into the match before)."""
    end = 0
    at = text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at)
        start = at
        while m and start > end and text[start - 1] in LOCAL:
            start -= 1
        if m and start < at:
            yield "email", start, m.end()
            end = m.end()
        elif m is None:
            end = max(end, at + 1)
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[Span]:
    """Spans of the four rules, by kind, then start."""
    out = list(base_emails(text)) if "@" in text else []
    for kind, pattern, test in (("ip", _IP, is_ip), ("card", _CARD, is_card), ("phone", _PHONE, is_phone)):
        out += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if test(m.group())]
    return out


# --- the model ---------------------------------------------------------------------------------

# Prior weights per (kind, feature); training moves them as far as the sample supports.
PRIOR = {
    ("ip", "bias"): 2.0, ("card", "bias"): 2.0, ("phone", "bias"): -1.0, ("email", "bias"): 3.0,
    ("phone", "plus"): 4.0, ("phone", "parens"): 2.0, ("phone", "ends 3-4"): 2.5, ("phone", "one group"): -4.0,
    ("phone", "date"): -6.0, ("phone", "dots only"): -2.0, ("phone", "card tail"): -3.0,
    ("card", "one group"): 1.0, ("card", "fours"): 2.0, ("card", "mixed groups"): -4.0,
    ("ip", "chained"): -6.0, ("card", "chained"): -2.0, ("phone", "chained"): -2.0,
    ("ip", "in word"): -2.0, ("card", "in word"): -3.0, ("phone", "in word"): -3.0,
}


def features(kind: str, text: str, start: int, end: int, groups: list[tuple[int, int]]) -> list[tuple[str, str]]:
    """Names of the whole-span features that hold for text[start:end] as ``kind``."""
    out = ["bias"]
    before, after = text[start - 1:start], text[end:end + 1]
    if before.isalnum() or after.isalpha() or before == "_" or after == "_":
        out.append("in word")
    if kind == "email":
        return [(kind, f) for f in out]
    span, sizes = text[start:end], [b - a for a, b in groups]
    if (before in ("-", ".") and text[start - 2:start - 1].isdigit()) or (after in ("-", ".") and text[end + 1:end + 2].isdigit()):
        out.append("chained")
    if len(sizes) == 1:
        out.append("one group")
    if kind == "phone":
        out += [f for f, holds in (
            ("plus", span[0] == "+"), ("parens", "(" in span and ")" in span), ("ends 3-4", sizes[-2:] == [3, 4]),
            ("date", sizes in ([4, 2, 2], [2, 2, 4], [4, 2, 2, 2], [4, 2, 2, 2, 2])),
            ("dots only", "." in span and not set(span) & set(" -()+")),
            ("card tail", sizes[-1] > 7)) if holds]
    if kind == "card":
        out.append("fours" if sizes[:-1] == [4] * (len(sizes) - 1) and len(sizes) > 1 else
                   "mixed groups" if len(sizes) > 1 else "solid")
    return [(kind, f) for f in out]


class Taken:
    """The stretches that some spans cover, asked for overlaps by bisection."""

    def __init__(self, spans: Iterable[Span]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for s, e in sorted((s, e) for _, s, e in spans):
            if self.ends and s < self.ends[-1]:
                self.ends[-1] = max(e, self.ends[-1])
            else:
                self.starts.append(s)
                self.ends.append(e)

    def overlap(self, start: int, end: int) -> bool:
        k = bisect_left(self.starts, end)
        return k > 0 and self.ends[k - 1] > start


_FREE = Taken([])


def candidates(text: str, start: int, end: int, taken: Taken = _FREE) -> tuple[list[tuple[int, int]], list[tuple]]:
    """Atoms (digit groups) of the island text[start:end] and its candidate
    segments (first atom, after last atom, kind, span start, span end, features)."""
    atoms = [(m.start(), m.end()) for m in _GROUP.finditer(text, start, end)]
    out = []
    for i, (a, _) in enumerate(atoms):
        digits = 0
        for j in range(i, min(len(atoms), i + MAX_ATOMS)):
            b = atoms[j][1]
            digits += b - atoms[j][0]
            if digits > 19:
                break
            if digits < 4 or taken.starts and taken.overlap(a, b):
                continue
            s, groups = a, atoms[i:j + 1]
            kinds = []
            if j - i == 3 and is_ip(text[a:b]):
                kinds.append("ip")
            if digits >= 16 and re.fullmatch(r"[0-9](?:[\x20-]?[0-9])+", text[a:b]) and luhn(_digits(text[a:b])):
                kinds.append("card")
            if 8 <= digits <= 15 and not re.search(r"\+|[^0-9]{4}", text[a + 1:b]):
                while s > start and text[s - 1] in "+(" and a - s < 2:
                    s -= 1
                kinds.append("phone")
            out += [(i, j + 1, k, s if k == "phone" else a, b, features(k, text, s if k == "phone" else a, b, groups)) for k in kinds]
    return atoms, out


def score(weights: dict, names: list) -> float:
    return sum(weights.get(n, 0.0) for n in names)


def best_segments(weights: dict, n_atoms: int, cands: list[tuple]) -> list[tuple]:
    """The segmentation of highest total score (ties: fewer, then earlier segments)."""
    by_end: dict[int, list] = {}
    for c in cands:
        by_end.setdefault(c[1], []).append(c)
    best, back = [0.0] * (n_atoms + 1), [None] * (n_atoms + 1)
    for j in range(1, n_atoms + 1):
        best[j] = best[j - 1]
        for c in by_end.get(j, ()):
            value = best[c[0]] + score(weights, c[5])
            if value > best[j] + 1e-12:
                best[j], back[j] = value, c
    out, j = [], n_atoms
    while j > 0:
        if back[j] is None:
            j -= 1
        else:
            out.append(back[j])
            j = back[j][0]
    return out[::-1]


def found_spans(weights: dict, text: str, base: list[Span]) -> list[Span]:
    """Spans the model adds to the base spans of the text."""
    out = []
    fixed = Taken(base)
    for m in _ISLAND.finditer(text):
        if m.end() - m.start() < 8:
            continue
        atoms, cands = candidates(text, m.start(), m.end(), fixed)
        out += [(c[2], c[3], c[4]) for c in best_segments(weights, len(atoms), cands)] if cands else []
    if "(at)" in text or "[at]" in text or "(AT)" in text or "[AT]" in text:
        out += [("email", m.start(), m.end()) for m in _SPELLED.finditer(text)
                if score(weights, features("email", text, m.start(), m.end(), [])) > 0]
    return [(k, s, e) for k, s, e in out if not fixed.overlap(s, e)]


def all_spans(weights: dict, text: str) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each by kind, then start."""
    base = base_spans(text)
    return base, sorted([*base, *found_spans(weights, text, base)], key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def gold_islands(text: str) -> list[tuple[int, list[tuple], list[tuple]]]:
    """(atoms, candidates, gold candidates) of the islands that the rules
    explain wholly, those of at most ``TRAIN_ATOMS`` atoms."""
    base, out = sorted(base_spans(text), key=lambda x: x[1]), []
    near: list[Span] = []  # spans that reach into the island or beyond; swept along
    at = 0
    for m in _ISLAND.finditer(text):
        while at < len(base) and base[at][1] < m.end():
            near.append(base[at])
            at += 1
        near = [x for x in near if x[2] > m.start()]
        if m.end() - m.start() < 8:
            continue
        inside, taken = set(near), Taken(near)
        atoms = sum(1 for _ in _GROUP.finditer(text, m.start(), m.end()))
        if atoms > TRAIN_ATOMS:
            continue
        groups, cands = candidates(text, m.start(), m.end())
        gold = [c for c in cands if (c[2], c[3], c[4]) in inside]
        loose = [1 for a, b in groups if b - a >= 6 and not taken.overlap(a, b)]
        if cands and not loose and len(gold) == len(inside):
            out.append((len(groups), [c[:3] + (0, 0, c[5]) for c in cands], [c[:3] + (0, 0, c[5]) for c in gold]))
    return out


def _expected(weights: dict, n: int, cands: list[tuple]) -> dict:
    """Expected feature counts of an island under the model (forward-backward over segments)."""
    s = [score(weights, c[5]) for c in cands]
    by_start: list[list[int]] = [[] for _ in range(n + 1)]
    by_end: list[list[int]] = [[] for _ in range(n + 1)]
    for k, c in enumerate(cands):
        by_start[c[0]].append(k)
        by_end[c[1]].append(k)
    add = lambda xs: (m := max(xs)) + math.log(sum(math.exp(x - m) for x in xs))
    f, b = [0.0] * (n + 1), [0.0] * (n + 1)
    for j in range(1, n + 1):
        f[j] = add([f[j - 1], *(f[cands[k][0]] + s[k] for k in by_end[j])])
    for i in range(n - 1, -1, -1):
        b[i] = add([b[i + 1], *(b[cands[k][1]] + s[k] for k in by_start[i])])
    out: dict = {}
    for k, c in enumerate(cands):
        p = math.exp(f[c[0]] + s[k] + b[c[1]] - f[n])
        for name in c[5]:
            out[name] = out.get(name, 0.0) + p
    return out


def fit(islands: list[tuple], times: list[int] | None = None) -> dict:
    """Weights that maximise the mean log-likelihood of the gold segmentations,
    with a Gaussian prior around ``PRIOR``.  ``times``: how often each island
    counts (once)."""
    weights = dict(PRIOR)
    if not islands:
        return weights
    counted: dict = {}
    for (n, cands, gold), m in zip(islands, times or [1] * len(islands)):
        key = (n, tuple((c[0], c[1], tuple(c[5])) for c in cands), tuple((c[0], c[1], tuple(c[5])) for c in gold))
        counted.setdefault(key, [0, (n, cands, gold)])[0] += m
    total = sum(m for m, _ in counted.values())
    for _ in range(STEPS):
        step: dict = {}
        for m, (n, cands, gold) in counted.values():
            for c in gold:
                for name in c[5]:
                    step[name] = step.get(name, 0.0) + m
            for name, v in _expected(weights, n, cands).items():
                step[name] = step.get(name, 0.0) - m * v
        for name, g in step.items():
            pull = PRIOR_STRENGTH * (weights.get(name, 0.0) - PRIOR.get(name, 0.0))
            weights[name] = weights.get(name, 0.0) + RATE * (20 * g / total - pull)
    return weights


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> dict:
    """Weights from a hash sample of about ``sample_docs`` documents; their
    texts are read on the executors, and only the distinct islands' candidates
    (a few small tuples, with a count) reach the driver."""
    total = docs.count()
    if not total:
        return dict(PRIOR)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            some = [pickle.dumps(g) for t in batch.column(0).to_pylist() for g in gold_islands(t or "")]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.binary())], ["island"])
    at = unit_hash(docs[id_col], seed="pii-train")
    sample = docs.where(at < sample_docs / total).select(docs[text_col].alias("text"))
    found = sample.where(F.col("text").rlike("[0-9]{2}")).mapInArrow(run, "island binary").groupBy("island").count()
    rows = sorted(found.orderBy(F.xxhash64("island"), "island").limit(TRAIN_ISLANDS).collect(), key=lambda r: bytes(r["island"]))
    return fit([pickle.loads(bytes(r["island"])) for r in rows], [r["count"] for r in rows])


def tag(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame, weights: dict | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base array, spans array): all spans of every whole text, each
    (kind, start, end); trains first unless weights are given."""
    weights = train(docs, id_col, text_col) if weights is None else weights
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            both = [all_spans(weights, t or "") for t in batch.column(1).to_pylist()]
            named = [[[{"kind": k, "start": s, "end": e} for k, s, e in x] for x in side] for side in zip(*both)] or [[], []]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, span) for x in named)], ["doc_id", "base", "spans"])
    kind = "array<struct<kind:string,start:int,end:int>>"
    d = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    return d.mapInArrow(run, f"doc_id long, base {kind}, spans {kind}")


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind in angle brackets
    (overlapping spans are replaced together, by the first one's kind)."""
    out, at = [], 0
    for k, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if s >= at:
            out += [text[at:s], f"<{k}>"]
        at = max(at, e)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, weights: dict | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, columns unchanged, personal data in the text masked."""
    weights = train(docs, id_col, text_col) if weights is None else weights
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [None if t is None else masked(t, all_spans(weights, t)[1]) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(
                [batch.schema.field(i).with_type(c.type) for i, c in enumerate(columns)]))
    return docs.mapInArrow(run, docs.schema)


def tagged(spans: str):
    """Column: spans joined as kind:start:end by commas, in array order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
