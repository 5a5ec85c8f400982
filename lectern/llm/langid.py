"""Language identification, family first, then one against one (operator 5).

Texts are lower-cased; the share of each hashed byte trigram (anything but
letters counts as a space) is the feature vector.  A linear support vector
machine per family, one against the rest, chooses the family; inside it, one
machine per pair of languages votes.  Languages without an entry in
``FAMILIES`` are families of their own.

Learning: about ``PER_LANGUAGE`` documents per language, taken by a hash of the
id at the rate that their number in the whole table asks for, each as a whole
and in ``EXCERPTS`` short pieces (so that short texts are known too).  The
machines are fitted in the dual by coordinate descent.  Every text is predicted
whole.

Edge cases: NULL, empty and letterless texts are ``und`` with score 0; rows
with NULL language are predicted but not learned from; with one known language
everything else is that language, with none all is ``und``; ties go to the
language first in order; repeated rows agree; language, source and id are never
inputs; input columns beside the named ones are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.chunks import groups
from lectern.llm.common import slices, unit_hash, written

# Families of common languages by ISO 639-1 code.
FAMILIES = {
    "germanic": ("da", "de", "en", "is", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "gl", "it", "pt", "ro"),
    "slavic": ("be", "bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
}
BUCKETS = 1 << 13
PER_LANGUAGE, IN_ALL = 250, 1_500   # sampled documents: of a language, and of all languages together
EXCERPTS, EXCERPT_CHARS = 3, 60
COST, EPOCHS = 1.0, 15
UNDETERMINED = "und"
MOST_GATHERED = 20_000_000      # weights (trigrams x machines) summed row by row

_LETTER = re.compile(r"[^\W\d_]")
# ASCII other than letters becomes a space; bytes of longer characters stay.
_TABLE = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def family_of(lang: str) -> str:
    return next((f for f, members in FAMILIES.items() if lang in members), lang)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every trigram of every text that holds a letter, and where each text's begin."""
    raw = [b"  " + t.lower().encode("utf-8", "replace").translate(_TABLE) + b"  " for t in texts]
    b = np.frombuffer(b"".join(raw), "uint8").astype("uint32")
    size = np.array([len(r) for r in raw])
    code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    last = np.cumsum(size)[:-1]
    keep = code != 0x202020
    keep[np.concatenate([last - 2, last - 1])] = False  # trigrams across two texts
    owner_starts = np.concatenate([[0], last])
    kept_before = np.concatenate([[0], np.cumsum(keep)])
    code = code[keep]
    return ((code * np.uint32(2654435761)) >> np.uint32(32 - 13)).astype("int32"), kept_before[owner_starts]


def vector(text: str) -> np.ndarray:
    codes, _ = trigrams([text])
    return np.bincount(codes, minlength=BUCKETS).astype("float32") / max(len(codes), 1)


def excerpts(text: str) -> list[str]:
    step = max(len(text) // EXCERPTS, 1)
    return [p for p in (text[i * step:i * step + EXCERPT_CHARS] for i in range(EXCERPTS)) if _LETTER.search(p)]


def machine(gram: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Dual coefficients alpha*y of a linear machine with squared hinge loss,
    by coordinate descent on the Gram matrix (a constant feature included)."""
    diag, a, f = np.diag(gram).astype("float64") + 0.5 / COST, np.zeros(len(y)), np.zeros(len(y))
    order = np.random.default_rng(5).permutation(len(y))
    for _ in range(EPOCHS):
        for i in order:
            new = max(0.0, a[i] - (y[i] * f[i] + 0.5 * a[i] / COST - 1) / diag[i])
            if new != a[i]:
                f += (new - a[i]) * y[i] * gram[i]
                a[i] = new
    return a * y


def fit(x: np.ndarray, langs: list[str]) -> dict:
    """Weights (BUCKETS, machines), constants, and what each machine separates.
    ``x`` is standardised in place."""
    known = sorted(set(langs))
    fams = sorted({family_of(k) for k in known})
    lang = np.array(langs)
    fam = np.array([family_of(k) for k in langs])
    jobs = [("family", f, None) for f in fams] if len(fams) > 1 else []
    jobs += [("pair", p, q) for f in fams for p, q in combinations([k for k in known if family_of(k) == f], 2)]
    w, c = np.zeros((BUCKETS, len(jobs)), "float32"), np.zeros(len(jobs))
    if jobs:
        mean, spread = x.mean(0), np.sqrt(x.var(0) + 1e-8)
        x -= mean
        x /= spread * 30  # of order one in length
        whole = x @ x.T
        whole += 1.0
        for k, (kind, p, q) in enumerate(jobs):
            rows = np.arange(len(lang)) if kind == "family" else np.flatnonzero((lang == p) | (lang == q))
            y = np.where((fam if kind == "family" else lang)[rows] == p, 1.0, -1.0)
            coef = machine(whole if kind == "family" else whole[np.ix_(rows, rows)], y)
            full = np.zeros(len(lang), "float32")
            full[rows] = coef
            w[:, k] = (full @ x) / (spread * 30)
            c[k] = coef.sum() - float(mean.astype("float64") @ w[:, k])
    return {"langs": known, "families": fams, "jobs": jobs, "weights": w, "constants": c}


def predict(model: dict, texts: list[str | None]) -> list[tuple[str, float]]:
    """(language, score) of each text."""
    out: list[tuple[str, float]] = []
    for some in groups([t or "" for t in texts], rows=64, chars=1_000_000):
        lettered = [t for t in some if _LETTER.search(t)] if model["langs"] else []
        margins = iter(())
        if lettered:
            codes, starts = trigrams(lettered)
            n = np.diff(np.append(starts, len(codes)))
            if not model["jobs"]:
                total = np.zeros((len(n), 0))
            elif len(codes) * len(model["jobs"]) > MOST_GATHERED:  # count buckets first: no row of weights for every trigram
                total = np.stack([np.bincount(c, minlength=BUCKETS) @ model["weights"] for c in np.split(codes, starts[1:])])
            else:
                total = np.add.reduceat(model["weights"][codes], starts, axis=0)
            margins = iter(total / n[:, None] + model["constants"])
        out += [_decide(model, next(margins)) if model["langs"] and _LETTER.search(t) else (UNDETERMINED, 0.0) for t in some]
    return out


def _decide(model: dict, margin: np.ndarray) -> tuple[str, float]:
    sure = 1 / (1 + np.exp(-2 * np.clip(margin, -15, 15)))
    by = {j: k for k, j in enumerate(model["jobs"])}
    fams, p = model["families"], 1.0
    fam = fams[0]
    if len(fams) > 1:
        fam = max(fams, key=lambda f: margin[by["family", f, None]])
        p = float(sure[by["family", fam, None]])
    members = [k for k in model["langs"] if family_of(k) == fam]
    votes = dict.fromkeys(members, 0.0)
    least = dict.fromkeys(members, 1.0)
    for a, b in combinations(members, 2):
        k = by["pair", a, b]
        votes[a if margin[k] >= 0 else b] += 1
        least[a], least[b] = min(least[a], float(sure[k])), min(least[b], 1 - float(sure[k]))
    best = max(members, key=lambda m: (votes[m], least[m]))
    return best, min(max(p * least[best], 0.0), 1.0)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = PER_LANGUAGE, in_all: int = IN_ALL) -> dict:
    """Model from the documents that are not held out: a hash sample of about
    ``per_language`` of each language, fewer where there are so many languages
    that all together would be more than ``in_all``, so what reaches the driver
    (and its matrix of products) does not grow with the languages."""
    d = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang"))
    d = d.where(F.col("_lang").isNotNull() & ~held_out(F.col("_id")))
    sizes = written(d.groupBy("_lang").agg(F.count("*").alias("_n")), "langid-sizes")
    rate = sizes.select("_lang", (F.lit(min(float(per_language), in_all / max(sizes.count(), 1))) / F.col("_n")).alias("_rate"))
    at = unit_hash(F.col("_id"), seed="langid-train")
    sample = d.join(rate, "_lang").where(at < F.col("_rate")).select("_id", "_lang", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, lang, text in zip(*(c.to_pylist() for c in batch.columns)):
                if text and _LETTER.search(text):
                    for part, piece in enumerate([text, *excerpts(text)]):
                        v = vector(piece)
                        at = np.flatnonzero(v)
                        rows.append({"id": str(key), "part": part, "lang": lang, "at": at.astype("<i4").tobytes(),
                                     "v": v[at].tobytes()})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                ("id", pa.string()), ("part", pa.int32()), ("lang", pa.string()), ("at", pa.binary()),
                ("v", pa.binary())]))
    rows = sample.mapInArrow(run, "id string, part int, lang string, at binary, v binary").collect()
    rows.sort(key=lambda r: (r["lang"], r["id"], r["part"], r["at"]))
    x = np.zeros((len(rows), BUCKETS), "float32")
    for k, r in enumerate(rows):
        x[k, np.frombuffer(r["at"], "<i4")] = np.frombuffer(r["v"], "<f4")
    langs = [r["lang"] for r in rows]
    del rows
    return fit(x, langs)


def identify(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = predict(model, batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([g[0] for g in got], pa.string()),
                                              pa.array([g[1] for g in got], pa.float64())],
                                             ["doc_id", "held_out", "lang_pred", "score"])
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"),
                    F.col(text_col).cast("string").alias("text"))
    return d.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: dict, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The documents, columns unchanged, whose language is determined with at
    least that score; with no language learned, those with a letter."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(at).to_pylist()
            if model["langs"]:
                ok = [lang != UNDETERMINED and s >= least for lang, s in predict(model, texts)]
            else:
                ok = [bool(t and _LETTER.search(t)) for t in texts]
            yield batch.filter(pa.array(ok, pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
