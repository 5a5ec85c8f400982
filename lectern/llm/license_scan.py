"""License scan: templates by sparse TF-IDF cosine, then inheritance by path (operator 6).

Rows are files (id, path, text).  The *passages* of a file are its lines that
hold license language, the runs of up to ``RUN`` neighbouring lines around
them, its sentences (over line breaks) and paragraphs that hold it, and the
whole text of a file with such language or with a name like ``LICENSE`` or
``COPYING``.  A passage's term counts and a template's are weighted by inverse
document frequency, counted over all files for all terms: (term, number of
files) is a table that sparse terms of the distinct passages join.  The best
template at ``MIN_COSINE`` or more over all passages is the file's own license
(ties: the template of more terms, then the license's name).

Templates are short notices, headers and titles (``TEMPLATES``) and the full
texts in ``licenses/``.

A file without one inherits that of the nearest directory above it (its own
directory first) holding a licence file: directories are resolved once, as one
row per (directory, ancestor), by an equi-join on the path, and files then
join their directory.  Of several licence files in a directory the best match
counts, ties by least id.

Edge cases: NULL or empty texts have no license of their own but inherit; a
NULL path neither gives nor inherits; files at the root have directory "";
repeated rows are scanned each; an empty table gives an empty result; input
columns beside the three named are ignored; very long lines cost linear time.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator, Mapping
from functools import cache
from importlib import resources

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import written
from lectern.llm.quality_rules import bind

MIN_COSINE = 0.75
RUN = 4                 # most lines of a run around a line with license language


def _gnu(name: str, version: str, noun: str = "program") -> str:
    """The first paragraph of the header that the GNU licenses ask for."""
    return (f"This {noun} is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as "
            f"published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version.")


def _gnu_rest(name: str, noun: str = "program") -> str:
    return (f" This {noun} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
            f"warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details. You should have "
            f"received a copy of the GNU {name} along with this {noun}. If not, see <https://www.gnu.org/licenses/>.")


# name: (full name, version, day of the version, what the header calls the work)
_GNU = {
    "AGPL-3.0": ("Affero General Public License", "3", "19 November 2007", "program"),
    "GPL-2.0": ("General Public License", "2", "June 1991", "program"),
    "GPL-3.0": ("General Public License", "3", "29 June 2007", "program"),
    "LGPL-2.1": ("Lesser General Public License", "2.1", "February 1999", "library"),
    "LGPL-3.0": ("Lesser General Public License", "3", "29 June 2007", "library"),
}
_CC = {
    "CC-BY-4.0": ("BY", "Attribution"),
    "CC-BY-NC-4.0": ("BY-NC", "Attribution-NonCommercial"),
    "CC-BY-NC-ND-4.0": ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
    "CC-BY-NC-SA-4.0": ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    "CC-BY-ND-4.0": ("BY-ND", "Attribution-NoDerivatives"),
    "CC-BY-SA-4.0": ("BY-SA", "Attribution-ShareAlike"),
}
_APACHE = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'

# Notices, headers and titles that stand for each license (SPDX names).
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", _APACHE + " You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
     'applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
     "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
     "permissions and limitations under the License."),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("GPL-1.0-or-later", "GNU General Public License"),
    ("GPL-1.0-or-later", "Licensed under the GNU General Public License."),
    ("ISC", "ISC License"),
    ("ISC", "Released under the ISC License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
     "provided that the above copyright notice and this permission notice appear in all copies."),
    ("MIT", "MIT License"),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MIT", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation '
     'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, '
     "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
     "furnished to do so, subject to the following conditions:"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
     "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
]
for _name, (_full, _version, _day, _noun) in _GNU.items():
    TEMPLATES += [
        (_name, f"This work is licensed under the GNU {_full}, version {_version}."),
        (_name, f"GNU {_full} Version {_version}, {_day}"),
        (_name, f"SPDX-License-Identifier: {_name}-only"), (_name, f"SPDX-License-Identifier: {_name}-or-later"),
    ]
    for _work in sorted({"program", _noun}):
        TEMPLATES += [(_name, _gnu(_full, _version, _work)), (_name, _gnu(_full, _version, _work) + _gnu_rest(_full, _work))]
for _name, (_short, _full) in _CC.items():
    TEMPLATES += [
        (_name, f"Licensed under CC {_short} 4.0."), (_name, f"CC {_short} 4.0"),
        (_name, f"This work is licensed under a Creative Commons {_full} 4.0 International License."),
        (_name, f"Creative Commons {_full} 4.0 International Public License"),
    ]
TEMPLATES += [(_name, f"SPDX-License-Identifier: {_name}")
              for _name in ["Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "MIT", "MPL-2.0", *_CC]]
# A candidate holds one of these; every notice does.
LANGUAGE = (r"(?i)licen[sc]e|permission\W+is\W+hereby|permission\W+to\W+use|redistribution\W+and\W+use|creative\W+commons"
            r"|general\W+public|\bcc\W+by\b")
LICENCE_FILE = r"(?i)(^|/)(licen[sc]e|copying|notice)[^/]*$"
_TERM = r"[^\p{L}\p{N}]+"


def terms(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), _TERM), "")


@cache
def full_texts() -> list[tuple[str, str]]:
    """(license, text) of the files in ``licenses/``."""
    found = sorted((x for x in resources.files("lectern.llm").joinpath("licenses").iterdir() if x.name.endswith(".txt")),
                   key=lambda x: x.name)
    return [(x.name.removesuffix(".txt"), x.read_text(encoding="utf-8")) for x in found]


@cache
def template_terms() -> list[tuple[str, Counter]]:
    return [(name, Counter(re.findall(r"[a-z0-9]+", text.lower()))) for name, text in TEMPLATES + full_texts()]


@cache
def vocabulary() -> list[str]:
    return sorted({t for _, c in template_terms() for t in c})


class TermValues(Mapping):
    """A value for every term of the files.  The templates' terms are held
    here; ``table`` (term, docs) has them all and is looked up for others."""

    def __init__(self, table: DataFrame, held: dict[str, int], of: Callable[[int], float] = lambda docs: docs):
        self.table, self.held, self.of = table, held, of

    def __getitem__(self, term: str) -> float:
        docs = self.held.get(term)
        if docs is None:
            row = self.table.where(F.col("term") == term).first()
            if row is None:
                raise KeyError(term)
            docs = row["docs"]
        return self.of(docs)

    def __iter__(self) -> Iterator[str]:
        return (r["term"] for r in self.table.select("term").toLocalIterator())

    def __len__(self) -> int:
        return self.table.count()


def frequencies(files: DataFrame) -> tuple[int, TermValues]:
    """Number of files and document frequency of every term; only those of the
    templates' terms reach the driver."""
    seen = files.select(F.explode(F.concat(F.array(F.lit("")), F.array_distinct(
        terms(F.coalesce(F.col("text"), F.lit("")))))).alias("term"))
    table = written(seen.groupBy("term").agg(F.count(F.lit(1)).alias("docs")), "license-terms")
    held = {r["term"]: r["docs"] for r in table.where(F.col("term").isin(["", *vocabulary()])).collect()}
    return held.pop("", 0), TermValues(table.where("term <> ''"), held)


def weights(n: int, counts: TermValues) -> tuple[TermValues, float]:
    """Inverse document frequency of every term: of the templates' terms, also
    where no file has them, and of any other term in the files.  The number is
    that of a term without files."""
    of = lambda df: math.log((1 + n) / (1 + df)) + 1
    return TermValues(counts.table, {t: counts.held.get(t, 0) for t in vocabulary()}, of), of(0)


def passages(text: Column, path: Column) -> Column:
    """The distinct passages of a file, each as its terms joined by a blank."""
    speaks = lambda s: s.rlike(LANGUAGE)
    around = [(i, size) for size in range(1, RUN + 1) for i in range(size)]

    def parts(lines: Column) -> Column:
        at = F.filter(F.transform(lines, lambda s, i: F.when(speaks(s), i)), lambda i: i.isNotNull())
        runs = F.flatten(F.transform(at, lambda i: F.array(*[F.array_join(F.slice(
            lines, F.greatest(i - before, F.lit(0)) + 1, F.least(i, F.lit(before)) + size - before), "\n") for before, size in around])))
        # lines without a letter or digit part paragraphs, also inside comment marks
        bare = F.transform(lines, lambda s: F.when(s.rlike(r"[\p{L}\p{N}]"), s).otherwise(""))
        paragraphs = F.filter(F.split(F.array_join(bare, "\n"), "\n\n+"), speaks)
        sentences = F.filter(F.flatten(F.transform(paragraphs, lambda s: F.split(s, r"(?<=[.!?])\s+"))), speaks)
        return F.concat(runs, sentences, paragraphs)
    none = F.array().cast("array<string>")
    inside = F.when(speaks(text), F.concat(F.array(text), bind(F.split(text, "\n"), parts))).when(
        path.rlike(LICENCE_FILE) & text.isNotNull(), F.array(text)).otherwise(none)
    return F.array_remove(F.array_distinct(F.transform(inside, lambda s: F.array_join(terms(s), " "))), "")


def template_table(spark, idf: TermValues) -> DataFrame:
    """(term, idf, entries): a templates' term, and its number and weight, over
    the template's length, in every template with the term."""
    entries: dict[str, list] = {}
    for no, (_, c) in enumerate(template_terms()):
        norm = math.sqrt(sum((k * idf[t]) ** 2 for t, k in c.items()))
        for t, k in c.items():
            entries.setdefault(t, []).append((no, k * idf[t] / norm))
    return spark.createDataFrame([(t, idf[t], e) for t, e in sorted(entries.items())],
                                 "term string, idf double, entries array<struct<no:int,x:double>>")


def term_counts(distinct: DataFrame) -> DataFrame:
    """(pid, term, k): how often each term stands in each passage."""
    return (distinct.repartition("pid").select("pid", F.explode(F.split("passage", " ")).alias("term"))
            .groupBy("pid", "term").agg(F.count(F.lit(1)).alias("k")))


def best_templates(distinct: DataFrame, known: DataFrame) -> DataFrame:
    """(pid, dot, square, others, terms, license): the best template of every
    passage, the product with it, the squared length of the passage's terms that
    templates have, and the sum of the others' squared counts.  Which template
    is best does not depend on the passage's length, so not on other terms."""
    entries = F.when(F.col("idf").isNull(), F.array(F.struct(F.lit(-2).alias("no"), F.col("k").cast("double").alias("x")))).otherwise(
        F.concat(F.array(F.struct(F.lit(-1).alias("no"), (F.col("k") * F.col("idf")).alias("x"))), "entries"))
    x = F.col("k") * F.coalesce("idf", F.lit(1.0))
    dots = (term_counts(distinct).join(F.broadcast(known), "term", "left").select("pid", x.alias("x"), F.explode(entries).alias("e"))
            .groupBy("pid", F.col("e.no").alias("no")).agg(F.sum(F.col("x") * F.col("e.x")).alias("dot")))
    total = lambda no: F.coalesce(F.sum(F.when(F.col("no") == no, F.col("dot"))), F.lit(0.0))
    of_all = dots.groupBy("pid").agg(total(-1).alias("square"), total(-2).alias("others"),
                                     F.collect_list(F.when(F.col("no") >= 0, F.struct("no", "dot"))).alias("dots"))
    about = F.array(*[F.struct(F.lit(-sum(c.values())).alias("terms"), F.lit(name).alias("license")) for name, c in template_terms()])
    best = F.array_min(F.transform("dots", lambda d: F.struct(
        (-F.round(d["dot"] / F.sqrt("square"), 9)).alias("rank"), F.get(about, d["no"])["terms"].alias("terms"),
        F.get(about, d["no"])["license"].alias("license"), d["dot"].alias("dot"))))
    return of_all.select("pid", "square", "others", best.alias("b")).where("b IS NOT NULL").select(
        "pid", "b.dot", "square", "others", "b.terms", "b.license")


def own_licenses(files: DataFrame) -> DataFrame:
    """(id, path, own, cosine): the best match of each file's passages.

    Passages are compared once each, in however many files they stand.  An other
    term weighs between 1 and the weight of a term in one file, which bounds
    every cosine; document frequencies join only the terms of passages that may
    be the best of a file by these bounds.
    """
    n, counts = frequencies(files)
    idf, _ = weights(n, counts)
    f = written(files.select(F.monotonically_increasing_id().alias("row"), "id", "path", passages(F.col("text"), F.col("path")).alias("passages")),
                "license-passages")
    each = f.select("row", F.explode("passages").alias("passage"))
    distinct = written(each.select("passage").distinct().select(
        F.monotonically_increasing_id().alias("pid"), "passage", F.sha2("passage", 256).alias("key")), "license-distinct")
    known = template_table(files.sparkSession, idf)
    best = written(best_templates(distinct, known).join(distinct.select("pid", "key"), "pid"), "license-best")

    keys = each.select("row", F.sha2("passage", 256).alias("key"))
    most = math.log((1 + n) / 2) + 1 if n else 1.0
    cosine = lambda other: F.col("dot") / F.sqrt(F.col("square") + other)
    bounded = written(keys.join(best, "key").select("row", "pid", "dot", "square", "others", "terms", "license"), "license-bounds")
    floor = bounded.groupBy("row").agg(F.max(cosine(F.col("others") * most * most)).alias("floor"))
    left = written(bounded.join(floor, "row").where(cosine(F.col("others")) >= F.col("floor") - 1e-8).drop("floor"), "license-left")
    unsure = left.where("others > 0").select("pid").distinct()
    other = (term_counts(distinct.join(unsure, "pid", "left_semi")).join(F.broadcast(known.select("term")), "term", "left_anti")
             .join(counts.table, "term").groupBy("pid")
             .agg(F.sum(F.pow(F.col("k") * (F.log(F.lit(1.0 + n) / (F.col("docs") + 1)) + 1), F.lit(2.0))).alias("other")))
    rank = (-F.round(cosine(F.coalesce("other", F.lit(0.0))), 9)).alias("rank")
    of_row = left.join(other, "pid", "left").groupBy("row").agg(F.min(F.struct(rank, "terms", "license")).alias("b"))
    return (f.select("row", "id", "path").join(of_row, "row", "left")
            .select("id", "path", F.when(F.col("b.rank") <= -MIN_COSINE, F.col("b.license")).alias("own"),
                    F.coalesce(-F.col("b.rank"), F.lit(0.0)).alias("cosine")))


def directory(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def ancestors(folder: Column) -> Column:
    """The directory and all above it, nearest first: structs (distance, path)."""
    parts = F.split(folder, "/")
    deep = F.when(folder == "", F.lit(0)).otherwise(F.size(parts))
    return F.transform(F.sequence(F.lit(0), deep), lambda i: F.struct(
        i.alias("distance"), F.array_join(F.slice(parts, 1, F.greatest(deep - i, F.lit(0))), "/").alias("path")))


def scan(files: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text",
         gives: Column | None = None) -> DataFrame:
    """(id, path, own, cosine, license, license_dir, distance) of every file.

    ``gives`` (over columns id, path, own, cosine) says which files speak for
    their directory; by default files named as licence files.
    """
    f = files.select(F.col(id_col).alias("id"), F.col(path_col).cast("string").alias("path"), F.col(text_col).alias("text"))
    own = written(own_licenses(f).withColumn("dir", directory(F.col("path"))), "license-own")
    speaks = F.col("path").rlike(LICENCE_FILE) if gives is None else gives
    given = (own.where(F.col("own").isNotNull() & F.col("path").isNotNull() & speaks).groupBy(F.col("dir").alias("from_dir"))
             .agg(F.min(F.struct((-F.col("cosine")).alias("rank"), "id", "own"))["own"].alias("license")))
    given = written(given, "license-dirs")
    dirs = own.where("dir IS NOT NULL").select("dir").distinct()
    up = dirs.select("dir", F.explode(ancestors(F.col("dir"))).alias("a")).select("dir", F.col("a.distance"), F.col("a.path").alias("from_dir"))
    nearest = written(up.join(given, "from_dir").groupBy("dir").agg(F.min(F.struct("distance", "from_dir", "license")).alias("n")), "license-near")
    j = own.join(nearest, "dir", "left")
    return j.select("id", "path", "own", "cosine", F.coalesce("own", "n.license").alias("license"),
                    F.when(F.col("own").isNull(), F.col("n.from_dir")).alias("license_dir"),
                    F.when(F.col("own").isNull(), F.col("n.distance")).alias("distance"))
