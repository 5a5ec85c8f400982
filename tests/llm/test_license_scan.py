"""License scan (6): inheritance on a given table; terms of all files; wrapped headers, sentences, full texts."""

import math
import random
import re

import pytest

from lectern.llm import license_scan
from lectern.llm.queries import op6_license_scan

SF = "/root/testdata/sf0.01"


def test_directories_inherit_on_a_given_table(spark):
    rows = op6_license_scan(spark, SF).collect()
    notices = {r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()
               if re.search(license_scan.LANGUAGE, r["text"] or "")}
    assert {r["doc_id"] for r in rows if r["own"]} == notices and notices
    folder = lambda p: p.rpartition("/")[0]
    given = {}
    for r in rows:
        if r["own"]:
            d = folder(r["path"])
            given[d] = min(given.get(d, (1.0, 0, "")), (-r["cosine"], r["doc_id"], r["own"]))
    inherited = 0
    for r in rows:
        if r["own"]:
            assert (r["license"], r["license_dir"], r["distance"]) == (r["own"], None, None)
            continue
        at, want = folder(r["path"]).split("/"), (None, None, None)
        for up in range(len(at) + 1):
            d = "/".join(at[:len(at) - up])
            if d in given:
                want = (given[d][2], d, up)
                break
        assert (r["license"], r["license_dir"], r["distance"]) == want
        inherited += want[0] is not None
    assert inherited > len(notices)


WORDS = "it is as the and of for a an in to we this that with by on code file use work see".split()


def prose(n=200, seed=4):
    """Ordinary texts: common words and each its own rare ones."""
    r = random.Random(seed)
    return [" ".join([*r.choices(WORDS, k=30), f"rare{i}", f"rare{i % 50}x"]) + "." for i in range(n)]


def scanned(spark, texts, name="{}.txt"):
    rows = [(i, f"d{i}/" + name.format(i), t) for i, t in enumerate([*texts, *prose()])]
    df = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = {r["id"]: (r["own"], r["cosine"]) for r in license_scan.scan(df).collect()}
    assert all(got[i][0] is None for i in range(len(texts), len(rows)))
    return [got[i][0] for i in range(len(texts))]


def gnu_header(name, version):
    return f"""# Copyright (C) 2020 Some Body
#
# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU {name} as published by
# the Free Software Foundation, either version {version} of the License, or
# (at your option) any later version.
#
# This program is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
# GNU {name} for more details.
#
# You should have received a copy of the GNU {name}
# along with this program.  If not, see <https://www.gnu.org/licenses/>.

import os
"""


def test_headers_titles_and_sentences(spark):
    cases = [
        (gnu_header("General Public License", "3"), "GPL-3.0"), (gnu_header("General Public License", "2"), "GPL-2.0"),
        (gnu_header("Lesser General Public License", "3"), "LGPL-3.0"), (gnu_header("Affero General Public License", "3"), "AGPL-3.0"),
        ("GNU GENERAL PUBLIC LICENSE", "GPL-1.0-or-later"), ("The MIT License (MIT)", "MIT"), ("# MIT License", "MIT"),
        ("the code of this work. Released under the MIT License. rare7 is rare8 and of rare9x", "MIT"),
        ("/* Permission is\n * hereby granted, free of charge, to any person\n * obtaining a copy of this software */", "MIT"),
        ("x\nLicensed under CC BY-SA 4.0.", "CC-BY-SA-4.0"), ("x\nLicensed under CC BY 4.0.", "CC-BY-4.0"),
        ("Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.",
         "Apache-2.0"),
        ("we license it as a work of the code", None), (None, None), ("", None),
    ]
    assert scanned(spark, [t for t, _ in cases]) == [w for _, w in cases]


@pytest.mark.parametrize("name", ["{}.txt", "LICENSE.{}"])
def test_full_texts(spark, name):
    full = license_scan.full_texts()
    assert {"GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "CC-BY-SA-4.0", "BSD-2-Clause", "ISC"} <= {n for n, _ in full}
    assert scanned(spark, ["Copyright 2020 Some Body\n\n" + t for _, t in full], name) == [n for n, _ in full]


def test_terms_of_all_files_are_counted(spark):
    """A frequent word beside a notice weighs less than a rare one, by its own count."""
    notice, texts = "Released under the MIT License", prose()
    files = [(0, "a", f"{notice} as it is"), (1, "b", f"{notice} zyx wvu tsr")] + [(i + 2, "c", t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(files, "id long, path string, text string")
    got = {r["id"]: r["cosine"] for r in license_scan.own_licenses(df).where("id < 2").collect()}
    split = [set(re.findall(r"[a-z0-9]+", t.lower())) for _, _, t in files]
    idf = lambda t: math.log((1 + len(files)) / (1 + sum(t in s for s in split))) + 1
    length = lambda words: math.sqrt(sum(idf(w) ** 2 for w in words))
    base = length(notice.lower().split())
    assert got[0] == pytest.approx(base / length((notice + " as it is").lower().split()), abs=1e-6)
    assert got[1] == pytest.approx(base / length((notice + " zyx wvu tsr").lower().split()), abs=1e-6)
    assert got[0] > license_scan.MIN_COSINE > got[1]
    n, counts = license_scan.frequencies(df)
    assert n == len(files) and counts["it"] == sum("it" in s for s in split) and counts["zyx"] == 1 and "nowhere" not in counts
