"""Sinks, readers and the streaming append."""

import tempfile

import pytest
from pyspark.sql import functions as F

from lectern import schemas
from lectern.operators import records as R
from lectern.operators.assets import edited_key
from lectern.sources import readers, sinks
from lectern.streaming.append import append_stream


def test_create_dataset_refuses_existing(spark):
    path = tempfile.mkdtemp(prefix="lectern-ds-") + "/data"
    sinks.create_dataset(spark, path)
    with pytest.raises(ValueError, match="Output file already exists. Use rewrite=True to overwrite it."):
        sinks.create_dataset(spark, path)
    sinks.create_dataset(spark, path, rewrite=True)


def test_append_twice_reads_back(spark):
    path = tempfile.mkdtemp(prefix="lectern-ds-") + "/data"
    sinks.create_dataset(spark, path)
    recs = spark.createDataFrame(
        [([("system", [("text", "info\nletters", None)]), ("user", [("text", "А1. Q", None), ("image", None, "data:x")])],
          "1", "03-phy-2023-rus-A1", ("c", "phy", "2023", "rus", "A", 1, "uuid"))], schemas.RECORD)
    sinks.append_records(recs, path)
    sinks.append_records(recs, path)
    back = readers.read_records(spark, path)
    assert back.count() == 2
    line = back.select(F.to_json(F.struct(*back.columns))).first()[0]
    assert '"content":[{"type":"text","text":"А1. Q"},{"type":"image","image":"data:x"}]' in line


def test_paths_and_rejects(spark):
    req = spark.createDataFrame([("phy", "2023")], "subject string, year string")
    docs = R.exam_documents(spark, req).orderBy("lang_order").collect()
    assert [d.test_path for d in docs] == ["data/03_phy/03_phy_test_2023_rus.pdf", "data/03_phy/03_phy_test_2023_bel.pdf"]
    assert docs[0].consult_path == "data/03_phy/03_phy_consult_2023.pdf"
    bad = spark.createDataFrame([("phy", "invalid", "2023"), ("invalid", "rus", "2023")],
                                "subject string, language string, year string")
    msgs = sorted(r.error for r in R.catalogue_rejects(spark, bad).collect())
    assert msgs == ["Language 'invalid' is not a valid language.", "Subject 'invalid' is not a valid subject code."]
    with pytest.raises(ValueError, match="Subject 'invalid'"):
        R.raise_on_rejects(R.catalogue_rejects(spark, bad.where("subject = 'invalid'")))
    p = spark.createDataFrame([("data/03_phy/03_phy_test_2023_rus.pdf",)], "path string")
    row = readers.exam_catalogue_from_paths(p).first()
    assert (row.code, row.subject, row.kind, row.year, row.language) == ("03", "phy", "test", "2023", "rus")
    (k,) = spark.range(1).select(edited_key(F.lit("d/page1_img2_edit.png"))).first()
    assert k == "page1_img2.png"


def test_streaming_append(spark):
    src = tempfile.mkdtemp(prefix="lectern-src-")
    out = tempfile.mkdtemp(prefix="lectern-out-") + "/q"
    spark.createDataFrame([("d", "А1. Question 1\n")], "doc_id string, text string").write.mode("overwrite").parquet(src)
    q = append_stream(spark, src, "doc_id string, text string", out, name="t" + src[-6:])
    q.awaitTermination(120)
    assert [r.text for r in spark.read.json(out).collect()] == ["А1. Question"]


def test_image_files_and_sinks(spark):
    import os

    from lectern.operators import assets as AS
    root = tempfile.mkdtemp(prefix="lectern-img-")
    os.makedirs(f"{root}/13_geo_test_2023_rus")
    for name, data in [("page1_img1.png", b"one"), ("page1_img2.jpeg", b"two"), ("page1_img2_edit.jpeg", b"TWO")]:
        with open(f"{root}/13_geo_test_2023_rus/{name}", "wb") as f:
            f.write(data)
    imgs = readers.read_image_files(spark, root).where(~F.col("filename").contains("_edit"))
    got = sorted((r.doc_id, r.filename, r.page_no, r.img_no, r.format, bytes(r.content)) for r in imgs.collect())
    assert got == [("13_geo_test_2023_rus", "page1_img1.png", 1, 1, "png", b"one"),
                   ("13_geo_test_2023_rus", "page1_img2.jpeg", 1, 2, "jpeg", b"two")]
    edited = readers.read_image_files(spark, root, edited_only=True)
    assert [(r.filename, bytes(r.content)) for r in edited.collect()] == [("page1_img2.jpeg", b"TWO")]
    described = AS.override_images(AS.describe(imgs.drop("filename")), edited.select("doc_id", "filename", "content"))
    urls = sorted((r.filename, r.image_url) for r in described.collect())
    assert urls == [("page1_img1.png", "data:image/png;base64,b25l"), ("page1_img2.jpeg", "data:image/jpeg;base64,VFdP")]
    out = tempfile.mkdtemp(prefix="lectern-out-")
    sinks.save_images(AS.describe(imgs.drop("filename")), f"{out}/bytes")
    sinks.save_image_info(described, f"{out}/info")
    assert spark.read.parquet(f"{out}/bytes").count() == 2
    assert sorted(r.filename for r in spark.read.json(f"{out}/info").collect()) == ["page1_img1.png", "page1_img2.jpeg"]
    paths = spark.createDataFrame([("a/13_geo_test_2023_rus.pdf",), ("a/13_geo_test_2023_bel.pdf",), ("a/13_geo_consult_2023.pdf",)], "p string")
    assert [r[0] for r in paths.select(AS.image_source_ok(F.col("p"))).collect()] == [True, True, False]


def test_reference_order(spark):
    df = spark.createDataFrame([(1, "d", 1, 5), (0, "d", 1, 2), (0, "d", 0, 9), (0, "d", 0, 3)],
                               "lang_order int, doc_id string, section_order int, pos int")
    got = [(r.lang_order, r.section_order, r.pos) for r in R.in_reference_order(df).collect()]
    assert got == [(0, 0, 3), (0, 0, 9), (0, 1, 2), (1, 1, 5)]


def test_streaming_accuracy(spark):
    import json
    import os

    from lectern.streaming.scoring import latest_accuracy, start_accuracy
    src = tempfile.mkdtemp(prefix="lectern-comp-")
    out = tempfile.mkdtemp(prefix="lectern-acc-") + "/acc"
    recs = spark.createDataFrame([("r1", "4", 1), ("r2", "B", 2), ("r3", "x", 2)], "id string, target string, points int")
    with open(os.path.join(src, "part1.json"), "w") as f:
        for rid, model, text in [("r1", "m", "so ANSWER: 4"), ("r2", "m", "ANSWER: b"), ("r3", "m", "nope"),
                                 ("r1", "n", "ANSWER: 5"), ("r1", "n", "ANSWER: 5")]:
            f.write(json.dumps({"id": rid, "model": model, "completion": text}) + "\n")
    q = start_accuracy(spark, src, recs, out, name="acc" + src[-6:])
    q.awaitTermination(180)
    got = {r.model: (r.questions, r.weighted_accuracy) for r in latest_accuracy(spark, out).collect()}
    assert got == {"m": (3, 3 / 5), "n": (1, 0.0)}
    with open(os.path.join(src, "part2.json"), "w") as f:
        f.write(json.dumps({"id": "r3", "model": "n", "completion": "ANSWER: x"}) + "\n")
    start_accuracy(spark, src, recs, out, name="acc" + src[-6:]).awaitTermination(180)
    got = {r.model: (r.questions, r.weighted_accuracy) for r in latest_accuracy(spark, out).collect()}
    assert got == {"m": (3, 3 / 5), "n": (2, 2 / 3)}


def test_partitioned_records(spark):
    path = tempfile.mkdtemp(prefix="lectern-ds-") + "/data"
    recs = spark.createDataFrame(
        [([("user", [("text", "q", None)])], "1", f"id{i}", ("c", subj, "2023", "rus", "A", 1, "k"))
         for i, subj in enumerate(["geo", "phy", "geo"])], schemas.RECORD)
    sinks.append_records(recs, path, partition_by=("subject", "year"))
    back = spark.read.json(path).where(F.col("_subject") == "geo")
    assert sorted(r.id for r in back.collect()) == ["id0", "id2"]


def test_exam_catalogue(spark):
    req = spark.createDataFrame([("geo", "2023"), ("nope", "2023")], "subject string, year string")
    got = sorted((r.doc_id, r.language, r.kind) for r in R.exam_catalogue(spark, req).collect())
    assert got == [("data/13_geo/13_geo_consult_2023.pdf", None, "consult"),
                   ("data/13_geo/13_geo_test_2023_bel.pdf", "bel", "test"),
                   ("data/13_geo/13_geo_test_2023_rus.pdf", "rus", "test")]
