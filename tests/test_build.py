"""End-to-end build of records from layout tables of a small exam."""

import json

from pyspark.sql import functions as F

from lectern.build import ExamInputs, Profiles, build_records


def test_build_geo_exam(spark):
    docs = spark.createDataFrame(
        [("t-rus", "geo", "2023", "rus", "test"), ("t-bel", "geo", "2023", "bel", "test"),
         ("c", "geo", "2023", None, "consult")],
        "doc_id string, subject string, year string, language string, kind string")
    rus = ["Вступление\nЧасть А\nИнфо А\nА1. Столица :\n2) Брест;\n1) Па", "риж.\nДРТ–2023 г. 3\n",
           "Часть В\nВ1. Таблица\nH1 x T1 y\n"]
    bel = ["Частка А\nІнфа\nА1. Сталіца\nЧастка В\nВ1. Табліца H1 T1\n"]
    pages = spark.createDataFrame([("t-rus", i + 1, t) for i, t in enumerate(rus)]
                                  + [("t-bel", i + 1, t) for i, t in enumerate(bel)],
                                  "doc_id string, page_no int, text string")
    blocks = spark.createDataFrame(
        [("c", 1, 0, 141.0, 100.0, 225.0, 200.0, "А1. Вопрос.\nОтвет: 1"),
         ("c", 1, 1, 410.0, 100.0, 575.0, 200.0, "Столица"),
         ("c", 1, 2, 410.0, 120.0, 575.0, 200.0, "Франции"),
         ("c", 2, 0, 141.0, 50.0, 225.0, 60.0, "В1. Вопрос.\nОтвет: политика"),
         ("t-rus", 1, 0, 85.0, 150.0, 90.0, 155.0, "подпись")],
        "doc_id string, page_no int, block_no int, x0 double, y0 double, x1 double, y1 double, text string")
    images = spark.createDataFrame(
        [("t-rus", 1, 1, "png", b"first", 300.0, 300.0, 400.0, 400.0),
         ("t-rus", 1, 2, "png", b"second", 100.0, 100.0, 200.0, 200.0)],
        "doc_id string, page_no int, img_no int, format string, content binary, x0 double, y0 double, x1 double, y1 double")
    edited = spark.createDataFrame([("t-rus", "page1_img2.png", b"better")], "doc_id string, filename string, content binary")
    cells = spark.createDataFrame(
        [("t-rus", 0, 0, 0, "dropped"), ("t-rus", 1, 0, 0, "H1"), ("t-rus", 1, 1, 0, "T1")],
        "doc_id string, table_no int, row_no int, col_no int, text string")
    res = build_records(spark, ExamInputs(docs, pages, blocks, images, cells, edited), "canary",
                        Profiles.reference(spark))
    recs = {r.id: json.loads(r.j) for r in res.records.select(
        "id", F.to_json(F.struct("input", "target", "id", "metadata")).alias("j")).collect()}
    assert sorted(recs) == ["13-geo-2023-bel-A1", "13-geo-2023-bel-B1", "13-geo-2023-rus-A1", "13-geo-2023-rus-B1"]
    a1 = recs["13-geo-2023-rus-A1"]
    # "2)" comes before the first "1)", so it stays in the stem (options sort from "1)" on)
    assert a1["input"][1]["content"][0]["text"] == "А1. Столица :\n2) Брест;\n1) Париж."
    assert a1["input"][1]["content"][1] == {"type": "image", "image": "data:image/png;base64,YmV0dGVy"}
    assert a1["target"] == "1" and a1["metadata"]["comments"] == "Столица Франции"
    assert a1["input"][0]["content"][0]["text"].startswith("Инфо А\nOбразец")
    assert len(recs["13-geo-2023-bel-A1"]["input"][1]["content"]) == 2      # Russian images reused
    assert recs["13-geo-2023-bel-B1"]["target"] == "ПАЛІТЫКА"
    assert recs["13-geo-2023-rus-B1"]["target"] == "ПОЛИТИКА"
    assert recs["13-geo-2023-rus-B1"]["input"][1]["content"][0]["text"] == "В1. Таблица | H1 |\n| --- |\n| T1 |\n y"
    info = {r.filename: (r.question_id, r.nearby_text, r.size) for r in res.images.collect()}
    assert info == {"page1_img1.png": ("А4", "", 5), "page1_img2.png": ("А1", "подпись", 6)}
    assert res.unplaced_tables.count() == 0
    assert res.problems.count() == 0


def test_write_and_evaluate(spark):
    import tempfile

    from lectern.build import write_records
    from lectern.operators import scoring as SC
    from lectern.sources import readers
    docs = spark.createDataFrame([("t", "phy", "2023", "rus", "test"), ("c", "phy", "2023", None, "consult")],
                                 "doc_id string, subject string, year string, language string, kind string")
    pages = spark.createDataFrame([("t", 1, "Часть А\nА1. Question 1\nА2. Question 2\nЧасть В\nВ1. Question 3")],
                                  "doc_id string, page_no int, text string")
    blocks = spark.createDataFrame(
        [("c", 1, i, 141.0, 10.0 * i, 0.0, 0.0, f"{q}. x\nОтвет: {a}") for i, (q, a) in enumerate(
            [("А1", "1"), ("А2", "2"), ("В1", "42")])],
        "doc_id string, page_no int, block_no int, x0 double, y0 double, x1 double, y1 double, text string")
    res = build_records(spark, ExamInputs(docs, pages, blocks), "canary")
    path = tempfile.mkdtemp(prefix="lectern-ds-") + "/data"
    write_records(spark, res, path)
    back = readers.read_records(spark, path)
    assert sorted(r.id for r in back.collect()) == ["03-phy-2023-rus-A1", "03-phy-2023-rus-A2", "03-phy-2023-rus-B1"]
    comp = spark.createDataFrame([("03-phy-2023-rus-A1", "m", "ANSWER: 1"), ("03-phy-2023-rus-A2", "m", "ANSWER: 3"),
                                  ("03-phy-2023-rus-B1", "m", "so ANSWER: 42")], "id string, model string, completion string")
    _, table = SC.evaluate(back, comp)
    (row,) = table.collect()
    assert row.questions == 3 and abs(row.weighted_accuracy - 3 / 4) < 1e-12


def test_build_keeps_exams_apart(spark):
    docs = spark.createDataFrame(
        [("p-rus", "phy", "2023", "rus", "test"), ("p-c", "phy", "2023", None, "consult"),
         ("g-rus", "geo", "2024", "rus", "test"), ("g-bel", "geo", "2024", "bel", "test"),
         ("g-c", "geo", "2024", None, "consult")],
        "doc_id string, subject string, year string, language string, kind string")
    pages = spark.createDataFrame([("p-rus", 1, "Часть А\nА1. физика"), ("g-rus", 1, "Часть А\nА1. география"),
                                   ("g-bel", 1, "Частка А\nА1. геаграфія")], "doc_id string, page_no int, text string")
    blocks = spark.createDataFrame(
        [("p-c", 1, 0, 141.0, 10.0, 0.0, 0.0, "А1. x\nОтвет: 3"), ("g-c", 1, 0, 141.0, 10.0, 0.0, 0.0, "А1. y\nОтвет: 5")],
        "doc_id string, page_no int, block_no int, x0 double, y0 double, x1 double, y1 double, text string")
    images = spark.createDataFrame([("g-rus", 1, 1, "png", b"g", 0.0, 0.0, 1.0, 1.0)],
                                   "doc_id string, page_no int, img_no int, format string, content binary, "
                                   "x0 double, y0 double, x1 double, y1 double")
    pmap = spark.createDataFrame([("geo", "2024", 1, "А1")], "subject string, year string, position int, question_id string")
    res = build_records(spark, ExamInputs(docs, pages, blocks, images), "c", Profiles(position_map=pmap))
    got = {r.id: (r.target, len(r.input[1].content)) for r in res.records.collect()}
    assert got == {"03-phy-2023-rus-A1": ("3", 1), "13-geo-2024-rus-A1": ("5", 2), "13-geo-2024-bel-A1": ("5", 2)}
    assert sorted((r.doc_id, r.problem) for r in res.problems.collect()) == [("p-rus", "no images")]
