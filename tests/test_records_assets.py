"""Record assembly (J1, J2, P1-P9, V2, V3) and image operators."""

import json

from pyspark.sql import functions as F

from lectern import dims
from lectern.operators import assets as AS
from lectern.operators import records as R


def _records(spark):
    exams = spark.createDataFrame([("t-rus", "phy", "2023", "rus"), ("t-bel", "phy", "2023", "bel")],
                                  "doc_id string, subject string, year string, language string")
    qs = spark.createDataFrame(
        [("t-rus", "А", "А1", 3, "Question 1"), ("t-bel", "А", "В1", 4, "under A")]
        + [(d, "В", "В3", 9, "Question 3") for d in ("t-rus", "t-bel")]
        + [("t-rus", "В", "В9", 12, "no answer")],
        "doc_id string, section string, question_id string, pos int, text string")
    info = spark.createDataFrame([(d, s, f"General info {s}") for d in ("t-rus", "t-bel") for s in ("А", "В")],
                                 "doc_id string, section string, general_info string")
    ans = spark.createDataFrame([("phy", "2023", "А1", "1", "Comment 1"), ("phy", "2023", "В1", "ПОЛИТИКА", "c"),
                                 ("phy", "2023", "В3", "ДРУГОЕ", "c3")],
                                "subject string, year string, question_id string, answer string, comment string")
    imgs = spark.createDataFrame([("phy", "2023", "А1", 1, 1, "data:image/png;base64,iVBORw0KG==")],
                                 "subject string, year string, question_id string, page_no int, img_no int, image_url string")
    return exams, qs, info, ans, imgs


def test_records(spark):
    exams, qs, info, ans, imgs = _records(spark)
    rec = R.assemble_records(spark, exams, qs, info, ans, imgs, "uuid")
    rows = {r.id: json.loads(r.j) for r in rec.select("id", F.to_json(F.struct("input", "target", "id", "metadata")).alias("j")).collect()}
    a1 = rows["03-phy-2023-rus-A1"]
    assert a1["target"] == "1" and a1["metadata"]["section"] == "A" and a1["metadata"]["points"] == 1
    assert a1["metadata"]["canary"] == "uuid" and a1["metadata"]["subject"] == "phy"
    assert len(a1["input"][1]["content"]) == 2 and a1["input"][1]["content"][1] == {
        "type": "image", "image": "data:image/png;base64,iVBORw0KG=="}
    assert a1["input"][0]["content"][0]["text"] == "General info А\n" + dims.LETTER_EXAMPLES[0][1]
    assert dims.LETTER_EXAMPLES[0][1][0] == "O"          # Latin O
    assert rows["03-phy-2023-rus-B3"]["metadata"]["points"] == 2
    assert rows["03-phy-2023-bel-A1"]["metadata"]["points"] == 1           # В1 stored under А
    assert rows["03-phy-2023-bel-A1"]["target"] == "ПАЛІТЫКА"               # translated for bel
    assert rows["03-phy-2023-bel-B3"]["target"] == "ДРУГОЕ"                 # not in the dictionary
    assert len(rows["03-phy-2023-bel-A1"]["input"][1]["content"]) == 1
    assert not any(k.endswith("B9") for k in rows)
    rep = R.validation_report(exams, qs, ans, imgs).collect()
    assert [(r.doc_id, r.question_id, r.problem) for r in rep] == [("t-rus", "В9", "no answer")]


def test_positions_past_the_list(spark):
    imgs = spark.createDataFrame([("geo", "2023", 1 + i // 4, 1 + i % 4) for i in range(28)],
                                 "subject string, year string, page_no int, img_no int")
    out = AS.assign_by_position(imgs, dims.geo_2023_position_map(spark), ["subject", "year"])
    got = {r.position: r.question_id for r in out.collect()}
    assert got[1] == "А4" and got[26] == "В20" and got[27] is None and got[28] is None


def test_nearby_margin(spark):
    images = spark.createDataFrame([(1, 1, 7, 100.0, 100.0, 200.0, 200.0)],
                                   "doc_id int, page_no int, img_id int, x0 double, y0 double, x1 double, y1 double")
    spans = spark.createDataFrame([(1, 1, 1, 85.0, 150.0, 85.0, 150.0, "near"), (1, 1, 2, 75.0, 150.0, 75.0, 150.0, "far"),
                                   (1, 2, 3, 150.0, 150.0, 150.0, 150.0, "other page")],
                                  "doc_id int, page_no int, span_id int, x0 double, y0 double, x1 double, y1 double, text string")
    for grid in (7.0, 64.0, 1000.0):
        assert [r.nearby_text for r in AS.nearby_text(images, spans, grid=grid).collect()] == ["near"]


def test_override_and_share(spark):
    imgs = AS.describe(spark.createDataFrame([("d", 1, 1, "png", b"old-bytes")],
                                             "doc_id string, page_no int, img_no int, format string, content binary"))
    edited = spark.createDataFrame([("d", "page1_img1.png", b"new")], "doc_id string, filename string, content binary")
    r = AS.override_images(imgs, edited).first()
    assert r.image_url == "data:image/png;base64,bmV3" and r.size == 3
    assert AS.override_images(imgs, edited, keep_original_size=True).first().size == 9
    exams = spark.createDataFrame([("r", "rus", "geo"), ("b", "bel", "geo")], "doc_id string, language string, subject string")
    img = spark.createDataFrame([("r", "page1_img1.png")], "doc_id string, filename string")
    got = sorted((x.doc_id, x.filename) for x in AS.shared_images(exams, img, ["subject"]).collect())
    assert got == [("b", "page1_img1.png"), ("r", "page1_img1.png")]


def test_numbering_chunk_invariance(spark):
    from support import SF_SMALL
    from lectern.plans import asset_queries as AQ
    a = sorted(map(tuple, AQ.q_assign_by_position(spark, SF_SMALL).collect()))
    b = sorted(map(tuple, AQ.q_assign_by_position(spark, SF_SMALL, img_chunk=2).collect()))
    assert a == b and len(a) > 0


def test_nearby_grids_agree(spark):
    from support import SF_SMALL
    from lectern.plans import asset_queries as AQ
    images, spans = AQ._emb_boxes(spark, SF_SMALL)
    a = sorted(map(tuple, AS.nearby_text(images, spans).collect()))
    b = sorted(map(tuple, AS.nearby_text(images, spans, grid=0.5).collect()))
    c = sorted(map(tuple, AS.nearby_text(images, spans, grid=5.0).collect()))
    assert a == b == c and any(r[3] for r in a)


def test_nearby_boxes_of_every_size_meet_their_spans(spark):
    import random

    r = random.Random(11)
    images = [(1, r.randint(1, 2), i, *(lambda x, y, w: (x, y, x + w, y + w * r.random()))(
        r.uniform(-500, 500), r.uniform(-500, 500), 10 ** r.uniform(-1, 4))) for i in range(60)]
    spans = [(1, r.randint(1, 2), i, *(lambda x, y: (x, y, x + r.uniform(0, 30), y + 5.0))(
        r.uniform(-3000, 3000), r.uniform(-3000, 3000)), f"s{i}") for i in range(600)]
    box = "doc_id int, page_no int, {} int, x0 double, y0 double, x1 double, y1 double"
    got = {(x.img_id, x.span_id) for x in AS.near_pairs(spark.createDataFrame(images, box.format("img_id")),
                                                        spark.createDataFrame(spans, box.format("span_id") + ", text string")).collect()}
    want = {(i[2], s[2]) for i in images for s in spans if i[1] == s[1] and s[3] >= i[3] - 20 and s[5] <= i[5] + 20
            and s[4] >= i[4] - 20 and s[6] <= i[6] + 20}
    assert got == want and len(want) > 100
