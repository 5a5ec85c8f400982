"""Registered queries for images and assets (J3, J4, J6, J7, J9, U1, W5, P16-P18), with oracles."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lectern.operators import assets as AS
from lectern.plans.tables import table

# -------------------------------------------------------------- nearby_text
# embeddings as one document: label = page; image box from components 1-4
# (corner = first two x 1000, size = |third|, |fourth| x 500); the span of the
# same vector is the point given by components 5 and 6 x 1000.


def _emb_boxes(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")

    def comp(i):
        return F.element_at("embedding", i).cast("double")
    images = e.select(F.lit(0).alias("doc_id"), F.col("label").alias("page_no"), F.col("vec_id").alias("img_id"),
                      (comp(1) * 1000).alias("x0"), (comp(2) * 1000).alias("y0"),
                      (comp(1) * 1000 + F.abs(comp(3)) * 500).alias("x1"),
                      (comp(2) * 1000 + F.abs(comp(4)) * 500).alias("y1"))
    spans = e.select(F.lit(0).alias("doc_id"), F.col("label").alias("page_no"), F.col("vec_id").alias("span_id"),
                     (comp(5) * 1000).alias("x0"), (comp(6) * 1000).alias("y0"),
                     (comp(5) * 1000).alias("x1"), (comp(6) * 1000).alias("y1"),
                     F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("text"))
    return images, spans


def q_nearby_text(spark: SparkSession, sf_dir: str, grid: float = AS.GRID):
    images, spans = _emb_boxes(spark, sf_dir)
    return AS.nearby_text(images, spans, grid=grid).select(
        F.col("page_no").alias("label"), F.col("img_id").alias("vec_id"), "nearby_text")


def sql_nearby_text() -> str:
    c = "CAST(embedding[{}] AS DOUBLE)"
    return f"""
    WITH im AS (SELECT label, vec_id, {c.format(1)} * 1000 - 20 AS gx0, {c.format(2)} * 1000 - 20 AS gy0,
                       {c.format(1)} * 1000 + abs({c.format(3)}) * 500 + 20 AS gx1,
                       {c.format(2)} * 1000 + abs({c.format(4)}) * 500 + 20 AS gy1 FROM embeddings),
         sp AS (SELECT label, vec_id, {c.format(5)} * 1000 AS x, {c.format(6)} * 1000 AS y FROM embeddings)
    SELECT im.label, im.vec_id,
           coalesce(string_agg('v' || CAST(sp.vec_id AS VARCHAR), chr(10) ORDER BY sp.y, sp.x, sp.vec_id), '') AS nearby_text
    FROM im LEFT JOIN sp ON sp.label = im.label AND sp.x >= im.gx0 AND sp.x <= im.gx1
                        AND sp.y >= im.gy0 AND sp.y <= im.gy1
    GROUP BY im.label, im.vec_id"""


# ------------------------------------------------------- assign_by_position
# embeddings as images of the exam `label`, page vec_id div 10, image
# vec_id % 10; a 26-entry position map (position n -> "Q<7n mod 26 + 1>").

def q_assign_by_position(spark: SparkSession, sf_dir: str, img_chunk: int = AS.IMG_CHUNK):
    e = table(spark, sf_dir, "embeddings")
    images = e.select("vec_id", "label", F.floor(F.col("vec_id") / 10).alias("page_no"),
                      (F.col("vec_id") % 10).alias("img_no"))
    pmap = spark.range(1, 27).select(F.col("id").cast("int").alias("position"),
                                     F.concat(F.lit("Q"), ((F.col("id") * 7) % 26 + 1).cast("string")).alias("question_id"))
    numbered = AS.number_images(images, ["label"], img_chunk=img_chunk)
    out = AS.assign_by_position(numbered, pmap, ["label"], map_keys=[])
    return out.select("vec_id", "label", F.col("position").cast("bigint").alias("position"), "question_id")


def sql_assign_by_position() -> str:
    return """
    SELECT i.vec_id, i.label, i.position, m.question_id
    FROM (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id // 10, vec_id % 10) AS position
          FROM embeddings) i
    LEFT JOIN (SELECT CAST(i AS INTEGER) AS position, 'Q' || CAST((i * 7) % 26 + 1 AS VARCHAR) AS question_id
               FROM range(1, 27) t(i)) m ON m.position = i.position"""


# ----------------------------------------------------------- asset_override
# parts as images of their brand (page 1, image = partkey, bytes = name);
# parts whose size is a multiple of 4 have an edited copy "<name>_edit.png"
# holding the type.

def _part_images(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    imgs = AS.describe(p.select(F.col("p_brand").alias("doc_id"), F.lit(1).alias("page_no"),
                                F.col("p_partkey").alias("img_no"), F.lit("png").alias("format"),
                                F.encode("p_name", "UTF-8").alias("content")))
    edit_path = F.format_string("data/%s/page1_img%d_edit.png", F.col("p_brand"), F.col("p_partkey"))
    edited = p.where(F.col("p_size") % 4 == 0).select(F.col("p_brand").alias("doc_id"),
                                                       AS.edited_key(edit_path).alias("filename"),
                                                       F.encode("p_type", "UTF-8").alias("content"))
    return imgs, edited


def q_asset_override(spark: SparkSession, sf_dir: str):
    imgs, edited = _part_images(spark, sf_dir)
    out = AS.override_images(imgs.drop("content"), edited)
    return out.select(F.col("img_no").alias("p_partkey"), "filename", "image_url", "size",
                      F.col("original_size").alias("size_kept"), "edited")


def sql_asset_override() -> str:
    return """
    SELECT p_partkey, 'page1_img' || CAST(p_partkey AS VARCHAR) || '.png' AS filename,
           'data:image/png;base64,' || to_base64(encode(CASE WHEN p_size % 4 = 0 THEN p_type ELSE p_name END)) AS image_url,
           CAST(octet_length(encode(CASE WHEN p_size % 4 = 0 THEN p_type ELSE p_name END)) AS INTEGER) AS size,
           CAST(octet_length(encode(p_name)) AS INTEGER) AS size_kept,
           p_size % 4 = 0 AS edited
    FROM part"""


# ------------------------------------------------------------ shared_assets
# nations as exams in both languages (J7); the images belong to the Russian
# exam (one per customer of the nation, bytes = customer name); the
# Belarusian exam uses them too (J9); the two language outputs are unioned.

def q_shared_assets(spark: SparkSession, sf_dir: str):
    n = table(spark, sf_dir, "nation")
    exams = n.select("n_nationkey", F.posexplode(F.array(F.lit("rus"), F.lit("bel"))).alias("li", "language")) \
        .select((F.col("n_nationkey") * 10 + F.col("li")).alias("doc_id"), "language", "n_nationkey")
    c = table(spark, sf_dir, "customer")
    images = AS.describe(c.select((F.col("c_nationkey").cast("bigint") * 10).alias("doc_id"), F.lit(1).alias("page_no"),
                                  F.col("c_custkey").alias("img_no"), F.lit("png").alias("format"),
                                  F.encode("c_name", "UTF-8").alias("content"))).drop("content")
    shared = AS.shared_images(exams.withColumn("doc_id", F.col("doc_id").cast("bigint")), images, ["n_nationkey"])
    per = shared.groupBy("n_nationkey", "language").agg(
        F.count(F.lit(1)).alias("n_images"), F.min_by("image_url", "img_no").alias("first_url"))
    rus = per.where(F.col("language") == "rus")
    bel = per.where(F.col("language") == "bel")
    return rus.unionByName(bel)


def sql_shared_assets() -> str:
    return """
    SELECT n_nationkey, l.language, count(*) AS n_images,
           arg_min('data:image/png;base64,' || to_base64(encode(c_name)), c_custkey) AS first_url
    FROM nation JOIN customer ON c_nationkey = n_nationkey, (VALUES ('rus'), ('bel')) AS l(language)
    GROUP BY n_nationkey, l.language"""


# --------------------------------------------------------------- image_uri
# document text bytes as images: page 1 + doc_id div 100, image 1 + doc_id % 100,
# png for English, jpeg otherwise.

def q_image_uri(spark: SparkSession, sf_dir: str):
    d = table(spark, sf_dir, "documents")
    imgs = d.select("doc_id", (F.floor(F.col("doc_id") / 100) + 1).cast("int").alias("page_no"),
                    (F.col("doc_id") % 100 + 1).cast("int").alias("img_no"),
                    F.when(F.col("lang") == "en", "png").otherwise("jpeg").alias("format"),
                    F.encode("text", "UTF-8").alias("content"))
    return AS.describe(imgs).select("doc_id", "filename", "image_url", "size")


def sql_image_uri() -> str:
    fmt = "CASE WHEN lang = 'en' THEN 'png' ELSE 'jpeg' END"
    return f"""
    SELECT doc_id, 'page' || CAST(doc_id // 100 + 1 AS VARCHAR) || '_img' || CAST(doc_id % 100 + 1 AS VARCHAR) || '.' || {fmt} AS filename,
           'data:image/' || {fmt} || ';base64,' || to_base64(encode(text)) AS image_url,
           CAST(octet_length(encode(text)) AS INTEGER) AS size
    FROM documents"""


def q_saved_images(spark: SparkSession, sf_dir: str):
    """K3, K4: images of every region saved, region 1 saved again with other bytes; all are read back."""
    from lectern.session import ensure_checkpoint_dir
    from lectern.sources import sinks

    n = table(spark, sf_dir, "nation").select(
        F.col("n_regionkey").cast("string").alias("doc_id"), F.lit("geo").alias("subject"), F.col("n_regionkey").cast("string").alias("year"),
        F.concat(F.col("n_nationkey").cast("string"), F.lit(".png")).alias("filename"), F.lit("png").alias("format"),
        F.encode("n_name", "utf-8").alias("content"), F.col("n_nationkey").cast("int").alias("page_no"))
    again = n.where("doc_id = '1'").withColumn("content", F.encode(F.concat(F.lit("new "), F.decode("content", "utf-8")), "utf-8"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lectern-images-{uuid.uuid4().hex}"
    for images in (n, again):
        sinks.save_images(images, f"{path}/bytes")
        sinks.save_image_info(images.withColumn("size", F.octet_length("content")), f"{path}/info")
    saved = spark.read.parquet(f"{path}/bytes").select("doc_id", "filename", F.decode("content", "utf-8").alias("content"))
    info = spark.read.schema("doc_id string, filename string, size long").json(f"{path}/info").select("doc_id", "filename", "size")
    return saved.join(info, ["doc_id", "filename"])


def sql_saved_images() -> str:
    return """
SELECT n_regionkey::VARCHAR AS doc_id, n_nationkey || '.png' AS filename, c AS content, length(c)::BIGINT AS size
FROM (SELECT *, CASE WHEN n_regionkey = 1 THEN 'new ' ELSE '' END || n_name AS c FROM nation)"""
