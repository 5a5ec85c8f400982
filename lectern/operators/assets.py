"""Images: naming, data URIs, position assignment, replacements, sharing,
and text near an image.

S3, S5, J3, J4, J6, J9, W5, P16-P18, V6 of the survey.  Bytes (``content``)
are only touched where the URI is built; assignment and joins run on
metadata so that large binaries do not travel through shuffles twice.

Image table: doc_id, page_no, img_no, format, content BINARY, x0, y0, x1, y1
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import data_uri, image_file_name
from lectern.operators.scan import prefix_scan, row_chunks
from lectern.session import materialize, shuffled

GRID = 64.0          # cell size of the grid used by the range join
MARGIN = 20.0        # how far around an image "near" reaches
MAX_SPAN = 8         # cells that an image box spans each way at its grid level, at most
IMG_CHUNK = 4096     # images per scan chunk when numbering images


def describe(images: DataFrame) -> DataFrame:
    """File name, data URI and byte size of every image."""
    return images.select("*",
                         image_file_name("page_no", "img_no", "format").alias("filename"),
                         data_uri("content", "format").alias("image_url"),
                         F.octet_length("content").alias("size"))


def attach_uris(meta: DataFrame, images: DataFrame, keys: tuple[str, ...] = ("doc_id", "page_no", "img_no"),
                edited: DataFrame | None = None) -> DataFrame:
    """P16 + P18 (+ J6), done last: join the bytes to the (already assigned)
    image metadata and build the data URI and byte size, once per image.

    ``edited`` (doc_id, filename, content) replaces the bytes of images that
    have a question.  Which images those are is settled on keys first, so the
    replaced originals are dropped before their bytes move.
    """
    b = images.select(*keys, "content")
    if edited is not None:
        swapped = shuffled(meta.where(F.col("question_id").isNotNull()).select(*keys, "filename")).join(
            edited.select("doc_id", "filename"), ["doc_id", "filename"], "left_semi")
        swapped = materialize(meta.sparkSession, swapped, "replaced-images")
        new = shuffled(swapped).join(edited.select("doc_id", "filename", "content"), ["doc_id", "filename"]).select(*keys, "content")
        b = shuffled(b).join(swapped.select(*keys), list(keys), "left_anti").unionByName(new)
    return (shuffled(meta).join(b, list(keys))
            .withColumn("image_url", data_uri("content", "format"))
            .withColumn("size", F.octet_length("content")).drop("content"))


def number_images(images: DataFrame, exam_keys: list[str], img_chunk: int = IMG_CHUNK) -> DataFrame:
    """``position`` = 1-based rank of an image in its exam by (page, image).

    A running count through :func:`prefix_scan` with chunks of about
    ``img_chunk`` images, so an exam of very many images or image pages is
    still numbered by many tasks.
    """
    df = row_chunks(images.withColumn("_ord", F.struct("page_no", "img_no")), exam_keys, "_ord", img_chunk)
    out = prefix_scan(df, exam_keys, "_ord", "_chunk", sums={"position": F.lit(1)})
    return out.drop("_ord", "_chunk")


def assign_by_position(images: DataFrame, position_map: DataFrame, exam_keys: list[str],
                       map_keys: list[str] | None = None) -> DataFrame:
    """The n-th image of an exam gets the question listed at position n.
    Images past the end of the list keep a NULL question (they are reported,
    not dropped).  ``position_map``: map_keys (default: exam_keys) + position,
    question_id.  A map with keys grows with the exams and is shuffled, unless
    it carries a broadcast hint; one without keys (a list for all exams) is left
    to the planner."""
    numbered = images if "position" in images.columns else number_images(images, exam_keys)
    map_keys = exam_keys if map_keys is None else map_keys
    return (shuffled(numbered) if map_keys else numbered).join(position_map, map_keys + ["position"], "left")


def override_images(images: DataFrame, edited: DataFrame, keep_original_size: bool = False) -> DataFrame:
    """A replacement ``<name>_edit.<ext>`` wins over the original.

    ``images`` must carry ``filename``, ``format``, ``image_url`` and ``size``;
    ``edited``: doc_id, filename (of the original), content.  The URI uses
    the original format; ``size`` is recomputed unless ``keep_original_size``;
    ``original_size`` always keeps the size before replacement.
    """
    e = edited.select("doc_id", "filename", F.col("content").alias("_edit"))
    j = images.join(e, ["doc_id", "filename"], "left").withColumn("original_size", F.col("size"))
    url = F.when(F.col("_edit").isNotNull(), data_uri("_edit", "format")).otherwise(F.col("image_url"))
    size = F.col("size") if keep_original_size else F.coalesce(F.octet_length("_edit"), F.col("size"))
    return j.withColumn("image_url", url).withColumn("size", size).withColumn(
        "edited", F.col("_edit").isNotNull()).drop("_edit")


def edited_key(path: Column) -> Column:
    """The original file name a replacement stands for
    (``page1_img2_edit.png`` -> ``page1_img2.png``)."""
    name = F.regexp_extract(path, r"([^/]+)$", 1)
    return F.regexp_replace(name, r"_edit(\.[^.]+)$", "$1")


def shared_images(exams: DataFrame, images: DataFrame, share_keys: list[str],
                  source_language: str = "rus") -> DataFrame:
    """Every exam uses the images of the ``source_language`` exam with the
    same ``share_keys``.  ``exams``: doc_id, language, share_keys.
    ``images``: doc_id plus image columns."""
    src = exams.where(F.col("language") == source_language).select(
        F.col("doc_id").alias("_src"), *share_keys)
    imgs = images.withColumnRenamed("doc_id", "_src").join(src, "_src")
    return exams.select("doc_id", "language", *share_keys).join(imgs, share_keys).drop("_src")


def image_source_ok(path: Column) -> Column:
    """V6: an image source document must end in ``_rus`` or ``_bel``."""
    stem = F.regexp_replace(path, r"\.[^./]*$", "")
    return stem.rlike("_(rus|bel)$")


def near_pairs(images: DataFrame, spans: DataFrame, margin: float = MARGIN, grid: float = GRID) -> DataFrame:
    """Pairs (image, span) on the same page where the span's box lies in
    the image box grown by ``margin`` on every side.

    A grid range join with levels: cells of level L are ``grid * 2**L`` wide.
    An image takes the lowest level at which its grown box spans at most
    ``MAX_SPAN`` cells each way, and lists the cells it touches there; a span
    sits in one cell (by its corner) of each level that its page's images use.
    Every pair thus meets once, on (doc, page, level, cell), and the exact test
    follows; a crowded page is spread over its cells, and a wide image never
    falls back to the whole page.
    ``images``: doc_id, page_no, img_id, x0, y0, x1, y1.
    ``spans``: doc_id, page_no, span_id, x0, y0, x1, y1, text.
    """
    g = images.select("doc_id", "page_no", "img_id",
                      (F.col("x0") - margin).alias("gx0"), (F.col("y0") - margin).alias("gy0"),
                      (F.col("x1") + margin).alias("gx1"), (F.col("y1") + margin).alias("gy1"))
    side = F.greatest(F.col("gx1") - F.col("gx0"), F.col("gy1") - F.col("gy0"))
    level = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(side, F.lit(1.0)) / (grid * (MAX_SPAN - 1))))).cast("int")
    size = F.lit(grid) * F.pow(F.lit(2.0), F.col("level"))
    cell = lambda c: F.floor(F.col(c) / size)
    cells = F.flatten(F.transform(F.sequence(cell("gx0"), cell("gx1")), lambda cx: F.transform(
        F.sequence(cell("gy0"), cell("gy1")), lambda cy: F.struct(cx.alias("cx"), cy.alias("cy")))))
    # a box whose corners are swapped holds nothing
    g = g.where("gx0 <= gx1 AND gy0 <= gy1").withColumn("level", level)
    touched = g.select("*", F.inline(cells))
    levels = g.select("doc_id", "page_no", "level").distinct()
    sp = spans.select("doc_id", "page_no", "span_id", "text", F.col("x0").alias("sx0"), F.col("y0").alias("sy0"),
                      F.col("x1").alias("sx1"), F.col("y1").alias("sy1"))
    sp = shuffled(sp).join(levels, ["doc_id", "page_no"])
    sp = sp.withColumn("cx", cell("sx0")).withColumn("cy", cell("sy0"))
    inside = ((F.col("sx0") >= F.col("gx0")) & (F.col("sx1") <= F.col("gx1")) &
              (F.col("sy0") >= F.col("gy0")) & (F.col("sy1") <= F.col("gy1")))
    return (shuffled(touched).join(sp, ["doc_id", "page_no", "level", "cx", "cy"]).where(inside)
            .select("doc_id", "page_no", "img_id", "span_id", "text", "sx0", "sy0"))


def nearby_text(images: DataFrame, spans: DataFrame, margin: float = MARGIN, grid: float = GRID) -> DataFrame:
    """J4 result per image: the near spans' texts in reading order (y, x,
    span id), one per line; images without near text get ''."""
    pairs = near_pairs(images, spans, margin, grid)
    agg = pairs.groupBy("doc_id", "page_no", "img_id").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("sy0", "sx0", "span_id", "text"))), lambda s: s["text"]),
        "\n").alias("nearby_text"))
    return shuffled(images.select("doc_id", "page_no", "img_id")).join(agg, ["doc_id", "page_no", "img_id"], "left") \
        .withColumn("nearby_text", F.coalesce("nearby_text", F.lit("")))
