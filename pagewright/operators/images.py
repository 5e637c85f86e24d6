"""Image files of pages as tables: inventory, what is missing, where a name is found, new references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The folders under a base folder where an image is looked for, in this order.
PLACES = ("", "extracted_html/", "assets/")
LIKE_IMAGES = r"(?i)\.(png|jpg|jpeg|gif)$"
SRC = r"""(<img\b[^>]*?\bsrc=["'])([^"']*)(["'])"""


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]*)$", 1)


def parent(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def inventory(files: DataFrame) -> DataFrame:
    """name, path of the image files among files (path, file_no): .png and .jpg alone, in this case;
    the last path of a name counts."""
    images = files.withColumn("name", base_name(F.col("path"))).filter(F.col("name").rlike(r"\.(png|jpg)$"))
    return images.groupBy("name").agg(F.max_by("path", "file_no").alias("path"))


def references(pages: DataFrame) -> DataFrame:
    """doc_id, name of the files that images of pages (doc_id, html) refer to, once each."""
    sources = F.regexp_extract_all("html", F.lit(SRC), F.lit(2))
    return pages.select("doc_id", F.explode(F.array_distinct(F.transform(sources, base_name))).alias("name")).filter("name <> ''")


def missing(wanted: DataFrame, target: DataFrame, known: DataFrame, fill: bool = False) -> DataFrame:
    """doc_id, name, path: the references without a file in target (name), and the file of that name
    in the inventory, if there is one; with fill, else the inventory's first file by name."""
    absent = wanted.join(target.select("name").distinct(), "name", "left_anti").join(known, "name", "left")
    if not fill:
        return absent.select("doc_id", "name", "path")
    any_file = known.agg(F.min_by("path", "name").alias("first_path"))
    return absent.join(F.broadcast(any_file), how="left").select("doc_id", "name", F.coalesce("path", "first_path").alias("path"))


def resolved(wanted: DataFrame, bases: DataFrame, files: DataFrame) -> DataFrame:
    """name, path: where each name of wanted (name) is among files (path). First the usual places
    under each of bases (base, base_no; the few folders to search), then any place below one, then an
    image file below one whose name begins alike. Only bases are broadcast: Spark takes files and names
    for small by their estimated size, which knows nothing of how long texts are."""
    f = files.withColumn("file_name", base_name(F.col("path")))
    b = bases.withColumn("base", F.regexp_replace("base", "/+$", ""))
    places = F.array(*[F.concat("base", F.lit(f"/{p}")) for p in PLACES], F.concat(parent(F.col("base")), F.lit("/assets/")))
    spots = b.select("base_no", F.posexplode(places).alias("place_no", "folder"))
    usual = f.withColumn("folder", F.concat(parent(F.col("path")), F.lit("/"))).join(F.broadcast(spots), "folder").select("path", "file_name", F.lit(0).alias("way"), "base_no", "place_no")
    # every folder above a file, to meet its base by an equi join
    parts = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    below = f.withColumn("base", F.explode(above)).join(F.broadcast(b), "base").select("path", "file_name", F.lit(1).alias("way"), "base_no", F.lit(0).alias("place_no"))
    names = wanted.select("name").distinct()
    rank = F.struct("way", "base_no", "place_no", "path")
    exact = usual.unionByName(below).groupBy(F.col("file_name").alias("name")).agg(F.min_by("path", rank).alias("path"))
    found = names.join(exact.hint("merge"), "name", "left")
    stem = F.regexp_replace("name", r"\.[^.]*$", "")
    rest = found.filter("path is null").select("name", stem.alias("stem"))
    # names that begin alike meet by their first letters; of the files under a stem, one is kept before the join
    starts = F.transform(F.sequence(F.lit(1), F.length("file_name")), lambda n: F.substring("file_name", F.lit(1), n))
    alike = below.filter(F.col("file_name").rlike(LIKE_IMAGES)).withColumn("stem", F.explode(starts))
    alike = alike.groupBy("stem").agg(F.min_by("path", F.struct("base_no", "path")).alias("path"))
    similar = rest.join(alike.hint("merge"), "stem", "left").select("name", "path")
    return found.filter("path is not null").unionByName(similar)


def image_folder(bases: DataFrame, folders: DataFrame) -> DataFrame:
    """base, folder: the first of six usual folders that is among folders (folder), else the base
    itself if it is one, else the folder above it. A base is a page's file or a folder."""
    up = parent(F.col("base"))
    join = lambda head, tail: F.when(head == "", F.lit(tail)).otherwise(F.concat(head, F.lit(f"/{tail}")))
    spots = F.array(join(up, "images"), join(F.col("base"), "images"), join(up, "assets"), join(parent(up), "images"), join(parent(up), "assets"), join(up, "extracted_html"))
    known = folders.select("folder").distinct()
    found = bases.select("base", F.posexplode(spots).alias("no", "folder")).join(known, "folder").groupBy("base").agg(F.min_by("folder", "no").alias("found"))
    own = known.select(F.col("folder").alias("base"), F.lit(True).alias("is_folder"))
    return bases.join(found, "base", "left").join(own, "base", "left").select("base", F.coalesce("found", F.when(F.col("is_folder"), F.col("base")), up).alias("folder"))


def rewritten(pages: DataFrame, mapping: DataFrame) -> DataFrame:
    """pages (doc_id, html) with the sources of images replaced where mapping (name, path) has their
    file name. A page's part of the mapping comes to it as one map."""
    own = references(pages).join(mapping, "name").groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("name", "path"))).alias("m"))
    split = F.regexp_replace("html", SRC, "$1\x00$2\x00$3")  # odd parts are sources
    parts = F.transform(F.split(split, "\x00", -1), lambda x, i: F.when(i % 2 == 1, F.coalesce(F.col("m")[base_name(x)], x)).otherwise(x))
    return pages.join(own, "doc_id", "left").select("doc_id", F.when(F.col("m").isNull(), F.col("html")).otherwise(F.array_join(parts, "")).alias("html"))


def figure_sources(figures: DataFrame, images: DataFrame) -> DataFrame:
    """doc_id, element_id, expected: for the images (doc_id, element_id, src, and if it is told, html) of
    layout figures (doc_id, id, type, sub_type, crop_images, and html) the file that should be their
    source, where it is not. A figure whose id no image has is found by its first element's markup,
    identical but for what stands between the elements in it."""
    wanted = figures.filter("type = 'FIGURE' and sub_type in ('IMAGE', 'DIAGRAM') and size(crop_images) > 0")
    stem = F.regexp_replace(base_name(F.col("crop_images")[0]), r"\.[^.]*$", "")
    markup = [same_markup(F.col("html")).alias("markup")] if "html" in figures.columns else []
    expected = wanted.select("doc_id", F.col("id").alias("element_id"), F.concat(stem, F.lit(".png")).alias("expected"), *markup)
    found = images.join(expected.drop("markup"), ["doc_id", "element_id"])
    if markup and "html" in images.columns:
        lost = expected.join(images.select("doc_id", "element_id"), ["doc_id", "element_id"], "left_anti").filter("markup <> ''")
        alike = images.drop("element_id").withColumn("markup", same_markup(F.col("html"))).join(lost, ["doc_id", "markup"])
        found = found.unionByName(alike.select(*found.columns))
    return found.filter(base_name(F.col("src")) != F.col("expected")).select("doc_id", "element_id", "expected")


def same_markup(html: Column) -> Column:
    """Markup in a form in which quotes, the case of tag names, and white space in and between tags make
    no difference."""
    bare = F.regexp_replace(F.trim(html), r"\s+", " ")
    bare = F.regexp_replace(F.regexp_replace(bare, r"> <", "><"), r"\s*/?>", ">")
    return F.replace(bare, F.lit("'"), F.lit('"'))


def copied_pages(copies: DataFrame) -> DataFrame:
    """copied: files copied over all pages of (page, copied)."""
    return copies.agg(F.coalesce(F.sum("copied"), F.lit(0)).alias("copied"))
