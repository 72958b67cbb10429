"""Content-addressed assets and links to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Extensions and MIME types of what is kept.
IMAGES = "png jpg jpeg gif webp svg avif".split()
IMAGE_TYPES = ["image/png", "image/jpeg", "image/gif", "image/webp", "image/svg+xml", "image/avif"]
DOCUMENTS = "pdf doc docx odt epub txt".split()
DOCUMENT_TYPES = ["application/pdf", "application/msword", "application/vnd.openxmlformats-officedocument.wordprocessingml.document", "application/vnd.oasis.opendocument.text", "application/epub+zip", "text/plain"]
IMAGE_LINK = r"!\[([^\]]*)\]\(([^)\s]+)\)"


def kind(mime: Column, ext: Column) -> Column:
    """`image`, `document` or NULL, by MIME type, else by extension."""
    e = F.lower(F.regexp_replace(ext, r"^\.", ""))
    return F.when(mime.isin(IMAGE_TYPES) | e.isin(IMAGES), "image").when(mime.isin(DOCUMENT_TYPES) | e.isin(DOCUMENTS), "document")


def stored(assets: DataFrame, most_bytes: int) -> DataFrame:
    """(hash, path, original_url, bytes, skipped_reason): assets (url, content, ext) by content; images over `most_bytes` are
    only noted, under a key made of their url. Of several urls of one content the first by name counts."""
    big = (F.octet_length("content") > most_bytes) & F.lower(F.regexp_replace("ext", r"^\.", "")).isin(IMAGES)
    x = assets.where("content IS NOT NULL").select("url", F.when(big, F.concat(F.lit("oversize:"), "url")).otherwise(F.sha2("content", 256)).alias("hash"), F.when(big, "").otherwise(store_path(F.col("content"), F.col("ext"))).alias("path"), F.octet_length("content").alias("bytes"), F.when(big, "oversize").alias("skipped_reason"))
    return x.groupBy("hash").agg(F.min("path").alias("path"), F.min("url").alias("original_url"), F.max("bytes").cast("long").alias("bytes"), F.min("skipped_reason").alias("skipped_reason"))


def store_path(content: Column, ext: Column) -> Column:
    """`_assets/<first two digits>/<sha-256>.<ext>`."""
    h = F.sha2(content, 256)
    return F.concat(F.lit("_assets/"), F.substring(h, 1, 2), F.lit("/"), h, ext)


def image_links(markdown: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(markdown, F.lit(IMAGE_LINK), F.lit(2)))


def with_local_images(docs: DataFrame, key: str, text: str, assets: DataFrame) -> DataFrame:
    """Markdown with the images that are in `assets` (original_url, path) pointing to their local copy.

    The links are exploded and joined, so no document meets more assets than it links to; longer urls are replaced first.
    """
    used = docs.select(key, F.explode(image_links(F.col(text))).alias("original_url")).join(assets.select("original_url", "path").dropDuplicates(["original_url"]), "original_url")
    swaps = used.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(F.length("original_url").alias("n"), "original_url", "path")), asc=False).alias("swaps"))  # one document's links
    swap = lambda acc, s: F.replace(acc, F.concat(F.lit("]("), s["original_url"], F.lit(")")), F.concat(F.lit("]("), s["path"], F.lit(")")))
    return docs.join(swaps, key, "left").withColumn(text, F.when(F.col("swaps").isNull(), F.col(text)).otherwise(F.aggregate("swaps", F.col(text), swap))).drop("swaps")
