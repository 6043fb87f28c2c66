"""Audits of downloaded files: checksum manifests and link indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skytables.sources.digests import file_digests


def parse_manifest(lines: DataFrame, value: str = "value") -> DataFrame:
    """``checksum filename`` text lines to (filename, expected); empty lines are skipped."""
    parts = F.split(F.trim(value), r"\s+")
    return lines.where(F.trim(value) != "").select(
        F.get(parts, F.lit(1)).alias("filename"), F.get(parts, F.lit(0)).alias("expected")
    )


def hash_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(filename, md5) of the files below the folder ``path``, streamed where they are read (no size limit).

    The name is the path below the folder, so files of one name in two subfolders stay apart.
    """
    return file_digests(spark, path, glob)


def verify_manifest(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Status of each file name: ``ok``, ``mismatch``, ``missing`` (listed only) or ``extra`` (present only)."""
    status = (
        F.when(F.col("md5").isNull(), "missing")
        .when(F.col("expected").isNull(), "extra")
        .when(F.col("md5") == F.lower("expected"), "ok")
        .otherwise("mismatch")
    )
    return files.join(manifest, "filename", "full_outer").select("filename", "expected", "md5", status.alias("status"))


def url_join(base: Column, href: Column) -> Column:
    """Absolute links stay, rooted ones take the host of ``base``, others its directory."""
    return (
        F.when(href.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, "^[a-z]+:", 0), href))
        .when(href.startswith("/"), F.concat(F.regexp_extract(base, "^[a-z]+://[^/]+", 0), href))
        .otherwise(F.concat(F.regexp_replace(base, "[^/]*$", ""), href))
    )


def unquote(text: Column) -> Column:
    """Percent-decoding that leaves a plus sign, and any text that does not decode, as it is."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def extract_links(
    pages: DataFrame,
    base_url: str | None = None,
    prefix: str | None = None,
    suffix: str | None = None,
    exclude_suffix: str | None = None,
    html: str = "html",
    url: str = "url",
) -> DataFrame:
    """Links of index pages: the page columns but the text, plus href, link and file name.

    Links join to ``base_url``, or to each page's own address. Prefix and suffix filters look at the href.
    """
    base = F.col(url) if base_url is None else F.lit(base_url)
    href = F.col("href")
    found = pages.withColumn("href", F.explode(F.regexp_extract_all(html, F.lit('href="([^"]+)"'), 1)))
    if prefix:
        found = found.where(href.startswith(prefix))
    if suffix:
        found = found.where(href.endswith(suffix))
    if exclude_suffix:
        found = found.where(~href.endswith(exclude_suffix))
    return found.withColumns(
        {"link": url_join(base, href), "filename": unquote(F.element_at(F.split("href", "/"), -1))}
    ).drop(html)
