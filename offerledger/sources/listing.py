"""Seed lists and sitemaps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerledger.functions import text as T
from offerledger.operators.matching import PRIORITIES


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """The priority list from CSV, normalised; `ordinal` is the place in the file."""
    return seed_rows(spark.read.option("header", True).option("multiLine", True).csv(path).withColumn("ordinal", F.monotonically_increasing_id()))


def seed_rows(raw: DataFrame) -> DataFrame:
    """Rows of a seed table with headers in any case: slug, name, domain, category, priority, search_volume.

    Rows without slug or merchant go; an unknown priority and a volume that isn't all digits are null.
    """
    df = raw.toDF(*(c.strip().lstrip("﻿").lower() for c in raw.columns))
    have = set(df.columns)
    cell = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) if c in have else F.lit("")
    filled = lambda c: F.nullif(cell(c), F.lit(""))
    volume = F.regexp_replace(cell("volume"), "[  ]", "")
    rows = df.where((cell("slug") != "") & (cell("marchand") != ""))
    return rows.select(
        "ordinal",
        T.slugify(cell("slug")).alias("slug"),
        cell("marchand").alias("name"),
        F.coalesce(T.domain_key(filled("domaine")), filled("domaine")).alias("domain"),
        filled("categorie").alias("category"),
        F.when(F.upper(cell("prio")).isin(*PRIORITIES), F.upper(cell("prio"))).alias("priority"),
        F.when(volume.rlike("^[0-9]+$"), volume.try_cast("int")).alias("search_volume"),
    )


def read_sitemap(spark: SparkSession, path: str) -> DataFrame:
    """loc, lastmod of each entry; namespaces are ignored, lastmod stays text."""
    return spark.read.format("xml").option("rowTag", "url").schema("loc string, lastmod string").load(path)


def sitemap_entries(pages: DataFrame, xml: str = "xml") -> DataFrame:
    """loc, lastmod, ordinal of the entries of sitemaps held in a column."""
    entry = r"(?is)<url>(.*?)</url>"
    tag = lambda name: F.nullif(F.regexp_extract("entry", rf"(?is)<{name}>\s*([^<]+?)\s*</{name}>", 1), F.lit(""))
    rows = pages.select(F.posexplode(F.regexp_extract_all(F.col(xml), F.lit(entry), F.lit(1))).alias("ordinal", "entry"))
    return rows.select("ordinal", tag("loc").alias("loc"), tag("lastmod").alias("lastmod")).where("loc is not null")


def listing_a(entries: DataFrame, path: str = "/code-promo/") -> DataFrame:
    """Platform A: merchant pages by their path; the slug is the last part of the address."""
    slug = F.regexp_extract(F.regexp_replace("loc", "/+$", ""), "([^/]+)$", 1)
    rows = entries.where(F.col("loc").contains(path)).withColumn("raw_slug", slug).where("raw_slug <> ''")
    return rows.select(F.lit("a").alias("provider"), "ordinal", "raw_slug", T.title_from_slug(F.col("raw_slug")).alias("raw_name"), F.col("loc").alias("raw_url"), "lastmod")


def listing_b(entries: DataFrame) -> DataFrame:
    """Platform B: addresses that end in /reduction-<slug>-<number>; the number stays in the slug."""
    pattern = r"/reduction-(.+)-([0-9]+)/?$"
    slug, number = F.regexp_extract("loc", pattern, 1), F.regexp_extract("loc", pattern, 2)
    return entries.where(F.col("loc").rlike(pattern)).select(F.lit("b").alias("provider"), "ordinal", F.concat_ws("-", slug, number).alias("raw_slug"), T.title_from_slug(slug).alias("raw_name"), F.col("loc").alias("raw_url"), F.lit(None).cast("string").alias("lastmod"))
