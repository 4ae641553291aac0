"""Queries of the problems on texts and names, each over its whole tables, and their SQL where there is any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlens.llm import encode, names, packing, sentences
from harborlens.session import cut
from harborlens.sources.tables import table

CAPACITY = 2048


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return names.pairs(cut(names.link(table(spark, folder, "observations"), ["org", "isp"])))


def p1_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """Each spelling with the least spelling of its body, and how many the body has."""
    linked = cut(names.link(table(spark, folder, "observations"), ["org", "isp"]))
    each = linked.groupBy("body").agg(F.min("name").alias("body_name"), F.count(F.lit(1)).alias("n_spellings"))
    return linked.join(each, "body").select("name", "body_name", "n_spellings")


def _letters(spark: SparkSession, folder: str) -> DataFrame:
    """block, core: the distinct names of org and isp in plain letters and digits, as one block."""
    spelt = names.spellings(table(spark, folder, "observations"), ["org", "isp"])
    return spelt.select(F.lit("all").alias("block"), F.regexp_replace(F.lower("name"), "[^a-z0-9]", "").alias("core")).where("core <> ''").distinct()


def p1_radius(spark: SparkSession, folder: str) -> DataFrame:
    """The radius join alone: every two of the plain names that are within the radius, with their distance."""
    points = cut(_letters(spark, folder))
    return names.radius_join(points, points).select("core", "other", F.col("d").cast("bigint").alias("d"))


def p1_components(spark: SparkSession, folder: str) -> DataFrame:
    """Each of the plain names that any other is within the radius of, with the least name of its component."""
    points = cut(_letters(spark, folder))
    return names.components(cut(names.radius_join(points, points).select("block", "core", "other"))).select("core", "root")


def _documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", *columns)


def p8_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode.encode(_documents(spark, folder, "text"))


def p9_pack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(encode.token_counts(_documents(spark, folder, "text")), CAPACITY)


def p9_fill(spark: SparkSession, folder: str) -> DataFrame:
    """One row: containers, tokens, and how full the containers are."""
    placed = p9_pack(spark, folder).where("container_id is not null")
    return placed.agg((F.max("container_id") + 1).alias("containers"), F.sum("n_tokens").alias("tokens"), F.round(F.sum("n_tokens") / (F.max("container_id") + 1) / CAPACITY, 6).alias("fill"))


def p9_invariants(spark: SparkSession, folder: str) -> DataFrame:
    """One row: documents placed, those whose pieces don't add up to their tokens or are cut without need, and containers too full or with overlapping items."""
    counts = cut(encode.token_counts(_documents(spark, folder, "text")))
    placed = cut(packing.pack(counts, CAPACITY))
    whole = placed.groupBy("doc_id").agg(F.sum("n_tokens").alias("packed"), F.count(F.lit(1)).alias("n_pieces"))
    wrong = F.coalesce(F.col("packed"), F.lit(-1)) != F.col("n_tokens")
    needless = F.col("n_pieces") > F.greatest(F.ceil(F.col("n_tokens") / CAPACITY), F.lit(1))
    documents = counts.join(whole, "doc_id", "full").agg(F.count_if(F.col("packed").isNotNull()).alias("documents"), F.count_if(wrong).alias("wrong_sums"), F.count_if(needless).alias("needless_cuts"))
    held = placed.where("container_id is not null").groupBy("container_id").agg(F.sum("n_tokens").alias("tokens"), F.max(F.col("offset") + F.col("n_tokens")).alias("upto"), F.count_distinct("offset").alias("places"), F.count(F.lit(1)).alias("items"))
    containers = held.agg(F.count_if(F.col("tokens") > CAPACITY).alias("too_full"), F.count_if((F.col("tokens") != F.col("upto")) | (F.col("places") != F.col("items"))).alias("overlapping"))
    return documents.withColumns({c: containers.select(c).scalar() for c in ("too_full", "overlapping")})


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return sentences.sentences(_documents(spark, folder, "text", "lang"))


QUERIES = {f.__name__: f for f in (p1_found, p1_bodies, p1_radius, p1_components, p8_ids, p9_pack, p9_fill, p9_invariants, p10_found)}

_RADIUS = """n as (select org as name from observations union select isp from observations),
c as (select distinct regexp_replace(lower(name), '[^a-z0-9]', '', 'g') as core from n where name is not null),
l as (select a.core, b.core as other, levenshtein(a.core, b.core) as d from c a join c b on a.core <> b.core and a.core <> '' and b.core <> '' and abs(length(a.core) - length(b.core)) <= 2
    where levenshtein(a.core, b.core) <= least(2, least(length(a.core), length(b.core)) // 3))"""

ORACLE: dict[str, str] = {
    "p1_radius": f"with {_RADIUS} select core, other, d from l",
    "p1_components": f"with recursive {_RADIUS}, r(core, node) as (select distinct core, core from l union select r.core, l.other from r join l on l.core = r.node) select core, min(node) as root from r group by core",
    "p9_invariants": "select count(*) as documents, 0::bigint as wrong_sums, 0::bigint as needless_cuts, 0::bigint as too_full, 0::bigint as overlapping from documents",
}
