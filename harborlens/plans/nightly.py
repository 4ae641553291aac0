"""One day from archive to store: gate, first of each key, projection with tiers, enrichment, partition replacement."""

from __future__ import annotations

import datetime
import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlens.operators import exposure, geo
from harborlens.session import cut
from harborlens.sources import archive, feeds, store

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Settings:
    """Where things lie and which region is wanted. Without networks the banner's own place decides."""

    archive: str
    store: str
    kev: str
    epss: str
    networks: str
    target: tuple[str, str]
    region_name: str


def gated(banners: DataFrame, networks: DataFrame, target: tuple[str, str], name: str) -> DataFrame:
    """The banners that the store keeps."""
    located = geo.locate(banners.withColumnRenamed("ip_str", "ip"), networks)
    return geo.gates(located, target, name).where("keep_store").withColumnRenamed("ip", "ip_str").select(*banners.columns)


#: Bits of an obs_id below its day: 13 for the file's task and 33 for the row in it.
DAY_SHIFT = 46


def observation_ids(banners: DataFrame) -> Column:
    """A number unique over all days that grows with the day: the day, then the place in the day's files."""
    return F.shiftleft(F.unix_date("date").cast("bigint"), DAY_SHIFT) + F.monotonically_increasing_id()


def ingest(spark: SparkSession, settings: Settings, day: str) -> dict[str, int]:
    """(Re)builds one day's partitions; the same archive gives the same partitions. Returns the rows of each table.

    The gated banners are materialised once, for three readers follow: hosts, observations and vulnerabilities.
    """
    raw = archive.read_days(spark, settings.archive, day)
    raw = raw.withColumn("rec_id", observation_ids(raw))
    rows = cut(gated(raw, feeds.networks(spark, settings.networks), settings.target, settings.region_name))
    observed = exposure.project(rows, strict=True)
    found = exposure.vulnerabilities(rows, feeds.listed(spark, settings.kev), feeds.probabilities(spark, settings.epss))
    tables = {"observations": observed.withColumnRenamed("rec_id", "obs_id"), "vulns": found}
    return {name: store.replace_day(table, f"{settings.store}/{name}", day) for name, table in tables.items()}


def run(spark: SparkSession, settings: Settings, days: list[str], keep_days: int = 0) -> dict[str, int]:
    """day -> status of every day: 0 ingested, 2 nothing kept, 1 failed; a day that fails stops none of the others.

    With keep_days, partitions older than so many days before the last one are dropped at the end. The run's own status is the
    greatest of its days'.
    """
    out = {}
    for day in days:
        try:
            out[day] = 0 if ingest(spark, settings, day)["observations"] else 2
        except Exception:
            log.exception("%s was not ingested", day)
            out[day] = 1
    if keep_days and days:
        before = str(datetime.date.fromisoformat(max(days)) - datetime.timedelta(days=keep_days))
        for name in ("observations", "vulns"):
            store.expire(spark, f"{settings.store}/{name}", before)
    return out
