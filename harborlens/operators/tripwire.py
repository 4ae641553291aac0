"""Flagged hosts: the union of selectors, and the ledger that tells new, ongoing and cleared hosts apart.

Defined cases
    * a host that was cleared and returns is ongoing, with its first_seen kept; a host is reported as cleared once.
    * last_banner_ts is that of the last run in which the host had one, even if it is older; selectors are united and sorted.
    * a run without any hit still rolls the ledger forward: its active set is empty.
    * a selector that can't be evaluated on the rows (an unknown column, a misspelt query) is skipped and named; the others stand.
    * without networks the gate keeps every hit; a ledger that is missing or can't be read is an empty one.
"""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harborlens.functions.text import given
from harborlens.operators.geo import is_place
from harborlens.session import file_system, read_text, replace_text, written

log = logging.getLogger(__name__)

LEDGER = "ip string, first_seen date, last_seen date, selectors array<string>, last_banner_ts timestamp_ntz, active boolean"


@dataclass(frozen=True)
class Selectors:
    """What flags a banner: one of the tags, one of the categories, or a free condition in SQL."""

    tags: tuple[str, ...] = ()
    categories: tuple[str, ...] = ()
    queries: tuple[str, ...] = ()

    def labelled(self) -> list[tuple[str, Column]]:
        """label, condition; in the order in which hits are merged."""
        tags = [(f"tag:{t}", F.array_contains("tags", t)) for t in self.tags]
        categories = [(f"category:{c}", F.array_contains("categories", c)) for c in self.categories]
        return tags + categories + [(q, F.expr(q)) for q in self.queries]


def from_observations(rows: DataFrame) -> DataFrame:
    """Observations as banners to select from: joined lists become arrays."""
    parts = lambda c: F.filter(F.split(F.coalesce(F.col(c), F.lit("")), ","), lambda x: x != "")
    listed = {c: parts(c) for c in ("tags", "hostnames") if c in rows.columns}
    return rows.withColumns(listed)


def from_banners(rows: DataFrame) -> DataFrame:
    """Raw banners (with date and city) as banners to select from."""
    named = rows.drop("ip").where("ip_str <> ''").withColumnsRenamed({"ip_str": "ip", "rec_id": "obs_id"})
    cves = F.coalesce(F.map_keys("vulns"), F.array().cast("array<string>"))
    return named.withColumns({"tags": given(F.col("tags")), "hostnames": given(F.col("hostnames")), "cves": cves, "banner_ts": F.col("timestamp").try_cast("timestamp_ntz")})


def matched(rows: DataFrame, selectors: Selectors) -> DataFrame:
    """The rows once per selector they match, with nth (the selector's place) and selector (its label)."""
    usable = []
    for i, (label, condition) in enumerate(selectors.labelled()):
        try:
            rows.where(condition).schema  # noqa: B018 - analysed here
        except PySparkException as e:
            log.warning("selector %s is skipped: %s", label, e.getCondition())
            continue
        usable.append(F.when(condition, F.struct(F.lit(i).alias("nth"), F.lit(label).alias("selector"))))
    none = F.array().cast("array<struct<nth:int,selector:string>>")
    found = F.array_compact(F.array(*usable)) if usable else none
    return rows.withColumn("_hit", F.explode(found)).withColumns({"nth": F.col("_hit.nth"), "selector": F.col("_hit.selector")}).drop("_hit")


def counts(rows: DataFrame, selectors: Selectors) -> DataFrame:
    """selector, n of every selector, before anything is fetched; null for one that can't be evaluated."""
    labels = rows.sparkSession.createDataFrame([(label,) for label, _ in selectors.labelled()], "selector string")
    usable = [label for label, c in selectors.labelled() if _analyses(rows, c)]
    n = matched(rows, selectors).groupBy("selector").agg(F.count(F.lit(1)).alias("n"))
    return labels.join(n, "selector", "left").withColumn("n", F.when(F.col("selector").isin(usable), F.coalesce("n", F.lit(0))))


def _analyses(rows: DataFrame, condition: Column) -> bool:
    try:
        return rows.where(condition).schema is not None
    except PySparkException:
        return False


def flagged(rows: DataFrame, selectors: Selectors, by: list[str]) -> DataFrame:
    """by, ip and the merged record of each host that a selector matches; a row counts once per selector it matches.

    rows: obs_id, ip, port, org, city, tags (an array), banner_ts, and hostnames and cves (arrays) where there are any.
    Hostnames are in order of first appearance: by selector, banner and place.
    """
    empty = F.array().cast("array<string>")
    hits = matched(rows.withColumns({c: empty for c in ("hostnames", "cves") if c not in rows.columns}), selectors)
    firsts = F.struct("nth", "obs_id")
    merged = hits.groupBy(*by, "ip").agg(
        F.array_sort(F.collect_set("selector")).alias("selectors"),
        F.array_sort(F.collect_set("port")).alias("ports"),
        F.min(F.when(F.col("org") != "", F.struct(firsts.alias("at"), "org")))["org"].alias("org"),
        F.min(F.when(F.col("city") != "", F.struct(firsts.alias("at"), "city")))["city"].alias("city"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("tags")))).alias("tags"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("cves")))).alias("cves"),
        F.max("banner_ts").alias("banner_ts"),
        F.count(F.lit(1)).alias("n_hits"),
    )
    names = hits.select(*by, "ip", firsts.alias("at"), F.posexplode("hostnames").alias("place", "hostname")).where("hostname is not null")
    names = names.groupBy(*by, "ip", "hostname").agg(F.min(F.struct("at", "place")).alias("first"))
    ordered = names.groupBy(*by, "ip").agg(F.transform(F.array_sort(F.collect_list(F.struct("first", "hostname"))), lambda x: x["hostname"]).alias("hostnames"))
    return merged.join(ordered, [*by, "ip"], "left").withColumn("hostnames", F.coalesce("hostnames", empty))


def gated(located: DataFrame, target: tuple[str, str] | None) -> DataFrame:
    """The rows that the networks or the banner place in the target; all of them where there are no networks (target None)."""
    if target is None:
        return located
    return located.where(is_place(F.col("country"), F.col("region"), target) | is_place(F.col("location.country_code"), F.col("location.region_code"), target))


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER)


@dataclass(frozen=True)
class Ledger:
    """The ledger as a table in a folder: one version a run, and a pointer that a rename sets to the version in force."""

    spark: SparkSession
    root: str

    def read(self) -> DataFrame:
        name = read_text(self.spark, f"{self.root}/CURRENT")
        try:
            return self.spark.read.schema(LEDGER).parquet(f"{self.root}/{name}") if name else empty_ledger(self.spark)
        except PySparkException:  # no table where the pointer points
            return empty_ledger(self.spark)

    def save(self, ledger: DataFrame) -> DataFrame:
        """The ledger in force, as it was saved. Versions before the last one are removed after the pointer has moved."""
        name = f"version-{uuid.uuid4().hex}"
        ledger.write.parquet(f"{self.root}/{name}")
        fs, root = file_system(self.spark, self.root)
        old = [p.getPath() for p in fs.listStatus(root) if p.getPath().getName().startswith("version-") and p.getPath().getName() != name]
        replace_text(self.spark, f"{self.root}/CURRENT", name)
        for path in old:
            fs.delete(path, True)
        return self.read()


def status(hits: DataFrame, ledger: DataFrame) -> DataFrame:
    """ip, status: new, ongoing or cleared."""
    known, now = ledger.select("ip", "active"), hits.select("ip", F.lit(True).alias("hit"))
    state = F.when(F.col("hit") & F.col("active").isNull(), "new").when(F.col("hit"), "ongoing").when(F.col("active"), "cleared")
    return known.join(now, "ip", "full").select("ip", state.alias("status")).where("status is not null")


def roll(ledger: DataFrame, hits: DataFrame, run: Column) -> DataFrame:
    """The ledger after the run."""
    now = hits.select("ip", F.col("selectors").alias("n_selectors"), F.col("banner_ts").alias("n_ts"), F.lit(True).alias("hit"))
    both = ledger.join(now, "ip", "full")
    hit = F.coalesce("hit", F.lit(False))
    none = F.array().cast("array<string>")
    return both.select(
        "ip",
        F.coalesce("first_seen", run).alias("first_seen"),
        F.when(hit, run).otherwise(F.col("last_seen")).alias("last_seen"),
        F.array_sort(F.array_union(F.coalesce("selectors", none), F.coalesce("n_selectors", none))).alias("selectors"),
        F.coalesce("n_ts", "last_banner_ts").alias("last_banner_ts"),
        hit.alias("active"),
    )


def statuses_by_run(hits: DataFrame, runs: DataFrame) -> DataFrame:
    """date, ip, status of every run at once: what rolling the ledger from run to run reports.

    hits: date, ip, distinct; runs: date of every run, with or without hits. A host's hits meet in one window, at most one a run.
    """
    numbered = runs.select("date").distinct().withColumn("run", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("date")))  # as many as the calendar has
    mine = Window.partitionBy("ip").orderBy("run")
    each = hits.select("date", "ip").join(numbered, "date").withColumns({"first": F.row_number().over(mine) == 1, "following": F.lead("run").over(mine)})
    seen = each.select("ip", "run", F.when(F.col("first"), "new").otherwise("ongoing").alias("status"))
    gone = each.where("following is null or following > run + 1").select("ip", (F.col("run") + 1).alias("run"), F.lit("cleared").alias("status"))
    return seen.unionByName(gone).join(numbered, "run").select("date", "ip", "status")


def staleness(ts: Column, run: Column) -> Column:
    """Whole days from a banner's day to the run's; null where the banner has no time."""
    return F.datediff(run, ts.cast("date"))


def staleness_note(ts: Column, run: Column) -> Column:
    days = staleness(ts, run)
    return F.when(days >= 2, F.concat(F.lit("  (last scanned "), F.date_format(ts, "yyyy-MM-dd"), F.lit(", "), days.cast("string"), F.lit("d ago — cached view)"))).otherwise(F.lit(""))


def summary() -> Column:
    """One line of a host, in columns, from what flagged gives."""
    pad = lambda c, n: F.rpad(F.substring(F.when(F.coalesce(c, F.lit("")) == "", "?").otherwise(c), 1, n), n, " ")
    listed = lambda c: F.array_join(F.col(c).cast("array<string>"), ",")
    or_dash = lambda c: F.when(c == "", "-").otherwise(c)
    ip = F.when(F.length("ip") >= 39, F.col("ip")).otherwise(F.lpad("ip", 39, " "))
    fields = [("tags", or_dash(listed("tags"))), ("ports", listed("ports")), ("matched", listed("selectors")), ("host", F.coalesce(F.get("hostnames", F.lit(0)), F.lit(""))), ("cves", or_dash(F.array_join(F.slice("cves", 1, 5), ",")))]
    cells = [ip, pad(F.col("org"), 28), pad(F.col("city"), 14), *[F.concat(F.lit(f"{name}["), value, F.lit("]")) for name, value in fields]]
    return F.concat_ws("  ", *cells)


def alert(hits: DataFrame, ledger: DataFrame, rolled: DataFrame, run: Column) -> DataFrame:
    """place, ip, line: new hosts, then ongoing ones with their first day, then cleared ones, each by address."""
    known = rolled.select("ip", "first_seen", "last_banner_ts")
    lines = status(hits, ledger).join(hits, "ip", "left").join(known, "ip", "left")
    label = F.when(F.col("status") == "new", "[NEW]").otherwise(F.concat(F.lit("[ongoing since "), F.col("first_seen").cast("string"), F.lit("]")))
    text = F.concat(F.rpad(label, 28, " "), F.lit(" "), summary(), staleness_note(F.col("last_banner_ts"), run))
    gone = F.concat(F.rpad(F.lit("[CLEARED]"), 28, " "), F.lit(" "), F.col("ip"), F.lit(" — no longer flagged"))
    place = F.when(F.col("status") == "new", 0).when(F.col("status") == "ongoing", 1).otherwise(2)
    return lines.select(place.alias("place"), "ip", F.when(F.col("status") == "cleared", gone).otherwise(text).alias("line")).orderBy("place", "ip")


def archive_lines(rows: DataFrame, selectors: Selectors, name: str) -> DataFrame:
    """src_file, value: one JSON line per banner and selector that it matches, for archive.write_lines. name: of the file."""
    hits = matched(rows, selectors)
    keep = [c for c in hits.columns if c not in ("nth", "selector")]
    return hits.select(F.lit(name).alias("src_file"), F.to_json(F.struct(*keep, F.col("selector").alias("_selector"))).alias("value"))


def watch(rows: DataFrame, selectors: Selectors, ledger: Ledger, day: str) -> DataFrame:
    """One run as a batch job: reads the ledger, saves the rolled one and returns the alert's lines (place, ip, line)."""
    run = F.lit(day).cast("date")
    hits = written(flagged(rows, selectors, []), "hits")
    before = ledger.read()
    lines = written(alert(hits, before, roll(before, hits, run), run), "alert")
    ledger.save(roll(before, hits, run))
    return lines.orderBy("place", "ip")
