"""Queries over the exposure tables, each over its whole tables; limits stand only where a report has one."""

from __future__ import annotations

from dataclasses import replace
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from harborlens.functions.text import day_of_file
from harborlens.operators import classify as C
from harborlens.operators import exposure, geo, hosts, manifest, shards, tripwire
from harborlens.plans import report
from harborlens.plans.reference_sql import ORACLE  # noqa: F401
from harborlens.session import scratch_path
from harborlens.sources import archive
from harborlens.sources.tables import table
from harborlens.streaming.tripwire import stream_ledger

TARGET, REGION_NAME = ("QX", "QA"), "county"
NETWORKS = [
    ("10.0.0.0/17", "QX", "QA"), ("10.0.128.0/17", "QX", "QB"), ("10.1.0.0/16", "QX", "QA"), ("10.1.64.0/18", "QX", "QC"), ("10.2.0.0/18", "QY", "QA"),
    ("2001:db8:1::/48", "QX", "QA"), ("2001:db8::/32", "QX", "QD"),
]
SELECTORS = tripwire.Selectors(tags=("honeypot", "proxy"))
MIXED = tripwire.Selectors(tags=("honeypot",), categories=("malware",), queries=("port = 502", "no_such_column = 1"))
SHARD_THRESHOLD, RETENTION_DAYS, TOP_HOSTS = 200, 30, 15
QUERIES: dict = {}
SERVICE = ["ip", "port"]


def query(f):
    QUERIES[f.__name__] = f
    return f


def _t(name: str):
    return partial(lambda n, s, d: table(s, d, n), name)


observations, vulns, banners = _t("observations"), _t("vulns"), _t("daily_downloads")
kev, epss = _t("kev_list"), _t("epss_scores")


def _inline(s: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """A few fixed rows as a table of literals, which needs no Python worker."""
    values = ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)
    return s.sql(f"select * from values {values} as t({columns})")


def networks(s: SparkSession) -> DataFrame:
    return _inline(s, NETWORKS, "cidr, country, region")


def state(s: SparkSession, d: str, *columns: str) -> DataFrame:
    return exposure.current_state(observations(s, d), [*SERVICE, "date", *columns])


def last_day(s: SparkSession, d: str) -> Column:
    """The latest date, as a scalar subquery."""
    return observations(s, d).agg(F.max("date")).scalar()


@query
def obs_projection(s, d):
    return exposure.project(banners(s, d))


@query
def vuln_explode(s, d):
    return exposure.vulnerabilities(banners(s, d), kev(s, d), epss(s, d))


@query
def current_state(s, d):
    return state(s, d, "org", "city", "product", "tier", "hash", "obs_id")


@query
def lifecycle(s, d):
    return exposure.lifecycle(observations(s, d))


@query
def q1_tier_accounting(s, d):
    joined = state(s, d, "tier").join(vulns(s, d), [*SERVICE, "date"], "left")
    return (
        joined.groupBy("tier")
        .agg(F.count(F.lit(1)).alias("host_services"), F.count_distinct("ip").alias("unique_hosts"), F.count_distinct(F.when(F.col("in_kev"), F.col("ip"))).alias("hosts_with_kev"))
        .orderBy(F.desc("hosts_with_kev"), F.asc_nulls_last("tier"))
    )


@query
def tier_accounting_services(s, d):
    """As q1, with services counted once however many vulnerabilities they have."""
    flag = vulns(s, d).groupBy(*SERVICE, "date").agg(F.bool_or("in_kev").alias("in_kev"))
    joined = state(s, d, "tier").join(flag, [*SERVICE, "date"], "left")
    return joined.groupBy("tier").agg(F.count(F.lit(1)).alias("host_services"), F.count_distinct("ip").alias("unique_hosts"), F.count_distinct(F.when(F.col("in_kev"), F.col("ip"))).alias("hosts_with_kev"))


@query
def q2_top_kev(s, d):
    chosen = state(s, d, "tier", "org", "city").where(F.col("tier").isin(C.TIERS[:3]))
    top = chosen.join(vulns(s, d).where("in_kev"), [*SERVICE, "date"]).distinct().orderBy(F.desc_nulls_last("epss"), F.desc_nulls_last("cvss"), "ip", "port", "cve").limit(25)
    return top.select("tier", "ip", "org", "city", "port", "cve", "cvss", F.round("epss", 3).alias("epss"))


@query
def q3_new_exposures(s, d):
    seen = exposure.lifecycle(observations(s, d)).select(*SERVICE, F.col("first_seen").alias("date"))
    latest = observations(s, d).where(F.col("date") == last_day(s, d))
    return latest.join(seen, [*SERVICE, "date"]).select("tier", "ip", "org", "city", "port", "product").orderBy(F.asc_nulls_last("tier"), "ip", "port", "product")


@query
def new_exposures_by_day(s, d):
    """As q3, for every day: the services whose first day it is."""
    seen = exposure.lifecycle(observations(s, d)).select(*SERVICE, F.col("first_seen").alias("date"))
    return observations(s, d).join(seen, [*SERVICE, "date"]).select("date", "tier", "ip", "org", "city", "port", "product")


@query
def q4_longest_open(s, d):
    open_ = exposure.lifecycle(observations(s, d)).where(F.col("last_seen") == last_day(s, d))
    both = open_.join(state(s, d, "tier", "org", "product").drop("date"), SERVICE)
    return both.select("ip", "port", "first_seen", "last_seen", "span_days", "tier", "org", "product").orderBy(F.desc("span_days"), "first_seen", "ip", "port").limit(25)


@query
def q5_remediated(s, d):
    gone = exposure.lifecycle(observations(s, d)).where(F.col("last_seen") < last_day(s, d))
    return gone.select("ip", "port", "first_seen", F.col("last_seen").alias("last_seen_before_gone")).orderBy(F.desc("last_seen"), "ip", F.asc_nulls_last("port")).limit(25)


@query
def q6_org_rollup(s, d):
    joined = state(s, d, "tier", "org").join(vulns(s, d), [*SERVICE, "date"], "left")
    rolled = joined.groupBy("org", "tier").agg(F.count_distinct("ip").alias("hosts"), F.count_distinct(F.when(F.col("in_kev"), F.col("cve"))).alias("kev_cves"), F.round(F.max("epss"), 3).alias("worst_epss"))
    return rolled.where("kev_cves > 0").orderBy(F.desc("kev_cves"), F.asc_nulls_last("org"), F.asc_nulls_last("tier")).limit(30)


@query
def q7_ics_latest(s, d):
    rows = observations(s, d).where(F.col("port").isin(C.ICS_QUERY_PORTS))
    return rows.where(F.col("date") == last_day(s, d)).select("date", "ip", "org", "city", "port", "product").orderBy(F.asc_nulls_last("org"), "ip", "port", "product")


@query
def keyed_dedup_first(s, d):
    return exposure.keep_first(banners(s, d), ["src_file"]).select("rec_id", "src_file")


def _gated(s, d) -> DataFrame:
    located = geo.locate(banners(s, d).withColumnRenamed("ip_str", "ip"), networks(s))
    return geo.gates(located, TARGET, REGION_NAME)


@query
def geo_gate_primary(s, d):
    return _gated(s, d).select("rec_id", "in_target", "keep_primary", "keep_primary_alone")


@query
def geo_gate_store(s, d):
    return _gated(s, d).select("rec_id", "keep_store", "keep_rescue", "keep_tripwire_alone")


@query
def gated_dedup(s, d):
    """The collector's order: off-target banners go first, then the first of each key within the day's file stays."""
    kept = _gated(s, d).where("keep_primary").withColumnRenamed("ip", "ip_str")
    return exposure.keep_first(kept, ["src_file"]).select("rec_id", "src_file")


@query
def two_query_union(s, d):
    """The primary query's banners in the target, then the rescue query's by name; the first of each key in the day's file stays."""
    gated = _gated(s, d).withColumnRenamed("ip", "ip_str")
    rescued = gated.where(F.lower(F.coalesce("org", F.lit(""))).contains(REGION_NAME))
    return exposure.merge_parts([gated.where("keep_primary"), rescued], ["src_file"]).select("rec_id", "src_file", "place")


@query
def merged_parts(s, d):
    """The parts of a day in the order they were asked for, without a gate: udp before tcp before the rest."""
    rows = banners(s, d)
    parts = [rows.where("transport = 'udp'"), rows.where("transport = 'tcp'"), rows.where("coalesce(transport, '') not in ('udp', 'tcp')")]
    return exposure.merge_parts(parts, ["src_file"]).select("rec_id", "src_file", "place")


@query
def geo_range_join(s, d):
    return geo.locate(observations(s, d).select("ip").distinct(), networks(s))


@query
def kev_membership(s, d):
    return exposure.enrich(vulns(s, d).select("cve").distinct(), kev(s, d), epss(s, d)).select("cve", "in_kev")


@query
def epss_lookup_null(s, d):
    return exposure.enrich(vulns(s, d).select("cve").distinct(), kev(s, d), epss(s, d)).select("cve", "epss")


@query
def epss_lookup_zero(s, d):
    return exposure.enrich(vulns(s, d).select("cve").distinct(), kev(s, d), epss(s, d), F.lit(0.0)).select("cve", "epss")


def host_frame(s, d) -> DataFrame:
    return hosts.aggregate_hosts(exposure.with_city(banners(s, d)), ["date"])


def _text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.concat_ws("|", F.col(c).cast("array<string>")) for c in columns})


@query
def host_aggregate(s, d):
    return _text(host_frame(s, d), "ports", "products", "hostnames", "domains", "cves")


@query
def first_truthy_org(s, d):
    return host_frame(s, d).select("date", "ip", "org", "city")


@query
def honeypot_guard(s, d):
    return hosts.without_honeypots(host_frame(s, d)).select("date", "ip", "n_ports")


def _classified(h: DataFrame) -> DataFrame:
    tier = C.classify(F.col("org"), F.col("hostnames"), F.col("domains"), F.col("ports"))
    return h.select(*h.columns, F.inline(F.array(tier)))  # a generator, so that the cascade runs once for both columns


@query
def tier_classify(s, d):
    return _classified(host_frame(s, d)).select("date", "ip", "tier", "reason")


def _scored(s, d) -> DataFrame:
    """Hosts with their scores; honeypots are left out of what is reported."""
    h = _classified(hosts.without_honeypots(host_frame(s, d)))
    cves = exposure.enrich(h.select("date", "ip", F.explode("cves").alias("cve")), kev(s, d), epss(s, d), F.lit(0.0))
    listed = F.array_sort(F.collect_set(F.when(F.col("in_kev"), F.col("cve")))).alias("kev")
    per_host = cves.groupBy("date", "ip").agg(F.count_if("in_kev").alias("n_kev"), F.max("epss").alias("max_epss"), listed)
    names = {"ics": C.ICS_PORTS, "admin": C.ADMIN_PORTS, "dbs": C.DB_PORTS}
    full = h.join(per_host, ["date", "ip"], "left").fillna({"n_kev": 0, "max_epss": 0.0}).withColumn("kev", F.coalesce("kev", F.array().cast("array<string>"))).withColumns({k: C.named_ports(F.col("ports"), v) for k, v in names.items()})
    return full.withColumn("score", C.score(F.col("n_kev"), F.size("ics"), F.size("admin"), F.size("dbs"), F.col("max_epss")))


@query
def actionability_score(s, d):
    return _scored(s, d).select("date", "ip", "n_kev", F.round("max_epss", 3).alias("epss"), F.size("cves").cast("bigint").alias("n_cves"), "score", F.concat_ws("|", F.slice("products", 1, 3)).alias("products"))


@query
def port_protocol_lookup(s, d):
    return _text(_scored(s, d).select("date", "ip", "ics", "admin", "dbs"), "ics", "admin", "dbs")


@query
def tier_accounting_spine(s, d):
    counted = _scored(s, d).groupBy("tier").agg(
        F.count(F.lit(1)).alias("hosts"), F.count_if(F.col("n_kev") > 0).alias("with_kev"), F.count_if(F.size("admin") > 0).alias("with_admin"), F.count_if(F.size("ics") > 0).alias("with_ics")
    )
    spine = _inline(s, [(t, i) for i, t in enumerate(C.TIERS)], "tier, place")
    return spine.join(counted, "tier", "left").fillna(0).select("tier", "hosts", "with_kev", "with_admin", "with_ics")


@query
def topn_per_tier(s, d):
    """The highest scores of each tier and day; ties go by address. The rank limit is pushed below the exchange."""
    rank = F.row_number().over(Window.partitionBy("date", "tier").orderBy(F.desc("score"), "ip"))
    flagged = _scored(s, d).where("score > 0").select("date", "tier", "ip", "score", rank.cast("bigint").alias("rank"))
    return flagged.where(F.col("rank") <= TOP_HOSTS)


def _brief(s, d) -> DataFrame:
    scored = _scored(s, d).withColumnRenamed("max_epss", "epss")
    return scored.where(F.col("date") == banners(s, d).agg(F.max(day_of_file(F.col("src_file")))).scalar())


@query
def report_tiers(s, d):
    """The brief's table of tiers of the last day."""
    return report.tier_counts(_brief(s, d)).toDF("tier", "hosts", "with_kev", "with_admin", "with_ics", "signal")


@query
def report_hosts(s, d):
    """The brief's lines of the last day's hosts."""
    return report.host_lines(_brief(s, d), TOP_HOSTS)


def _hits(s, d) -> DataFrame:
    return tripwire.flagged(tripwire.from_observations(observations(s, d)), SELECTORS, ["date"])


def _run(s, d) -> tuple[DataFrame, DataFrame]:
    """The last day's hits, and the ledger before it: what all earlier days together leave."""
    hits = _hits(s, d)
    before = hits.where(F.col("date") < last_day(s, d))
    ledger = _ledger(before).withColumn("active", F.col("last_seen") == before.agg(F.max("date")).scalar())
    return hits.where(F.col("date") == last_day(s, d)), ledger


def _ledger(hits: DataFrame) -> DataFrame:
    return hits.groupBy("ip").agg(
        F.min("date").alias("first_seen"),
        F.max("date").alias("last_seen"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("selectors")))).alias("selectors"),
        F.max(F.when(F.col("banner_ts").isNotNull(), F.struct("date", "banner_ts")))["banner_ts"].alias("last_banner_ts"),
    )


@query
def selector_union(s, d):
    return _text(_hits(s, d), "selectors", "ports").select("date", "ip", "selectors", "ports", "n_hits")


def _status(name: str):
    def run(s, d):
        hits, ledger = _run(s, d)
        return tripwire.status(hits, ledger).where(F.col("status") == name).select("ip").orderBy("ip")

    run.__name__ = f"ledger_{name}"
    return query(run)


for _name in ("new", "ongoing", "cleared"):
    _status(_name)


@query
def ledger_by_day(s, d):
    """What the ledger reports on every collection day, from the first to the last."""
    return tripwire.statuses_by_run(_hits(s, d), observations(s, d).select("date")).orderBy("date", "status", "ip")


@query
def ledger_roll_forward(s, d):
    hits, ledger = _run(s, d)
    return _text(tripwire.roll(ledger, hits, last_day(s, d)), "selectors")


@query
def ledger_job(s, d):
    """The watch as a batch job of the last four days, one after the other on a saved ledger; the ledger it leaves."""
    days = [r.date for r in observations(s, d).select("date").distinct().orderBy(F.desc("date")).limit(4).collect()]
    ledger = tripwire.Ledger(s, scratch_path(s, "watch"))
    rows = tripwire.from_observations(observations(s, d))
    for day in sorted(days):
        tripwire.watch(rows.where(F.col("date") == day), SELECTORS, ledger, str(day))
    return _text(ledger.read(), "selectors")


def _banner_rows(s, d) -> DataFrame:
    located = geo.locate(exposure.with_city(banners(s, d)).withColumnRenamed("ip_str", "ip"), networks(s)).withColumnRenamed("ip", "ip_str")
    return tripwire.gated(tripwire.from_banners(located), TARGET).withColumn("categories", F.array("product"))


@query
def selector_kinds(s, d):
    """Hits of banners in the target by tag, category (of the product here) and free condition; a condition on an unknown column is skipped."""
    hits = tripwire.flagged(_banner_rows(s, d), replace(MIXED, categories=("Ledgerkeep cache",)), ["date"])
    return _text(hits.select("date", "ip", "selectors", "ports", "tags", "hostnames", "cves", "n_hits"), "selectors", "ports", "tags", "hostnames", "cves")


@query
def selector_counts(s, d):
    return tripwire.counts(_banner_rows(s, d), replace(MIXED, categories=("Ledgerkeep cache",)))


@query
def hit_archive(s, d):
    """Lines of the hit archive, one per banner and selector, counted by selector."""
    lines = tripwire.archive_lines(tripwire.from_banners(exposure.with_city(banners(s, d))), SELECTORS, "hits-2025-01-01.json.gz")
    folder = scratch_path(s, "hits")
    archive.write_lines(lines, folder)
    return s.read.json(folder).groupBy(F.col("_selector").alias("selector")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("obs_id").alias("banners"))


@query
def alert_lines(s, d):
    """The alert of the last day, in its order."""
    hits, ledger = _run(s, d)
    return tripwire.alert(hits, ledger, tripwire.roll(ledger, hits, last_day(s, d)), last_day(s, d))


@query
def staleness_days(s, d):
    hits = _hits(s, d)
    return hits.select("date", "ip", tripwire.staleness(F.col("banner_ts"), F.col("date")).cast("bigint").alias("days"), tripwire.staleness_note(F.col("banner_ts"), F.col("date")).alias("note"))


@query
def host_summary_line(s, d):
    hits = tripwire.flagged(tripwire.from_banners(exposure.with_city(banners(s, d))), SELECTORS, ["date"])
    return hits.select("date", "ip", tripwire.summary().alias("line"))


@query
def cidr_leaves(s, d):
    return shards.leaves(observations(s, d), SHARD_THRESHOLD).where("family = 4").select("prefix", "length", "n")


@query
def cidr_leaves_v6(s, d):
    return shards.leaves(observations(s, d), SHARD_THRESHOLD).where("family = 6").select("prefix", "length", "n")


def _manifest(s, d) -> DataFrame:
    """Per file: reported is what observations hold of it, raw the banners fetched; the gate is the primary one."""
    reported = observations(s, d).groupBy("src_file").agg(F.count(F.lit(1)).alias("reported"))
    gated = _gated(s, d).withColumnRenamed("ip", "ip_str")
    saved = exposure.keep_first(gated.where("keep_primary"), ["src_file"]).groupBy("src_file").agg(F.count(F.lit(1)).alias("saved"))
    raw = gated.groupBy("src_file").agg(F.count(F.lit(1)).alias("raw"), F.count_if(~F.col("keep_primary")).alias("dropped"))
    full = reported.join(raw, "src_file", "full").join(saved, "src_file", "left").fillna(0)
    return manifest.percentages(full)


@query
def completeness_manifest(s, d):
    return _manifest(s, d)


@query
def day_status(s, d):
    return _manifest(s, d).select("src_file", manifest.status().alias("status"))


@query
def script_status(s, d):
    """A file's status as the download script gives it."""
    return _manifest(s, d).select("src_file", manifest.script_status().alias("status"))


@query
def daily_window(s, d):
    """Banners per collection day within the open window of one day around it, and outside."""
    day = F.to_date("banner_ts")
    inside = (day > F.date_sub("date", 1)) & (day < F.date_add("date", 1))
    return observations(s, d).groupBy("date").agg(F.count_if(inside).alias("inside"), F.count_if(~inside).alias("outside"), F.count_if(day.isNull()).alias("untimed"))


@query
def report_summary(s, d):
    o = observations(s, d)
    services = F.count_distinct(F.struct(*SERVICE)).alias("services")
    return o.groupBy("asn").agg(F.count_distinct("ip").alias("hosts"), services, F.count_distinct("date").alias("days"), F.min("date").alias("first_seen"), F.max("date").alias("last_seen"))


@query
def city_counts(s, d):
    return observations(s, d).groupBy("city").agg(F.count_distinct("ip").alias("n"))


@query
def asset_inventory(s, d):
    seen = observations(s, d).groupBy(*SERVICE).agg(F.count_distinct("date").alias("days_seen"), F.max("date").alias("last_seen"))
    return state(s, d, "product", "city").drop("date").alias("c").join(seen.alias("l"), [F.col(f"c.{k}").eqNullSafe(F.col(f"l.{k}")) for k in SERVICE]).select("c.ip", "c.port", "product", "city", "days_seen", "last_seen")


@query
def appliances(s, d):
    """Every service with a product as last seen, in order of port and address."""
    return state(s, d, "product", "city").where("product <> ''").select(*SERVICE, "product", "city").orderBy(F.asc_nulls_last("port"), "ip")


@query
def grand_totals(s, d):
    return observations(s, d).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("date").alias("days"), F.count_distinct("ip").alias("hosts"))


@query
def retention_filter(s, d):
    return observations(s, d).where(F.col("date") > F.date_sub(last_day(s, d), RETENTION_DAYS)).groupBy("date").agg(F.count(F.lit(1)).alias("n"))


@query
def tripwire_stream(s, d):
    return stream_ledger(s, f"{d}/observations.parquet", SELECTORS)


@query
def tripwire_stream_resumed(s, d):
    """The same from files that land in two parts and are read in several batches, the second run taking up the first one's state."""
    rows = observations(s, d).select("obs_id", "date", "ip", "port", "org", "city", "tags", "banner_ts").withColumn("part", F.pmod(F.unix_date("date"), F.lit(4)))
    inbox, state_folder = scratch_path(s, "inbox"), scratch_path(s, "ledger")
    for part in (0, 2):
        for i in (part, part + 1):
            rows.where(F.col("part") == i).drop("part").coalesce(2).write.mode("append").parquet(inbox)
        out = stream_ledger(s, inbox, SELECTORS, state_folder, files_a_batch=1)
    return out


@query
def json_archive_roundtrip(s, d):
    """Banners written as daily archives of JSON lines and read back through the archive source: rows and hosts per day."""
    folder = scratch_path(s, "archive")
    archive.write_days(banners(s, d), folder)
    back = archive.read_days(s, folder)
    return back.groupBy("date").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("ip_str").alias("hosts"))


__all__ = ["ORACLE", "QUERIES"]
