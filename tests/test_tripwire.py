import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from harborlens.operators import tripwire
from harborlens.sources import archive
from harborlens.streaming.tripwire import stream_ledger

TAGS = tripwire.Selectors(tags=("bad", "worse"))


def flagged(rows):
    return tripwire.flagged(tripwire.from_observations(rows), TAGS, ["date"])


SCHEMA = "obs_id bigint, date date, ip string, port int, org string, city string, tags string, banner_ts timestamp_ntz"


def d(n):
    return date(2025, 9, n)


def hit(i, day, ip, hour, tags="bad"):
    return (i, d(day), ip, 80, None if i % 2 else "o", "c", tags, datetime(2025, 9, day, hour))


DAYS = {
    1: [hit(1, 1, "A", 5), hit(2, 1, "B", 9), hit(3, 1, "A", 6, "other,bad,worse")],
    2: [hit(4, 2, "A", 1)],
    3: [hit(5, 3, "Z", 1, "fine")],
    4: [hit(6, 4, "B", 2), hit(7, 4, "C", 2)],
    5: [(8, d(5), "B", None, "o", "", "worse", datetime(2025, 8, 1)), (9, d(5), "B", 81, "o", None, None, None)],
}
EXPECTED = {1: ({"A", "B"}, set(), set()), 2: (set(), {"A"}, {"B"}), 3: (set(), set(), {"A"}), 4: ({"C"}, {"B"}, set()), 5: (set(), {"B"}, {"C"})}


def test_golden_sequence(spark):
    ledger = tripwire.empty_ledger(spark)
    for day, rows in DAYS.items():
        hits = flagged(spark.createDataFrame(rows, SCHEMA))
        found = tripwire.status(hits, ledger).collect()
        assert tuple({r.ip for r in found if r.status == s} for s in ("new", "ongoing", "cleared")) == EXPECTED[day], day
        ledger = spark.createDataFrame(tripwire.roll(ledger, hits, F.lit(d(day))).collect(), ledger.schema)
    last = {r.ip: r for r in ledger.collect()}
    assert last["B"].last_banner_ts == datetime(2025, 8, 1) and last["B"].selectors == ["tag:bad", "tag:worse"] and last["B"].first_seen == d(1)
    assert {ip for ip, r in last.items() if r.active} == {"B"}
    every = flagged(spark.createDataFrame([r for rows in DAYS.values() for r in rows], SCHEMA))
    runs = spark.createDataFrame([(d(n),) for n in DAYS], "date date")
    got = {n: (set(), set(), set()) for n in DAYS}
    for r in tripwire.statuses_by_run(every, runs).collect():
        got[r.date.day][("new", "ongoing", "cleared").index(r.status)].add(r.ip)
    assert got == EXPECTED


def test_merged_record_and_line(spark):
    hits = flagged(spark.createDataFrame(DAYS[1], SCHEMA))
    a = {r.ip: r for r in hits.collect()}["A"]
    assert (a.selectors, a.n_hits, a.org, a.banner_ts, a.tags) == (["tag:bad", "tag:worse"], 3, None, datetime(2025, 9, 1, 6), ["bad", "other", "worse"])
    line = hits.where("ip = 'A'").select(tripwire.summary()).head()[0]
    assert line == "A".rjust(39) + "  " + "?".ljust(28) + "  " + "c".ljust(14) + "  tags[bad,other,worse]  ports[80]  matched[tag:bad,tag:worse]  host[]  cves[-]"
    notes = spark.range(1).select(*[tripwire.staleness_note(F.lit(t).cast("timestamp_ntz"), F.lit(d(5))) for t in ("2025-09-04 23:00:00", "2025-09-03 00:00:00", None)]).head()
    assert list(notes) == ["", "  (last scanned 2025-09-03, 2d ago — cached view)", ""]


BANNERS = "rec_id bigint, date date, ip_str string, port int, org string, city string, tags array<string>, timestamp string, hostnames array<string>, vulns map<string,string>, category string"


def test_selectors_of_every_kind(spark):
    rows = [
        (1, d(1), "A", 80, "", None, ["x"], "bad time", ["late", None, "b"], {"CVE-2": "", "CVE-1": ""}, "malware"),
        (2, d(1), "A", 81, "second", "town", ["bad", None], "2025-09-01T01:00:00", ["a", "b"], None, None),
        (3, d(1), "A", 99, "third", None, None, None, None, None, None),
        (4, d(1), "", 99, "nobody", None, ["bad"], None, None, None, "malware"),
    ]
    banners = tripwire.from_banners(spark.createDataFrame(rows, BANNERS)).withColumn("categories", F.array("category"))
    selectors = tripwire.Selectors(("bad", "worse"), ("malware",), ("port > 90", "misspelt >", "nowhere = 1"))
    hit = tripwire.flagged(banners, selectors, []).collect()
    assert [(r.ip, r.selectors, r.org, r.city, r.hostnames, r.cves, r.ports, r.n_hits) for r in hit] == [
        ("A", ["category:malware", "port > 90", "tag:bad"], "second", "town", ["a", "b", "late"], ["CVE-1", "CVE-2"], [80, 81, 99], 3)
    ]
    counted = {r.selector: r.n for r in tripwire.counts(banners, selectors).collect()}
    assert counted == {"tag:bad": 1, "tag:worse": 0, "category:malware": 1, "port > 90": 1, "misspelt >": None, "nowhere = 1": None}
    assert tripwire.flagged(banners, tripwire.Selectors(), []).isEmpty() and tripwire.flagged(banners.limit(0), selectors, []).isEmpty()
    assert tripwire.gated(banners, None).count() == 3


def test_archive_has_a_line_per_banner_and_selector(spark, tmp_path):
    rows = spark.createDataFrame([(1, d(1), "A", 80, "", None, ["bad", "worse"], None, None, None, None)], BANNERS)
    archive.write_lines(tripwire.archive_lines(tripwire.from_banners(rows), TAGS, "hits.json.gz"), str(tmp_path / "out"))
    assert sorted((r.ip, r._selector) for r in spark.read.json(str(tmp_path / "out")).collect()) == [("A", "tag:bad"), ("A", "tag:worse")]


def test_watch_job_keeps_its_ledger(spark, tmp_path):
    ledger = tripwire.Ledger(spark, str(tmp_path / "ledger"))
    assert ledger.read().isEmpty()
    for day, rows in DAYS.items():
        lines = tripwire.watch(tripwire.from_observations(spark.createDataFrame(rows, SCHEMA)), TAGS, ledger, str(d(day))).collect()
        assert tuple({r.ip for r in lines if r.place == p} for p in (0, 1, 2)) == EXPECTED[day], day
        assert [(r.place, r.ip) for r in lines] == sorted((r.place, r.ip) for r in lines)
    assert [r.line for r in lines if r.place == 2] == ["[CLEARED]".ljust(28) + " C — no longer flagged"]
    assert [r.line[:28] for r in lines if r.place == 1] == ["[ongoing since 2025-09-01]  "]
    assert {r.ip for r in ledger.read().where("active").collect()} == {"B"}
    (tmp_path / "ledger" / "CURRENT").write_text("version-none")
    (tmp_path / "ledger" / ".CURRENT.crc").unlink(missing_ok=True)
    assert ledger.read().isEmpty()  # corrupt


def test_stream_takes_up_its_state(spark, tmp_path):
    got = []
    for days in ((1, 2), (3, 4), (5,), ()):
        for n in days:
            spark.createDataFrame(DAYS[n], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        out = stream_ledger(spark, f"{tmp_path}/in", TAGS, str(tmp_path / "state"), files_a_batch=1)
        got.append({r.ip: (r.first_seen.day, r.last_seen.day, r.active) for r in out.collect()})
    assert got[0] == {"A": (1, 2, True), "B": (1, 1, False)}
    assert got[2] == got[3] == {"A": (1, 2, False), "B": (1, 5, True), "C": (4, 4, False)}


def test_stream_equals_batch(spark, tmp_path):
    for day, rows in DAYS.items():
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = stream_ledger(spark, f"{tmp_path}/in", TAGS, files_a_batch=2)
    got = {r.ip: (r.first_seen, r.last_seen, r.selectors) for r in stream.collect()}
    assert got == {"A": (d(1), d(2), "tag:bad|tag:worse"), "B": (d(1), d(5), "tag:bad|tag:worse"), "C": (d(4), d(4), "tag:bad")}


@pytest.mark.parametrize("batch", [1, 2, 1000])
def test_stream_whatever_the_batches(spark, tmp_path, batch):
    # days in mixed order over the files: the last day comes first, and A's latest banner before an older one
    everything = [r for rows in DAYS.values() for r in rows]
    for part in (DAYS[5] + DAYS[2], DAYS[4], DAYS[1] + DAYS[3]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        time.sleep(0.05)
    whole = flagged(spark.createDataFrame(everything, SCHEMA)).collect()
    last = max(r.date for r in whole)
    expected = {}
    for r in sorted(whole, key=lambda r: r.date):
        expected[r.ip] = (r.banner_ts or expected.get(r.ip, (None,))[0], r.date == last)
    stream = stream_ledger(spark, f"{tmp_path}/in", TAGS, files_a_batch=batch)
    assert {r.ip: (r.last_banner_ts, r.active) for r in stream.collect()} == expected
