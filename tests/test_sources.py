import gzip
import json
from datetime import date
from pathlib import Path

import pytest

from harborlens.operators import exposure
from harborlens.sources import archive, config, feeds, store


def test_archive(spark, tmp_path):
    good = {"ip_str": "1.1.1.1", "port": 1, "hash": 5, "cpe23": [], "cpe": ["c"], "vulns": {"CVE-1": {"cvss": 7}, "CVE-2": 3}, "_shodan": {"module": "m"}, "data": "x" * 10}
    lines = [json.dumps(good), "{broken", json.dumps({"port": 2}), json.dumps({"ip_str": ""}), json.dumps({"ip_str": "2.2.2.2"})]
    for name in ("s-events-2025-01-02.json.gz", "s-events-2025-01-03.json.gz", "s-events-2025-01-02.json.gz.backup.1"):
        with gzip.open(tmp_path / name, "wt") as f:
            f.write("\n".join(lines))
    df = archive.read_days(spark, str(tmp_path))
    assert {(r.ip_str, r.date) for r in df.collect()} == {(i, date(2025, 1, x)) for i in ("1.1.1.1", "2.2.2.2") for x in (2, 3)}
    one = archive.read_days(spark, str(tmp_path), "2025-01-02").where("port = 1").head()
    assert (one.cpe23, one.vulns["CVE-2"], json.loads(one.vulns["CVE-1"]), one.hash) == (["c"], "3", {"cvss": 7}, "5")


def test_archive_round_trip(spark, tmp_path):
    schema = "rec_id bigint, src_file string, " + archive.BANNER
    rows = [(1, "a-events-2025-01-01.json.gz", "1.1.1.1", 80), (2, "a-events-2025-01-02.json.gz", "1.1.1.2", 81), (3, "a-events-2025-01-02.json.gz", "", 82)]
    names = [f.name for f in spark.createDataFrame([], schema).schema]
    df = spark.createDataFrame([r + (None,) * (len(names) - 4) if names[2] == "ip_str" else r for r in rows], schema)
    archive.write_days(df, str(tmp_path / "out"))
    back = archive.read_days(spark, str(tmp_path / "out"))
    assert {(r.src_file, r.ip_str, r.port) for r in back.collect()} == {r[1:] for r in rows[:2]}
    archive.write_days(df.where("rec_id = 1").withColumn("port", df.port + 1), str(tmp_path / "out"))  # a day again
    assert {(r.src_file, r.port) for r in archive.read_days(spark, str(tmp_path / "out")).collect()} == {(rows[0][1], 81), (rows[1][1], 81)}
    files = sorted(p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith("."))
    assert len(files) == 3 and files[1].startswith("a-events-2025-01-01.json.gz.backup.")


def test_feeds(spark, tmp_path):
    (tmp_path / "kev.json").write_text(json.dumps({"vulnerabilities": [{"cveID": "CVE-1"}, {"cveID": "CVE-1"}, {"other": 1}]}, indent=1))
    with gzip.open(tmp_path / "epss.csv.gz", "wt") as f:
        f.write("#v\ncve,epss,p\nCVE-1,0.1,0\n\nCVE-2,bad\nCVE-3\nCVE-1,0.3,0\n")
    assert [r.cve for r in feeds.listed(spark, str(tmp_path / "kev.json")).collect()] == ["CVE-1"]
    assert [(r.cve, r.epss) for r in feeds.probabilities(spark, str(tmp_path / "epss.csv.gz")).collect()] == [("CVE-1", 0.3)]
    for read in (feeds.listed, feeds.probabilities, feeds.networks):
        assert read(spark, str(tmp_path / "none")).isEmpty()


def test_store(spark, tmp_path):
    path, schema = str(tmp_path / "store"), "ip string, port int, date date"
    assert store.read(spark, path, schema).isEmpty()
    day = spark.createDataFrame([("a", 1)], "ip string, port int")
    for name in ("2025-01-01", "2025-01-02", "2025-01-03"):
        store.replace_day(day, path, name)
        store.replace_day(day, path, name)  # again: no second copy
    store.replace_day(day.limit(0), path, "2025-01-02")
    assert {str(r.date) for r in store.read(spark, path, schema).collect()} == {"2025-01-01", "2025-01-03"}
    store.replace_day(day.selectExpr("ip", "port", "'x' as extra"), path, "2025-01-04")
    assert "extra" in store.read(spark, path, schema).columns
    assert store.expire(spark, path, "2025-01-03") == ["2025-01-01"]
    store.wipe(spark, path)
    assert store.read(spark, path, schema).isEmpty()


def test_a_day_that_fails_leaves_the_old_one(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    one = spark.createDataFrame([("a", 1)], "ip string, port int")
    assert store.replace_day(one, path, "2025-01-01") == 1
    real = store.move

    def refuses(spark, old, new):
        if "_staged" in old:
            raise OSError("full")
        real(spark, old, new)

    monkeypatch.setattr(store, "move", refuses)
    with pytest.raises(OSError):
        store.replace_day(one.unionAll(one), path, "2025-01-01")
    with pytest.raises(Exception):  # noqa: B017
        store.replace_day(one.selectExpr("raise_error(ip) as ip", "port"), path, "2025-01-01")
    monkeypatch.undo()
    assert store.read(spark, path, "ip string").count() == 1
    assert [p.name for p in Path(path).iterdir()] == ["date=2025-01-01"]
    assert store.replace_day(one.limit(0), path, "2025-01-01") == 0 and store.read(spark, path, "ip string").isEmpty()


def test_settings_and_networks(tmp_path):
    (tmp_path / ".env").write_text("# note\nA=1\nB = 'two' \nnothing\n=x\nC=a=b\n", encoding="utf-8")
    env = config.load_settings(str(tmp_path / ".env"), {"A": "0"})
    assert env == {"A": "0", "B": "two", "C": "a=b"} and config.load_settings(str(tmp_path / "none"), {}) == {}
    assert config.networks_path(None, {}, str(tmp_path)) is None
    for n in ("b.csv", "a.csv"):
        (tmp_path / n).write_text("")
    assert config.networks_path(None, {}, str(tmp_path)).endswith("a.csv")
    assert config.networks_path("x", {"GEOIP_DB": "y"}, str(tmp_path)) == "x" and config.networks_path(None, {"GEOIP_DB": "y"}, str(tmp_path)) == "y"


def test_feeds_are_kept(spark, tmp_path):
    for n in (1, 2):
        kept = feeds.keep(spark.createDataFrame([(f"CVE-{i}",) for i in range(n)], "cve string"), str(tmp_path / "kev"))
    assert kept.count() == 2


def test_parts_in_order(spark):
    schema = "rec_id bigint, src_file string, ip_str string, port int, timestamp string, hash string"
    first = spark.createDataFrame([(1, "f", "a", 1, "t", "h"), (2, "f", "b", 1, "t", None)], schema)
    second = spark.createDataFrame([(1, "f", "a", 1, "t", "h"), (0, "f", "c", 1, "t", "h"), (3, "f", "b", 1, "t", None), (4, "f", "b", 2, "t", None), (5, "g", "a", 1, "t", "h")], schema)
    got = {(r.place, r.rec_id) for r in exposure.merge_parts([first, second], ["src_file"]).collect()}
    assert got == {(0, 1), (0, 2), (1, 4), (1, 5)}
    assert exposure.merge_parts([first.limit(0)], ["src_file"]).isEmpty()


def test_projection_edge_cases(spark):
    schema = "rec_id bigint, src_file string, " + archive.BANNER
    df = spark.createDataFrame([], schema)
    kev, epss = spark.createDataFrame([("CVE-1",)], "cve string"), spark.createDataFrame([("CVE-1", 0.5)], "cve string, epss double")
    assert exposure.project(df).isEmpty() and exposure.vulnerabilities(df, kev, epss).isEmpty()
    clash = spark.sql("select 'CVE-1' as cve, false as in_kev, 0.1D as epss, 'x' as listed")
    assert [tuple(r) for r in exposure.enrich(clash, kev, epss).select("in_kev", "epss", "listed").collect()] == [(True, 0.5, "x")]
    extra = spark.sql("select 1L as rec_id, 'x-events-2025-01-01.json.gz' as src_file, 'a' as ip_str, 'b' as ip, 'c' as tier, 'd' as city, 1 as port, 'o' as org").unionByName(df, allowMissingColumns=True)
    assert [(r.ip, r.tier, r.city) for r in exposure.project(extra).collect()] == [("a", "small_business", None)]
    one = spark.sql("select 1L as rec_id, 'x-events-2025-01-01.json.gz' as src_file, 'a' as ip_str, 1 as port, map('CVE-1', '{\"cvss\": \"7.5\"}', 'CVE-2', '{\"cvss\": \"n/a\"}', 'CVE-3', '7') as vulns")
    got = {r.cve: (r.cvss, r.in_kev, r.epss) for r in exposure.vulnerabilities(one, kev, epss).collect()}
    assert got == {"CVE-1": (7.5, True, 0.5), "CVE-2": (None, False, None), "CVE-3": (None, False, None)}


def test_views_and_current_state(spark):
    o = spark.sql("select * from values (1L, date'2025-01-01', 'a', 1, timestamp_ntz'2025-01-01 01:00:00', 'x', 't'), (2L, date'2025-01-02', 'a', 1, null, 'y', 't'), (3L, date'2025-01-02', 'a', 1, timestamp_ntz'2025-01-01 00:00:00', 'z', 't'), (4L, date'2025-01-01', 'a', null, null, 'n', 't') as t(obs_id, date, ip, port, banner_ts, hash, tier)")
    store.register_views(o, spark.sql("select 'a' as ip, 1 as port, date'2025-01-02' as date, 'CVE-1' as cve, true as in_kev"))
    assert {(r.port, r.hash) for r in spark.sql("select * from current_state").collect()} == {(1, "z"), (None, "n")}
    assert spark.sql("select count(*) from lifecycle join vulns using (ip, port)").head()[0] == 1
