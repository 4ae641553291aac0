import gzip
import json

from harborlens.operators import manifest
from harborlens.plans import nightly, report
from harborlens.sources import store

BANNERS = [
    {"ip_str": "10.0.0.1", "port": 502, "org": "Zeta Bakery", "hash": 1, "info": "i", "timestamp": "2025-01-01T00:00:00", "vulns": {"CVE-1": {"cvss": 9}}, "location": {"country_code": "US", "region_code": "LA"}},
    {"ip_str": "10.0.0.2", "port": 80, "org": "Big Land Office", "location": {"country_code": "US", "region_code": "TX"}},
    {"ip_str": "10.0.0.3", "port": 80, "location": {"country_code": "US", "region_code": "TX"}},
    {"ip_str": "10.9.0.3", "port": 80, "location": None, "vulns": None},
]


def write(path, banners):
    with gzip.open(path, "wt") as f:
        f.write("\n".join(map(json.dumps, banners)))


def test_ingest(spark, tmp_path):
    for d in ("archive", "store"):
        (tmp_path / d).mkdir()
    (tmp_path / "kev.json").write_text(json.dumps({"vulnerabilities": [{"cveID": "CVE-1"}]}))
    (tmp_path / "nets.csv").write_text("cidr,country,region\n10.9.0.0/16,US,LA\n")
    settings = nightly.Settings(str(tmp_path / "archive"), str(tmp_path / "store"), str(tmp_path / "kev.json"), str(tmp_path / "none.csv"), str(tmp_path / "nets.csv"), ("US", "LA"), "land")
    write(tmp_path / "archive" / "x-events-2025-01-01.json.gz", BANNERS)
    for _ in range(2):  # twice is once
        assert nightly.ingest(spark, settings, "2025-01-01") == {"observations": 3, "vulns": 1}
    o = store.read(spark, f"{settings.store}/observations", "ip string")
    assert {(r.ip, r.tier, r.hash) for r in o.collect()} == {("10.0.0.1", "critical_infrastructure", "1"), ("10.0.0.2", "small_business", "None"), ("10.9.0.3", "unclassified", "None")}
    assert {r.info for r in o.collect()} == {"i", None}
    v = store.read(spark, f"{settings.store}/vulns", "ip string").head()
    assert (v.cve, v.cvss, v.in_kev, v.epss) == ("CVE-1", 9.0, True, None)
    write(tmp_path / "archive" / "x-events-2025-01-01.json.gz", BANNERS[2:3])
    assert nightly.ingest(spark, settings, "2025-01-01") == {"observations": 0, "vulns": 0}
    assert store.read(spark, f"{settings.store}/observations", "ip string").isEmpty()
    for day in ("2025-01-02", "2025-01-03", "2025-01-04"):
        write(tmp_path / "archive" / f"x-events-{day}.json.gz", BANNERS if day != "2025-01-04" else BANNERS[:1] + [{"ip_str": "10.9.0.9", "timestamp": "no time"}])
    assert nightly.run(spark, settings, ["2025-01-01", "2025-01-02", "2025-01-03", "2025-01-04", "2025-01-05"]) == {"2025-01-01": 2, "2025-01-02": 0, "2025-01-03": 0, "2025-01-04": 1, "2025-01-05": 2}
    o = store.read(spark, f"{settings.store}/observations", "ip string")
    ids = [(r.obs_id, r.date) for r in o.orderBy("obs_id").collect()]
    assert len({i for i, _ in ids}) == 6 and [x for _, x in ids] == sorted(x for _, x in ids)  # unique over the days, in their order
    nightly.run(spark, settings, ["2025-01-03"], keep_days=0)
    assert nightly.run(spark, settings, ["2025-01-03"], keep_days=1) == {"2025-01-03": 0}
    assert {str(r.date) for r in store.read(spark, f"{settings.store}/observations", "ip string").select("date").distinct().collect()} == {"2025-01-02", "2025-01-03"}


def test_manifest(spark):
    counts = spark.createDataFrame([("a", 0, 0, 0, 0), ("b", 100, 89, 10, 50), ("c", 100, 100, 31, 60), ("d", 10, 10, 0, 10), ("e", -1, 5, 0, 5)], "f string, reported bigint, raw bigint, dropped bigint, saved bigint")
    got = {r.f: (r.pct, r.drop_pct, r.status) for r in manifest.percentages(counts).withColumn("status", manifest.status()).collect()}
    assert got == {"a": (100, 0, 2), "b": (89, 11, 3), "c": (100, 31, 4), "d": (100, 0, 0), "e": (-500, 0, 3)}
    tries = spark.createDataFrame([("q", 1, 5), ("q", 2, 9), ("q", 3, 9), ("r", 1, 0)], "query string, attempt int, saved int")
    assert {tuple(r) for r in manifest.best_attempt(tries, "query").collect()} == {("q", 2, 9), ("r", 1, 0)}
    assert [r.page for r in manifest.pages(spark.createDataFrame([(0,), (101,)], "total bigint")).orderBy("total", "page").collect()] == [1, 1, 2]


def test_report(spark):
    schema = "tier string, reason string, score bigint, ip string, org string, city string, kev array<string>, ics array<string>, admin array<string>, dbs array<string>, epss double"
    rows = [("government", "r" * 40, s, f"10.0.0.{s}", None, "c", ["CVE-1"] if s else [], [], ["FTP"], [], 0.0 if s == 1 else 0.12345) for s in range(4)] + [("residential", "x", 0, "1.1.1.1", "o", None, [], [], [], [], 0.0)]
    text = report.triage_markdown(spark.createDataFrame(rows, schema), "Brief", top=2, honeypots=3)
    assert "**5 unique hosts** classified (+3 honeypot host(s) excluded)." in text and "| government | 4 | 3 | 4 | 0 |" in text and "| education | 0 | 0 | 0 | 0 |" in text
    assert "## Government — 4 hosts (3 with a risk signal)" in text and "_No signals in this tier._" in text
    assert "| 3 | 10.0.0.3 |  | c | CVE-1 | — | FTP | — | 0.123 | " + "r" * 28 + " |" in text and "10.0.0.1 " not in text
    assert report.triage_markdown(spark.createDataFrame([], schema), "None").startswith("# None")
