from harborlens.operators import nested

SCHEMA = "rec_id bigint, location struct<city:string,region_code:string,country_code:string>, hostnames array<string>, vulns map<string,string>, link string"
DEEP = '{"cvss": "7.5", "references": [null, {"url": "u", "tags": ["a", "b"]}, 3, {"url": null}], "affected": [{"product": "p", "ranges": [{"from": "1"}, "x", {"to": "2"}]}, {}, []]}'
CASES = [
    (1, ("c", None, None), ["h", None, "", "h"], {"CVE-1": DEEP, "CVE-2": "7.5", "CVE-3": '""'}, "clash"),
    (2, (None, None, None), [], {}, None),
    (3, None, None, None, None),
    (4, (None, None, "q"), None, {"CVE-4": None, "CVE-5": '{"references": {"url": "no array"}, "affected": "x"}', "CVE-6": "{broken"}, None),
]


def test_children(spark, rows):
    df = spark.createDataFrame(CASES, SCHEMA)
    expected = [
        (1, "location", "0"), (1, "hostnames", "0"), (1, "hostnames", "3"), (1, "vulns", "CVE-1"), (1, "vulns", "CVE-2"), (1, "vulns", "CVE-3"),
        (1, "references", "CVE-1/1"), (1, "references", "CVE-1/3"), (1, "affected", "CVE-1/0"), (1, "affected", "CVE-1/1"),
        (1, "ranges", "CVE-1/0/0"), (1, "ranges", "CVE-1/0/2"), (4, "location", "0"), (4, "vulns", "CVE-4"), (4, "vulns", "CVE-5"), (4, "vulns", "CVE-6"),
    ]
    assert rows(nested.children(df)) == sorted(expected, key=repr)


def test_tables_agree_with_children(spark):
    df = spark.createDataFrame(CASES, SCHEMA)
    for name, make in nested.TABLES.items():
        assert make(df).count() == nested.children(df).where(f"child = '{name}'").count(), name
    refs = {(r.place, r.url): r.tags for r in nested.references(df).collect()}
    assert refs == {(1, "u"): ["a", "b"], (3, None): []}
    assert {(r.parent, r.place, r.from_version, r.to_version) for r in nested.ranges(df).collect()} == {(0, 0, "1", None), (0, 2, None, "2")}
    assert {r.cve: r.cvss for r in nested.vulns(df).collect()}["CVE-1"] == 7.5


def test_empty(spark):
    assert nested.children(spark.createDataFrame([], SCHEMA)).isEmpty()
