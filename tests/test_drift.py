import json

from harborlens.operators import drift


def lines(files):
    return [(f"f-events-2025-01-0{day}.json.gz", i, r if isinstance(r, str) else json.dumps(r), "clash") for day, records in files.items() for i, r in enumerate(records)]


FILES = {
    1: [{"ip_str": "1", "version": "1.2.3", "tags": ["a", "b"], "port": 1, "info": "login page"}] * 3 + ["{broken", "3", "[1]", "null"],
    2: [{"ip_str": "1", "ver": "4.5.6", "tags": {"a": True}, "port": 2, "info": None, "os": "Lantern OS 5"}] * 3 + [{"ip_str": "2", "ver": "4.5.6", "tags": ["a"], "port": "2"}],
    4: [{"ip_str": "1", "ver": {"major": 4, "minor": 5}, "port": "7", "Port": 9}] * 2,
    5: ["broken only"],
}


def test_changes(spark, rows):
    df = spark.createDataFrame(lines(FILES), "src_file string, line_no int, record string, field string")
    f = "f-events-2025-01-0{}.json.gz".format
    expected = [
        (f(2), "renamed", "version", "ver"), (f(2), "retyped", "tags", "tags"), (f(2), "removed", "info", ""), (f(2), "added", "", "os"),
        (f(4), "retyped", "ver", "ver"), (f(4), "retyped", "port", "port"), (f(4), "removed", "tags", ""), (f(4), "removed", "os", ""), (f(4), "added", "", "Port"),
        (f(5), "removed", "ip_str", ""), (f(5), "removed", "ver", ""), (f(5), "removed", "port", ""), (f(5), "removed", "Port", ""),
    ]
    assert rows(drift.changes(drift.ingest(df), df)) == sorted(expected, key=repr)
    assert {r.src_file[-9]: r.n_broken for r in drift.broken_lines(df).collect()} == {"1": 4, "2": 0, "4": 0, "5": 1}


def test_ingest_and_replay(spark):
    df = spark.createDataFrame(lines(FILES), "src_file string, line_no int, record string, field string")
    target = {"ip_str": "string", "version": "string", "tags": "array<string>", "port": "int"}
    raw = drift.ingest(df, target)
    report = drift.changes(raw, df, target)
    assert [tuple(r) for r in drift.proposals(report, target).collect()] == [("f", "ver", "version", 1)]
    got = {(r.src_file[-9], r.line_no): r for r in drift.replay(raw, [("f", "ver", "version")], target).collect()}
    other = {(r.src_file[-9], r.line_no): r for r in drift.replay(raw, [("g", "ver", "version")], target).collect()}
    assert other["2", 0].version is None and other["2", 0].rescued["ver"] == '"4.5.6"' and other["2", 3].port == 2  # approved for another feed
    assert len(got) == 3 + 4 + 2
    assert (got["1", 0].version, got["1", 0].tags, got["1", 0].port, got["1", 0].rescued) == ("1.2.3", ["a", "b"], 1, {"info": '"login page"'})
    assert (got["2", 0].version, got["2", 0].tags, got["2", 0].rescued) == ("4.5.6", ["a"], {"os": '"Lantern OS 5"'})
    assert (got["2", 3].port, got["4", 0].version, got["4", 0].port, got["4", 0].rescued) == (2, "4.5", 7, {"Port": "9"})
    before = {(r.src_file[-9], r.line_no): r for r in raw.collect()}
    assert before["4", 0].port is None and before["4", 0].rescued == {"ver": '{"major":4,"minor":5}', "port": '"7"', "Port": "9"}


def test_empty(spark):
    df = spark.createDataFrame([], "src_file string, line_no int, record string")
    assert drift.changes(drift.ingest(df), df).isEmpty() and drift.ingest(df).isEmpty()


def test_objects_with_unknown_keys_and_fields_of_one_name_in_two_cases(spark):
    records = [{"location": {"city": "X", "planet": 3}, "Port": 1, "port": 2}, {"location": {"city": "Y"}, "port": 2.5}, {"location": "Z", "ver": 7.0, "n": -1.50}]
    df = spark.createDataFrame(lines({1: records}), "src_file string, line_no int, record string, field string")
    got = {r.line_no: r for r in drift.ingest(df, {"port": "int", "location": drift.TARGET["location"]}).collect()}
    assert got[0].location is None and json.loads(got[0].rescued["location"]) == records[0]["location"] and got[0].port == 2 and got[0].rescued["Port"] == "1"
    assert got[1].location.city == "Y" and got[1].port is None and got[1].rescued == {"port": "2.5"} and got[2].rescued == {"location": '"Z"', "ver": "7.0", "n": "-1.5"}


def test_contents_over_all_files_tell_a_rename_that_one_file_cannot(spark, rows):
    words = ["alder net", "birch line", "cedar link", "dogwood web"]
    files = {d: [{"isp": w} for w in words] for d in (1, 3, 5)} | {d: [{"carrier": w} for w in words] for d in (2, 4)} | {6: [{"isp": "alder net"}], 7: [{"carrier": "birch line"}]}
    df = spark.createDataFrame(lines(files), "src_file string, line_no int, record string, field string")
    got = rows(drift.changes(drift.ingest(df), df).where("src_file like '%07.json.gz'"), "change_kind", "old_field", "new_field")
    assert got == [("renamed", "isp", "carrier")]
