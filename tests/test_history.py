from datetime import date, datetime

from pyspark.sql import functions as F

from harborlens.operators import history

SCHEMA = "obs_id bigint, ip string, port int, date date, product string, version string, banner_ts timestamp_ntz"


def d(n):
    return date(2025, 9, n)


def ts(h):
    return datetime(2025, 9, 1, h)


def test_versions(spark, rows):
    cases = [
        (1, "a", 1, d(1), "X ", "1", ts(1)), (2, "a", 1, d(1), "y", "1", None), (3, "a", 1, d(2), "x", "1", None), (4, "a", 1, d(5), "x", "2", ts(2)),
        (5, "a", 1, d(5), "x", "3", ts(2)), (6, "a", 1, d(6), "x", "3", ts(1)), (7, "a", 1, d(9), "x", "1", ts(1)), (8, "b", 1, d(3), "z", "1", None), (8, "b", 1, d(3), "z", "1", None),
    ]
    df = spark.createDataFrame(cases, SCHEMA)
    states = history.day_states(df, ["ip", "port"], "date", ["banner_ts", "obs_id"], {"product": F.lower(F.trim("product")), "version": F.lower(F.trim("version"))})
    got = rows(history.versions(states, ["ip", "port"], "date", ["product", "version"]), "ip", "product", "version", "valid_from", "valid_to")
    end = date(9999, 12, 31)
    assert got == sorted([("a", "x", "1", d(1), d(4)), ("a", "x", "3", d(5), d(8)), ("a", "x", "1", d(9), end), ("b", "z", "1", d(3), end)], key=repr)
    events = history.differences(states, ["ip", "port"], "date", ["product", "version"])
    assert {(r.ip, r.event): r["count"] for r in events.groupBy("ip", "event").count().collect()} == {
        ("a", "inserted"): 1, ("a", "unchanged"): 2, ("a", "changed"): 2, ("b", "inserted"): 1,
    }


def test_null_attributes_and_entities(spark, rows):
    states = spark.createDataFrame([(None, d(1), None), (None, d(2), None), (None, d(3), "x"), ("a", d(1), "x")], "k string, day date, v string")
    got = rows(history.versions(states, ["k"], "day", ["v"]), "k", "v", "valid_from")
    assert got == sorted([(None, None, d(1)), (None, "x", d(3)), ("a", "x", d(1))], key=repr)


def test_complete_snapshots_tell_what_is_gone(spark, rows):
    cases = [("a", d(1), "x"), ("a", d(2), "x"), ("a", d(9), "x"), ("b", d(1), "y"), ("b", d(2), "z"), ("b", d(5), "z"), ("c", d(9), None), (None, d(5), "w")]
    states = spark.createDataFrame(cases, "k string, day date, v string")
    got = rows(history.versions(states, ["k"], "day", ["v"], complete=True), "k", "v", "valid_from", "valid_to")
    end = date(9999, 12, 31)  # days 1, 2, 5 and 9 have snapshots
    assert got == sorted([("a", "x", d(1), d(4)), ("a", "x", d(9), end), ("b", "y", d(1), d(1)), ("b", "z", d(2), d(8)), ("c", None, d(9), end), (None, "w", d(5), d(8))], key=repr)
    events = history.differences(states, ["k"], "day", ["v"], complete=True)
    assert rows(events.where("event = 'deleted'"), "k", "day", "v") == sorted([("a", d(5), "x"), ("b", d(9), "z"), (None, d(9), "w")], key=repr)


def test_empty(spark):
    states = spark.createDataFrame([], "k string, day date, v string")
    assert history.versions(states, ["k"], "day", ["v"]).isEmpty()
    assert history.versions(states, ["k"], "day", ["v"], complete=True).isEmpty()
