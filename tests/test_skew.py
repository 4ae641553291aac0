from collections import Counter, defaultdict
from math import ceil

from harborlens.operators import skew


def test_profile_against_brute_force(spark):
    cases = [("hot", "AS1", i % 7, f"10.0.0.{i % 50}") for i in range(900)] + [("b", "AS2", 5, None), ("b", None, None, "x"), (None, "AS1", 1, "y"), (" ", "AS2", 1, "y"), ("", None, 2, "z"), ("c", "AS3", None, None)]
    df = spark.createDataFrame(cases, "org string, asn string, port int, ip string")
    got = {(r.field, r.key_value): r for r in skew.profile(df, ["org", "asn"], "port", "ip").collect()}
    groups = defaultdict(list)
    for org, asn, port, ip in cases:
        for field, key in (("org", org), ("asn", asn)):
            if key and key.strip():
                groups[field, key].append((port, ip))
    assert got.keys() == groups.keys()
    for key, rows in groups.items():
        ports = sorted(p for p, _ in rows if p is not None)
        r = got[key]
        assert (r.n_rows, r.n_port, r.n_ip) == (len(rows), len(set(ports)), len({i for _, i in rows if i is not None}))
        if not ports:
            assert r.mode_port is r.p50_port is r.p90_port is None
            continue
        top = max(Counter(ports).values())
        assert r.mode_port == min(p for p, n in Counter(ports).items() if n == top)
        assert (r.p50_port, r.p90_port) == tuple(ports[ceil(len(ports) * q) - 1] for q in (0.5, 0.9))


def test_hot_keys(spark, rows):
    df = spark.createDataFrame([("a", "x", 1)] * 4 + [("b", "y", 2)] * 95 + [(None, None, 3)], "org string, asn string, port int")
    assert rows(skew.hot_keys(df, ["org", "asn"], "port", 0.04), "field", "key_value", "n_rows") == sorted([("org", "a", 4), ("asn", "x", 4), ("org", "b", 95), ("asn", "y", 95)], key=repr)


def test_empty(spark):
    df = spark.createDataFrame([], "org string, asn string, port int, ip string")
    assert skew.profile(df, ["org", "asn"], "port", "ip").isEmpty() and skew.hot_keys(df, ["org"], "port", 0.1).isEmpty()
