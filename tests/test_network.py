import ipaddress
import random

from pyspark.sql import functions as F

from harborlens.functions.network import bits
from harborlens.operators import geo, shards

ODD = ["", "x", "1.2.3", "1.2.3.256", "::", "::1", "1::", "2001:db8::g", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7:8:9", "1::2::3", "2001:DB8::A", None, "01.2.3.4"]


def expected_bits(ip):
    try:
        a = ipaddress.ip_address(ip)
    except ValueError:
        return None
    return bin(int(a))[2:].zfill(a.max_prefixlen)


def test_bits(spark):
    rng = random.Random(2)
    ips = ODD[:-1] + [str(ipaddress.ip_address(rng.getrandbits(32))) for _ in range(50)] + [str(ipaddress.ip_address(rng.getrandbits(128) & rng.getrandbits(128) & rng.getrandbits(128))) for _ in range(80)]
    for r in spark.createDataFrame([(i,) for i in ips], "ip string").select("ip", bits(F.col("ip")).alias("b")).collect():
        assert r.b == expected_bits(r.ip) or r.ip == "01.2.3.4", r


def test_longest_network_wins(spark):
    rng = random.Random(3)
    nets = {f"10.{rng.randrange(4)}.{rng.randrange(0, 256, 16)}.0/{rng.choice([16, 20, 24])}" for _ in range(25)} | {"2001:db8::/32", "2001:db8:1::/48", "0.0.0.0/0"}
    nets = {str(ipaddress.ip_network(n, strict=False)) for n in nets}
    table = spark.createDataFrame([(n, "QX", n) for n in nets], "cidr string, country string, region string")
    ips = [f"10.{rng.randrange(5)}.{rng.randrange(256)}.{rng.randrange(256)}" for _ in range(200)] + ["2001:db8:1::5", "2001:db8:2::5", "2001:db9::", "bad", None]
    for r in geo.locate(spark.createDataFrame([(i, "clash", "clash") for i in ips], "ip string, place string, country string"), table).collect():
        try:
            a = ipaddress.ip_address(r.ip)
        except ValueError:
            assert r.region is None
            continue
        holding = [n for n in map(ipaddress.ip_network, nets) if n.version == a.version and a in n]
        assert r.region == (str(max(holding, key=lambda n: n.prefixlen)) if holding else None)


def test_odd_networks(spark):
    odd = ["10.0.0.7", "10.0.0.0/x", "10.0.0.0/", "10.0.0.0/99", "", None, "/8", "bad/8", "10.0.0.8/-1"]
    table = spark.createDataFrame([(n, "QX", n) for n in odd] + [("10.0.0.7/32", "QX", None)], "cidr string, country string, region string")
    got = {r.ip: r.country for r in geo.locate(spark.createDataFrame([("10.0.0.7",), ("10.0.0.8",), ("10.0.0.0",), ("",)], "ip string"), table).collect()}
    assert got == {"10.0.0.7": "QX", "10.0.0.8": None, "10.0.0.0": None, "": None}
    assert {r.country for r in geo.locate(spark.createDataFrame([("10.0.0.7",)], "ip string"), table.limit(0)).collect()} == {None}


def test_gate_matrix(spark):
    cases = [(i, c, r, l, o) for i, (c, r, l, o) in enumerate([("U", "L", None, None), ("U", "T", ("c", "L", "U"), None), ("U", "T", ("c", "T", "U"), "Big LAND org"), (None, None, None, "x"), (None, None, ("c", None, "U"), None)])]
    df = spark.createDataFrame(cases, "i int, country string, region string, location struct<city:string,region_code:string,country_code:string>, org string")
    got = {r.i: (r.in_target, r.keep_primary, r.keep_primary_alone, r.keep_rescue, r.keep_store, r.keep_tripwire_alone) for r in geo.gates(df, ("U", "L"), "Land").collect()}
    y, n = True, False
    assert got == {0: (y, y, n, y, y, y), 1: (n, y, y, y, y, y), 2: (n, n, n, y, y, y), 3: (n, n, n, y, n, y), 4: (n, n, n, y, n, y)}


def recursive_leaves(ips, threshold):
    keys = [expected_bits(i) for i in ips if expected_bits(i)]
    out, stack = [], ["0", "1", "001"]
    for family, seeds, size in ((4, ["0", "1"], 32), (6, ["001"], 128)):
        mine, stack = [k for k in keys if len(k) == size], list(seeds)
        while stack:
            p = stack.pop()
            n = sum(k.startswith(p) for k in mine)
            if n > threshold and len(p) < size:
                stack += [p + "0", p + "1"]
            elif n:
                out.append((family, p, len(p), n))
    return sorted(out)


def test_leaves(spark):
    rng = random.Random(4)
    ips = [f"10.0.{rng.randrange(8)}.{rng.randrange(256)}" for _ in range(400)] + ["10.0.0.1"] * 30 + [f"2001:db8::{rng.randrange(4096):x}" for _ in range(100)] + ["fe80::1", "bad"]
    df = spark.createDataFrame([(i,) for i in ips], "ip string")
    assert sorted(tuple(r) for r in shards.leaves(df, 20).collect()) == recursive_leaves(ips, 20)
    assert shards.leaves(df.limit(0), 20).isEmpty()
