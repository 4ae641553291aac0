from harborlens.operators import hosts

SCHEMA = "rec_id bigint, date string, ip_str string, port int, org string, city string, product string, hostnames array<string>, domains array<string>, vulns map<string,string>, ip string"


def banner(i, ip, port, org=None):
    return (i, "d", ip, port, org, None, None, None, [None, "x"], None, "clash")


def test_honeypots_by_the_number_of_ports(spark):
    rows = [banner(i, "many", i) for i in range(101)] + [banner(200 + i, "just", i) for i in range(100)] + [banner(400 + i, "null", i if i else None) for i in range(101)]
    rows += [banner(600 + i, "again", 1, "o") for i in range(300)] + [banner(999, "", 5), banner(998, None, 5)]
    found = hosts.aggregate_hosts(spark.createDataFrame(rows, SCHEMA), ["date"])
    assert {r.ip: r.n_ports for r in found.collect()} == {"many": 101, "just": 100, "null": 101, "again": 1}
    assert {r.ip for r in hosts.without_honeypots(found).collect()} == {"just", "again"}
    assert {r.ip for r in hosts.without_honeypots(found, 1).collect()} == {"again"}


def test_first_given_values_and_sets(spark):
    rows = [banner(3, "a", 1, "late"), banner(1, "a", 2, ""), banner(2, "a", None, "first")]
    host = hosts.aggregate_hosts(spark.createDataFrame(rows, SCHEMA), ["date"]).head()
    assert (host.org, host.city, host.ports, host.domains, host.hostnames, host.cves, host.n_ports, host.n_banners) == ("first", None, [1, 2], ["x"], [], [], 3, 3)
    assert hosts.aggregate_hosts(spark.createDataFrame([], SCHEMA), ["date"]).isEmpty()
