import pytest
from pyspark.sql import functions as F

from harborlens.operators.classify import classify, named_ports, score

COMMERCIAL, BULK = "commercial org, not gov/edu/infra", "bulk network address space, no customer identity"
CASES = [
    (None, None, None, [502, 20000], "critical_infrastructure", "ICS protocol exposed: Modbus, DNP3"),
    ("Baton Water Co", [], [], [80], "critical_infrastructure", "keyword 'water'"),
    (None, [], ["x.gov"], [80], "government", "gov domain"),
    (None, [], ["hospital.gov"], [80], "critical_infrastructure", "keyword 'hospital'"),
    ("Sheriff Office", [], [], [22], "government", "keyword 'sheriff'"),
    ("Acadia Realty", [], [], [80], "government", "parish 'acadia'"),
    (None, [], ["x.edu"], [80], "education", "edu domain"),
    ("Amazon", [], ["tulane.example"], [80], "education", "keyword 'tulane' (via customer domain)"),
    ("Cox", ["dhcp-1.example"], [], [80], "residential", "consumer ISP / dynamic rDNS"),
    ("Cox", [], [], [80], "residential", "consumer ISP / dynamic rDNS"),
    ("Cox", ["mail.acme.example"], ["acme.example"], [80], "small_business", COMMERCIAL),
    ("Zeta Bakery", [], [], [80], "small_business", COMMERCIAL),
    ("Cloudflare", [], [], [80], "unclassified", BULK),
    (None, [], [], [80], "unclassified", "no attribution signal"),
    ("", None, None, None, "unclassified", "no attribution signal"),
    ("Support of Friends", [], [], [80], "critical_infrastructure", "keyword 'port of'"),
    (None, [], ["X.GOV"], [80], "small_business", COMMERCIAL),
    ("Amazon", [], ["port", "of.example"], [], "small_business", COMMERCIAL),
]


@pytest.fixture(scope="module")
def classified(spark):
    df = spark.createDataFrame([(i, *c[:4]) for i, c in enumerate(CASES)], "i int, org string, hostnames array<string>, domains array<string>, ports array<int>")
    return {r.i: r for r in df.select("i", classify(F.col("org"), F.col("hostnames"), F.col("domains"), F.col("ports")).alias("t")).select("i", "t.*").collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_cascade(classified, i):
    assert (classified[i].tier, classified[i].reason) == CASES[i][4:]


def test_score_and_port_names(spark):
    row = spark.range(1).select(
        score(F.lit(2), F.lit(1), F.lit(1), F.lit(1), F.lit(0.99)).alias("s"),
        named_ports(F.array(F.lit(23), F.lit(21), F.lit(80)), {23: "telnet", 21: "FTP"}).alias("sorted"),
        named_ports(F.array(F.lit(23), F.lit(21), F.lit(80)), {23: "telnet", 21: "FTP"}, True).alias("listed"),
    ).head()
    assert (row.s, row.sorted, row.listed) == (200 + 40 + 15 + 25 + 49, ["FTP", "telnet"], ["telnet", "FTP"])
