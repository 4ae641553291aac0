"""Sector of a host by an ordered cascade over its identity, and its score.

Hosts are classified, never banners: the keyword search runs once per host, in built-in string expressions.

Defined cases
    * keywords are substrings of the joined, lower-cased text; suffixes are case-sensitive and looked for in domains only.
    * a null org and empty lists are absent; the first rule that matches decides.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from harborlens.functions.text import given, joined

# Port names and word lists, in the order in which they are tried.
ICS_PORTS = {502: "Modbus", 20000: "DNP3", 47808: "BACnet", 102: "S7comm", 44818: "EtherNet/IP", 1911: "Niagara/Tridium", 2404: "IEC-104", 789: "Red Lion", 1962: "PCWorx", 9600: "OMRON-FINS", 20547: "ProconOS"}
ADMIN_PORTS = {23: "telnet", 3389: "RDP", 5900: "VNC", 21: "FTP", 512: "rexec", 513: "rlogin", 514: "rsh"}
DB_PORTS = {3306: "MySQL", 5432: "Postgres", 27017: "MongoDB", 6379: "Redis", 9200: "Elasticsearch", 1433: "MSSQL", 11211: "memcached", 5984: "CouchDB", 9042: "Cassandra"}
ICS_QUERY_PORTS = [502, 20000, 47808, 102, 44818, 1911, 2404, 789]
TIERS = ["critical_infrastructure", "government", "education", "small_business", "residential", "unclassified"]
CRITICAL = [
    "water", "sewer", "sewage", "wastewater", "electric", "power", "energy", "utility", "utilities", "co-op", "coop", "pipeline", "port of", "airport", "transit",
    "levee", "hospital", "health", "medical", "clinic", "healthcare", "emergency", "dispatch", "scada", "treatment", "substation", "natural gas", "waterworks",
    "sewerage", "ambulance", "911",
]
GOVERNMENT = [
    "parish", "city of", "town of", "village of", "municipal", "sheriff", "police", "court", "clerk of", "assessor", "registrar", "department of", "dept of",
    "governor", "legislature", "council", "district attorney", "coroner", "detention", "fire dept", "fire district", "state of louisiana", "office of",
    "secretary of state", "dmv", "dotd", "dhh",
]
EDUCATION = [
    "school", "university", "college", "academy", "isd", "campus", "board of education", "community college", "lsu", "tulane", "southern university",
    "louisiana tech", "mcneese", "nicholls", "k-12",
]
CONSUMER = [
    "cox", "charter", "spectrum", "comcast", "at&t", "att internet", "verizon", "centurylink", "lumen", "sparklight", "cable one", "optimum", "altice", "t-mobile",
    "rev", "eatel", "lus fiber", "volt broadband", "uniti", "catcomm", "vexus", "allo",
]
DYNAMIC = ["dhcp", "dyn", "cpe.", "res.", "client.", "pool", "broadband", "biz.rr", ".rr.com", "hsd1", "static.", "customer"]
TRANSIT = [
    "level 3", "level3", "cogent", "hurricane electric", "he.net", "zayo", "gtt communications", "tata communications", "ntt america", "windstream",
    "frontier communications", "consolidated communications", "amazon", "aws", "google llc", "google cloud", "microsoft corporation", "azure", "cloudflare", "akamai",
    "fastly", "digitalocean", "linode", "ovh", "hetzner", "vultr", "hostgator", "bluehost", "godaddy", "unified layer", "namecheap", "leaseweb", "immense networks",
    "psychz", "quadranet",
]
PARISHES = [
    "acadia", "allen", "ascension", "assumption", "avoyelles", "beauregard", "bienville", "bossier", "caddo", "calcasieu", "caldwell", "cameron", "catahoula",
    "claiborne", "concordia", "desoto", "east baton rouge", "east carroll", "east feliciana", "evangeline", "franklin", "grant", "iberia", "iberville", "jackson",
    "jefferson", "lafayette", "lafourche", "lasalle", "lincoln", "livingston", "madison", "morehouse", "natchitoches", "orleans", "ouachita", "plaquemines",
    "pointe coupee", "rapides", "red river", "richland", "sabine", "st bernard", "st charles", "st helena", "st james", "st john", "st landry", "st martin", "st mary",
    "st tammany", "tangipahoa", "tensas", "terrebonne", "union", "vermilion", "vernon", "washington", "webster", "west baton rouge", "west carroll", "west feliciana",
    "winn",
]
GOVERNMENT_SUFFIXES, EDUCATION_SUFFIXES = [".gov", ".state.la.us"], [".edu", ".k12.la.us"]


def _list(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def first_word(text: Column, words: list[str]) -> Column:
    """The first of the words, in list order, that the text contains."""
    return F.get(F.filter(_list(words), lambda w: F.contains(text, w)), F.lit(0))


def any_word(text: Column, words: list[str]) -> Column:
    return F.exists(_list(words), lambda w: F.contains(text, w))


def named_ports(ports: Column, names: dict[int, str], in_order: bool = False) -> Column:
    """Names of the listed ports among ports: in the list's order, or each once, sorted."""
    pairs = F.array(*[F.struct(F.lit(p).alias("port"), F.lit(n).alias("name")) for p, n in names.items()])
    found = F.transform(F.filter(pairs, lambda p: F.array_contains(ports, p["port"])), lambda p: p["name"])
    return found if in_order else F.array_sort(F.array_distinct(found))


def let(value: Column, body) -> Column:
    """body(value), with value made once however often body mentions it."""
    return F.transform(F.array(value), body)[0]


def classify(org: Column, hostnames: Column, domains: Column, ports: Column) -> Column:
    """struct(tier, reason). Each text is built, and each list searched, once per host."""
    ports = F.coalesce(F.array_compact(ports), F.array().cast("array<int>"))
    read = F.struct(F.lower(F.coalesce(org, F.lit(""))).alias("org"), F.array_sort(given(hostnames)).alias("hosts"), F.array_sort(given(domains)).alias("domains"), F.array_join(named_ports(ports, ICS_PORTS, in_order=True), ", ").alias("ics"))
    return let(read, _identify)


def _identify(h: Column) -> Column:
    lists = F.filter(F.array(joined(h["hosts"], " "), joined(h["domains"], " ")), lambda x: x != "")
    seen = F.struct(F.lower(F.array_join(lists, " ")).alias("identity"), any_word(h["org"], CONSUMER + TRANSIT).alias("bulk"), any_word(h["org"], CONSUMER).alias("consumer"))
    return let(seen, lambda s: let(F.when(s["bulk"], s["identity"]).otherwise(F.concat(s["identity"], F.lit(" "), h["org"])), lambda text: _search(h, s, text)))


def _search(h: Column, s: Column, text: Column) -> Column:
    words = F.struct(*[first_word(text, lst).alias(k) for k, lst in (("critical", CRITICAL), ("government", GOVERNMENT), ("parish", PARISHES), ("education", EDUCATION))])
    return let(words, lambda w: _decide(h, s, w))


def _decide(h: Column, s: Column, w: Column) -> Column:
    via = F.when(s["bulk"], F.lit(" (via customer domain)")).otherwise(F.lit(""))

    def ends(suffixes: list[str]) -> Column:
        return F.exists(h["domains"], lambda d: F.exists(_list(suffixes), lambda x: F.endswith(d, x)))

    def out(tier: str, reason: Column) -> Column:
        return F.struct(F.lit(tier).alias("tier"), reason.alias("reason"))

    def keyword(kind: str, word: Column) -> Column:
        return F.concat(F.lit(f"{kind} '"), word, F.lit("'"), via)

    # the reasons are fixed values: output that must match
    nameless = (F.size(h["hosts"]) == 0) & (F.size(h["domains"]) == 0)
    return (
        F.when(h["ics"] != "", out("critical_infrastructure", F.concat(F.lit("ICS protocol exposed: "), h["ics"])))
        .when(w["critical"].isNotNull(), out("critical_infrastructure", keyword("keyword", w["critical"])))
        .when(ends(GOVERNMENT_SUFFIXES), out("government", F.lit("gov domain")))
        .when(w["government"].isNotNull(), out("government", keyword("keyword", w["government"])))
        .when(w["parish"].isNotNull(), out("government", keyword("parish", w["parish"])))
        .when(ends(EDUCATION_SUFFIXES), out("education", F.lit("edu domain")))
        .when(w["education"].isNotNull(), out("education", keyword("keyword", w["education"])))
        .when(s["consumer"] & (any_word(s["identity"], DYNAMIC) | nameless), out("residential", F.lit("consumer ISP / dynamic rDNS")))
        .when((F.trim(s["identity"]) != "") | ((F.trim(h["org"]) != "") & ~s["bulk"]), out("small_business", F.lit("commercial org, not gov/edu/infra")))
        .when(F.trim(h["org"]) != "", out("unclassified", F.lit("bulk network address space, no customer identity")))
        .otherwise(out("unclassified", F.lit("no attribution signal")))
    )


def score(kev: Column, ics: Column, admin: Column, databases: Column, epss: Column) -> Column:
    """Counts weighted, plus fifty times the worst probability, cut to a whole number."""
    return (kev * 100 + ics * 40 + admin * 15 + databases * 25 + F.floor(epss * 50)).cast("bigint")
