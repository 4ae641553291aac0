import random
import string
from itertools import combinations

import pytest

from harborlens.llm import names
from harborlens.llm.name_parts import Purpose, Reader, abbreviates, fold, forms, prune

BODIES = [
    ["Fire Protection District 7 of Brodkesh", "BRODKESH FIRE PROT. DIST. NO. 7", "Brodkesh Fire Protection District VII", "Brokdesh Fire Protection Dst #07 (main)"],
    ["Fire Protection District 17 of Brodkesh", "Brodkesh Fire Protection District 17"],
    ["Gavrul Hegdex Academy of Sciences", "Academy of Sciences, Gavrul Hegdex", "The Gavrul Hegdex Acad. of Sciences HQ", "Academy of Sciences (GavrulHegdex)"],
    ["Brodkesh Plastics LLC", "Plastics Brodkesh L.L.C.", "brodkesh plastcis"],
    ["Dr. Margaret Marnronnelm, Optometry", "Dr Margaret Marnronnelm", "Marnronnelm, Peggy Optometry", "M. Marnronelm Optometry", "Maggie Marnronnelm"],
    ["Dr. Theodore Marnronnelm, MD", "Teddy Marnronnelm, MD"],
    ["Robert Zotmarnwut CPA", "Bob Zotmarnwut CPA"],
    ["Robert Zotmarnwut Piano Studio"],
    ["Velmora Fiber Networks", "VFN (Velmora)", "Velmora Fiber Ntwks", "Fiber Networks Velmora", "Velmroa Fiber"],
    ["Water Works of Kirnléñbed", "Kirnlenbed Wtr Wks", "Kirnlénbed_Water Works -"],
    ["Zzyzx", "ZZYZX"],
    ["A. Brittruvnist Optometry", "Britruvnist A., Optometry"],
]


PURPOSES = {
    "fire protection district": "{} Fire Protection District {n}", "elementary school": "{} Elementary School {n}", "academy sciences": "{} Academy of Sciences", "plastics": "{} Plastics LLC",
    "foods": "{} Foods LLC", "water works": "Water Works of {}", "county government": "{} County Government", "printing packaging": "{} Printing and Packaging", "pharmacy": "{} Pharmacy Ltd.",
    "regional medical center": "{} Regional Medical Center", "public library": "{} Public Library", "optometry": "Dr. {g} {}, Optometry", "md": "Dr. {g} {}, MD", "cpa": "{g} {} CPA",
    "piano studio": "{g} {} Piano Studio", "attorney law": "{g} {} Attorney at Law",
}


def background():
    """Bodies enough of each purpose for its words to be common, all far from each other."""
    rng, out = random.Random(11), []
    for form in PURPOSES.values():
        for i in range(14):
            core = "".join(rng.choice("bdfgklmnprstvz") + rng.choice("aeiou") for _ in range(7)).title()
            out += [form.format(core, n=i + 1, g=rng.choice(["Andrew", "Walter", "Susan", "Daniel"]))] * 2 + [form.format(core, n=i + 30, g="Peter").upper()]
    return out


@pytest.fixture(scope="module")
def purposes(spark):
    df = spark.createDataFrame([(n,) for n in background()], "org string")
    return names.learn(names.cut(names.folded(names.spellings(df, ["org"]))))


def test_learnt_purposes(purposes):
    assert {" ".join(p.words) for p in purposes} == set(PURPOSES)
    person = {"optometry", "md", "cpa", "piano studio", "attorney law"}
    assert {" ".join(p.words) for p in purposes if p.person} == person
    assert {" ".join(p.words) for p in purposes if p.doctor} == {"optometry", "md"}
    assert {" ".join(p.words) for p in purposes if p.numbered} == {"fire protection district", "elementary school"}


def test_prune():
    found = {("water", "works"): 50, ("wtr", "works"): 9, ("works",): 6, ("logistics",): 40, ("international", "logistics"): 30, ("works", "water"): 7, ("intl", "logistics"): 8}
    assert prune(found, 0.5) == [("international", "logistics"), ("logistics",), ("water", "works")]
    assert abbreviates("mgmt", "management") and not abbreviates("m", "management") and not abbreviates("gmt", "management")


def linked_pairs(spark, spelt):
    df = spark.createDataFrame([(n, None) for n in spelt] + [(n, n) for n in background()], "org string, isp string")
    return {p for p in map(tuple, names.pairs(names.link(df, ["org", "isp"])).collect()) if set(p) & set(spelt)}


def together(*bodies):
    return {tuple(sorted(p)) for body in bodies for p in combinations(set(body), 2)}


def test_bodies(spark):
    spelt = [n for b in BODIES for n in b]
    cases = [(i, n, None if i % 3 else "  ", n) for i, n in enumerate(spelt + background())] + [(99, None, "", None), (100, " ", "...", "x"), (101, BODIES[0][0], BODIES[0][0], "")]
    df = spark.createDataFrame(cases, "id int, org string, isp string, name string")
    linked = names.cut(names.link(df, ["org", "isp"]))
    got = {p for p in map(tuple, names.pairs(linked).collect()) if set(p) & set(spelt)}
    assert got == together(*BODIES)
    assert linked.count() == len(set(spelt + background()))


def test_names_without_a_known_purpose(spark):
    apart = ["Acme Hardware", "Zeta Hardware", "Kelso Roofing", "Velmora Wireless", "Velmora Data Centers", "Acme Hosting", "Quarnby Fish Nets", "Quarnby Fast Nails", "QFN (Quarnby)"]
    bodies = [["Velmora Fiber Networks", "VFN (Velmora)", "VFN (Velmroa)", "Networks, Velmora Fiber"], ["Harlan Peabody Roofing", "Roofing, Peabody Harlan", "Harlan Peabody Rfg", "Harlna Peabody Roofing"]]
    assert linked_pairs(spark, apart + bodies[0] + bodies[1]) == together(*bodies)
    # a shorter name joins the only one that it lacks a word of, and none of two
    assert linked_pairs(spark, ["Kolbrand Server Rental", "Kolbrand Server", "Quarnby Tile", "Quarnby Tile Stores", "Quarnby Tile Glazing"]) == together(["Kolbrand Server Rental", "Kolbrand Server"])


def test_names_of_common_words_alone(spark):
    assert linked_pairs(spark, ["Public Library", "PUBLIC LIBRARY", "Water Works", "The Water Works"]) == together(["Public Library", "PUBLIC LIBRARY"], ["Water Works", "The Water Works"])


def test_few_names_have_no_purpose(spark):
    df = spark.createDataFrame([("Zzyzx Savings Bank", "Savings Bank of Zzyzx"), ("Zzyzx Svgs Bank", "Brod Savings Bank")], "org string, isp string")
    got = {tuple(r) for r in names.pairs(names.link(df, ["org", "isp"])).collect()}
    assert got == together(["Zzyzx Savings Bank", "Savings Bank of Zzyzx", "Zzyzx Svgs Bank"])


@pytest.mark.parametrize(
    "name,purpose,number,given,core",
    [
        ("Hegsinpunhith K., Attoney at Law", "attorney law", "", "", "hegsinpunhith"),
        ("CPA Dorothy Ronbrodtosron", "cpa", "", "dorothy", "ronbrodtosron"),
        ("Reg. Med Ctr of Fevkulm", "regional medical center", "", "", "fevkulm"),
        ("Cnty Gov't - Brodgig Tenlash", "county government", "", "", "brodgigtenlash"),
        ("Elem. School IV, Lernvuk", "elementary school", "4", "", "lernvuk"),
        ("Printing & Packaging of Hithrast", "printing packaging", "", "", "hithrast"),
        ("Zudmarnhosh Pharmacy Ltd. Liability Co", "pharmacy", "", "", "zudmarnhosh"),
    ],
)
def test_parts(purposes, name, purpose, number, given, core):
    p = Reader(purposes).parse(fold(name))
    assert (p.purpose, p.number, p.given, p.core) == (purpose, number, given, core)


def test_a_reader_without_purposes():
    p = Reader([]).parse(fold("The Kelso Roofing Co."))
    assert (p.kind, p.core) == ("other", "kelso roofing co") and {f.anchor for f in p.forms if f.role == "whole"} == {"kelsoroofingco", "cokelsoroofing", "kelso", "co"}
    assert forms([]) == [] and Reader([Purpose(("x",), False, False, False)]).parse([]).core == ""


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (x != y)))
    return row[-1]


def test_radius_join_against_brute_force(spark):
    rng = random.Random(7)
    words = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 12))) for _ in range(150)}
    for w in list(words)[:60]:
        i = rng.randrange(len(w))
        words.add(w[:i] + rng.choice(string.ascii_lowercase) + w[i + rng.randrange(2) :])
    points = [(b, w) for b in ("x", "y") for w in words]
    df = spark.createDataFrame(points, "block string, core string")
    got = {(r.block, r.core, r.other, r.d) for r in names.radius_join(df, df).collect()}
    expected = set()
    for block in ("x", "y"):
        for a in words:
            for b in words:
                reach = min(names.RADIUS, min(len(a), len(b)) // names.LETTERS_AN_EDIT)
                if a != b and (d := levenshtein(a, b)) <= reach:
                    expected.add((block, a, b, d))
    assert got == expected


def test_mistyped_core_that_two_spellings_share(spark):
    body = ["Nandwalzasrast Foods LLC", "NANDWALZASRAST FOODS", "Nandwalzasrast Foods, L.L.C.", "Nadnwalzasrast Foods LLC", "NADNWALZASRAST FOODS, L.L.C."]
    assert linked_pairs(spark, body) == {tuple(sorted(p)) for p in combinations(body, 2)}


def test_chain_beside_a_member(spark):
    # the last core is one edit from the second and three from the first, which three spellings share
    body = ["Nandwalzasrast Foods LLC", "NANDWALZASRAST FOODS", "Nandwalzasrast Foods, L.L.C.", "Nadnwalzasrast Foods LLC", "Nadnwalzaasrast Foods LLC"]
    assert linked_pairs(spark, body) == {tuple(sorted(p)) for p in combinations(body, 2)}


def test_components_of_long_chains(spark):
    rng = random.Random(3)
    order = [f"c{i:03}" for i in rng.sample(range(200), 60)]
    links = [("x", a, b) for a, b in zip(order[:40], order[1:40], strict=False)] + [("x", a, b) for a, b in zip(order[40:], order[41:], strict=False)] + [("y", order[0], order[59])]
    df = spark.createDataFrame(links + [(k, b, a) for k, a, b in links], "block string, core string, other string")
    got = {(r.block, r.core): r.root for r in names.components(df).collect()}
    assert got == {("x", c): min(part) for part in (order[:40], order[40:]) for c in part} | {("y", c): min(order[0], order[59]) for c in (order[0], order[59])}


def test_initials_by_components_and_through_names_that_found_a_person(spark):
    # the outer two of three are two edits from the middle one and four from each other
    alone = ["Q. Zabrindolvek Optometry", "Q. Zarbindolvek Optometry", "Q. Zarbindovlek Optometry"]
    person = ["Margaret Hegsinpunhith Optometry", "M. Hegsipnunhith Optometry", "M. Hegsipnunhtih Optometry"]
    torn = ["Alice Kirnmarnlosh Optometry", "Arthur Kirnmarnlosh Optometry", "A. Kirnmarnlosh Optometry"]
    expected = {tuple(sorted(p)) for body in (alone, person) for p in combinations(body, 2)}
    assert linked_pairs(spark, alone + person + torn) == expected


def test_empty(spark):
    df = spark.createDataFrame([], "org string, isp string")
    assert names.pairs(names.link(df, ["org", "isp"])).isEmpty()


def test_very_long_names(spark):
    long = ["w" + " x".join(map(str, range(5000))), "z" * 200_000, "Z" * 200_000, "z" * 199_999 + "y", "q" * 1999, "q" * 1998, "public library " * 300]
    assert linked_pairs(spark, long) == together(long[1:3], long[4:6])


def test_queries_against_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    from harborlens.llm.queries import ORACLE, QUERIES

    db = duckdb.connect()
    db.execute("create view observations as select * from '/root/testdata/sf0.001/observations.parquet'")
    for name in ("p1_radius", "p1_components"):
        df = QUERIES[name](spark, "/root/testdata/sf0.001")
        assert sorted(map(tuple, df.collect())) == sorted(db.execute(f"select {', '.join(df.columns)} from ({ORACLE[name]})").fetchall())
