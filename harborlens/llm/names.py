"""Spellings of bodies' names that belong together, by exact radius joins in an edit metric.

What names say beside the distinctive rest is learned from the table itself. A word is common if it stands beside many different
rarer words; the sequences of common words that many names hold are purposes ("school district"), unless they are damaged
forms of more frequent ones; and the names that hold a purpose show whether it is a person's, a doctor's or a numbered one.
Each distinct name is then read into purpose, number, given name and core; names of different purpose, number or given name
never meet. Within such a block every core is joined with all others within the radius (Levenshtein), and the components of
these links, followed to the fixpoint, are the bodies. No core stands for others: a core that several spellings share and one
that is met once are joined alike. A core is joined in the order written and in order of the alphabet.

A name without a purpose is met from one of its words, the anchor, within the radius, by names whose other words begin
alike and are the same, abbreviated or mistyped one by one. One that lacks a word of exactly one such body, or is an
acronym of exactly one beside its anchor, joins it.

Which cores lie within the radius is found without comparing all pairs: a core cut in radius + 1 segments must share one
of them, shifted by at most what the radius allows, with every core in reach (both sides are unique by core, so no join key
holds more than a share of the distinct names). The candidates are then checked with the exact distance.

Defined cases
    * null and blank names, and names without a letter or digit, are no names and have no row.
    * equal strings of both columns are one spelling, however often it occurs.
    * a name of nothing but common words has an empty core, which is equal to no other core; such names of one purpose belong together.
    * a practice's name without its purpose joins the one body of that person, if there is exactly one.
    * a name with only the initial of its given name joins the nearest fitting person of that purpose, if only one is nearest;
      without one in reach, such names of one purpose and initial that chains within the radius join belong together, and go with
      the nearest such name that found its person, if only one person is nearest. Names between two persons go with neither.
    * a name whose core has more than 2,000 letters (LONGEST) belongs together with those of the same core alone.
    * a name of more than 32 words (MOST_WORDS) is met as a whole and by its ends, and not by names that lack a word of it.
    * in a table of few names no word is common, and all are compared as names without a purpose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harborlens.llm.name_parts import GIVEN, Purpose, prune
from harborlens.session import cut, written

#: Two cores are linked within RADIUS edits and within a third of the shorter one's letters; beyond LONGEST letters they must be equal.
RADIUS, LETTERS_AN_EDIT, LONGEST = 2, 3, 2000
#: A word is common, and a phrase a purpose, that stands beside so many different others, or beside such a share of the distinct names if that is more.
#: The share bounds what the driver gets: at most 1 / SHARE phrases, and 1 / SHARE words for each word that names have on average.
LEAST, SHARE = 5, 1 / 1500
#: A phrase stays if it is met so often, set against the longer phrases it may be a remnant of; shares of its names that make it a person's, a numbered one's, a doctor's.
REMNANT, PERSONAL, NUMBERED, DOCTORS = 0.5, 0.5, 0.5, 0.3
#: Names read in one task; reading is the costly part, so tasks follow the number of names and not of bytes.
NAMES_A_TASK = 4000

FORMS = "array<struct<initials:string, anchor:string, rest:array<string>, role:string>>"
PARTS = f"name string, n bigint, kind string, purpose string, number string, given string, initial string, doctor boolean, core string, turned string, forms {FORMS}"


def spellings(rows: DataFrame, columns: list[str]) -> DataFrame:
    """name, n: the distinct names of all columns and how often each occurs."""
    each = rows.select(F.explode(F.array(*columns)).alias("name")).where(F.col("name").rlike(r"[\p{L}\p{N}]"))
    return each.groupBy("name").agg(F.count(F.lit(1)).alias("n"))


def folded(names: DataFrame) -> DataFrame:
    """name, n, tokens, words (those that can tell names apart or say a purpose)."""

    def work(batches):
        import pyarrow as pa

        from harborlens.llm.name_parts import content, fold

        for batch in batches:
            tokens = [fold(name) for name in batch.column(0).to_pylist()]
            strings = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(tokens, strings), pa.array([content(t) for t in tokens], strings)], names=["name", "n", "tokens", "words"])

    return names.select("name", "n").mapInArrow(work, "name string, n bigint, tokens array<string>, words array<string>")


def learn(names: DataFrame) -> list[Purpose]:
    """The purposes that the names hold. names: what folded gives, materialised."""
    least = max(LEAST, SHARE * names.count())
    words = names.select("name", F.explode(F.array_distinct("words")).alias("word"))
    met = words.join(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "word").where("n > 1")
    rarest = met.groupBy("name").agg(F.min(F.struct("n", "word")).alias("rarest"))
    beside = met.join(rarest, "name").where("n > rarest.n").groupBy("word", F.col("rarest.word").alias("other")).agg(F.lit(1))
    spread = beside.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    common = frozenset(r.word for r in spread.collect()) - GIVEN.keys()

    def work(batches):
        import pyarrow as pa

        from harborlens.llm.name_parts import GIVEN, _number

        for batch in batches:
            out = []
            for tokens, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                said = " ".join(w for w in words if w in common)
                out.append((said, " ".join(w for w in words if w not in common), any(map(_number, tokens)), any(t in GIVEN for t in tokens), "dr" in tokens))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)] if out else [pa.array([], t) for t in (pa.string(), pa.string(), *[pa.bool_()] * 3)], names=["said", "rest", "numbered", "given", "doctor"])

    said = names.select("tokens", "words").mapInArrow(work, "said string, rest string, numbered boolean, given boolean, doctor boolean").where("said <> ''")
    flags = ("numbered", "given", "doctor")
    by_rest = said.groupBy("said", "rest").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(f).alias(f) for f in flags])
    found = by_rest.groupBy("said").agg(F.count(F.lit(1)).alias("rests"), F.sum("n").alias("n"), *[(F.sum(f) / F.sum("n")).alias(f) for f in flags]).where(F.col("rests") >= least).collect()
    of = {tuple(r.said.split(" ")): r for r in found}
    return [Purpose(p, of[p].given >= PERSONAL, of[p].doctor >= DOCTORS, of[p].numbered >= NUMBERED) for p in prune({p: r.n for p, r in of.items()}, REMNANT)]


def read_parts(names: DataFrame, purposes: list[Purpose]) -> DataFrame:
    """The parts of each name (PARTS). names: what folded gives, materialised."""

    def work(batches):
        import pyarrow as pa

        from harborlens.llm.name_parts import Reader

        reader = Reader(purposes)
        for batch in batches:
            parts = [reader.parse(tokens) for tokens in batch.column(2).to_pylist()]
            out = {c: [getattr(p, c) for p in parts] for c in ("kind", "purpose", "number", "given", "initial", "core", "turned")}
            forms = pa.list_(pa.struct([("initials", pa.string()), ("anchor", pa.string()), ("rest", pa.list_(pa.string())), ("role", pa.string())]))
            arrays = [batch.column(0), batch.column(1), *[pa.array(out[c], pa.string()) for c in ("kind", "purpose", "number", "given", "initial")]]
            arrays += [pa.array([p.doctor for p in parts], pa.bool_()), pa.array(out["core"], pa.string()), pa.array(out["turned"], pa.string())]
            arrays.append(pa.array([[f._asdict() for f in p.forms] for p in parts], forms))
            yield pa.RecordBatch.from_arrays(arrays, names=["name", "n", "kind", "purpose", "number", "given", "initial", "doctor", "core", "turned", "forms"])

    return names.select("name", "n", "tokens").repartition(names.count() // NAMES_A_TASK + 1, "name").mapInArrow(work, PARTS)


def _segments(core: str) -> Column:
    """Keys (length, segment number, text) of a core cut in RADIUS + 1 even segments."""
    k = RADIUS + 1
    return F.expr(f"transform(sequence(0, {k - 1}), i -> concat_ws('|', length({core}), i, substring({core}, i * length({core}) div {k} + 1, (i + 1) * length({core}) div {k} - i * length({core}) div {k})))")


def _probes(core: str) -> Column:
    """The keys that a core's substrings give for every length within the radius and every allowed shift."""
    k, r = RADIUS + 1, RADIUS
    at = f"i * l div {k} + s"
    size = f"((i + 1) * l div {k} - i * l div {k})"
    shifts = f"sequence(cast(-floor(({r} - (length({core}) - l)) / 2) as int), cast(floor(({r} + (length({core}) - l)) / 2) as int))"
    inner = f"transform(filter({shifts}, s -> {at} >= 0 and {at} + {size} <= length({core})), s -> concat_ws('|', l, i, substring({core}, {at} + 1, {size})))"
    return F.expr(f"array_distinct(flatten(transform(sequence(greatest(1, length({core}) - {r}), length({core}) + {r}), l -> flatten(transform(sequence(0, {k - 1}), i -> {inner})))))")


def radius_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """block, core, other, d: every core of the right within the radius of each of the left, in the same block."""
    usual = F.length("core") <= LONGEST
    probes = left.where(usual).select("block", "core", F.explode(_probes("core")).alias("key"))
    index = right.where(usual).select("block", F.col("core").alias("other"), F.explode(_segments("core")).alias("key"))
    pairs = probes.join(index, ["block", "key"]).where("core <> other").select("block", "core", "other").distinct()
    reach = F.least(F.lit(RADIUS), F.floor(F.least(F.length("core"), F.length("other")) / LETTERS_AN_EDIT))
    return pairs.withColumn("d", F.levenshtein("core", "other", RADIUS)).where((F.col("d") >= 0) & (F.col("d") <= reach))


def components(links: DataFrame) -> DataFrame:
    """block, core, root: each linked core and the least core that any chain of links leads to. links: block, core, other, both ways.

    The rounds go on until none changes a label. Each is written as a table: a checkpoint keeps the constraints of the plan it
    cuts, and they would double with every round.
    """
    labels = written(links.groupBy("block", "core").agg(F.least("core", F.min("other")).alias("root")), "labels")
    while True:
        theirs = labels.select("block", F.col("core").alias("other"), F.col("root").alias("near"))
        seen = links.join(theirs, ["block", "other"]).groupBy("block", "core").agg(F.min("near").alias("near"))
        known = labels.join(seen, ["block", "core"])
        # a core and its root both learn what the core's neighbours have, and take the root of that in the same round
        told = F.expr("inline(array(named_struct('core', core, 'was', root, 'low', least(root, near)), named_struct('core', root, 'was', null, 'low', near)))")
        lower = known.select("block", told).groupBy("block", "core").agg(F.max("was").alias("was"), F.min("low").alias("root"))
        jump = labels.select("block", F.col("core").alias("root"), F.col("root").alias("next"))
        lower = written(lower.join(jump, ["block", "root"]).select("block", "core", "was", F.col("next").alias("root")), "labels")
        labels = lower.select("block", "core", "root")
        if lower.where("root <> was").isEmpty():
            return labels


def _both_ways(links: DataFrame) -> DataFrame:
    return links.unionByName(links.select("block", F.col("other").alias("core"), F.col("core").alias("other"))).distinct()


def _rooted(points: DataFrame, labels: DataFrame) -> DataFrame:
    """points with root: their component's, or their own core where no link reaches them."""
    return points.join(labels, ["block", "core"], "left").withColumn("root", F.coalesce("root", "core"))


def _block() -> Column:
    person = F.concat_ws("|", F.lit("person"), "given")
    return F.when(F.col("kind") == "person", person).otherwise(F.concat_ws("|", "kind", "purpose", "number"))


def _nearest(reached: DataFrame, of: str) -> DataFrame:
    """block, of, found, n_found: the nearest body and how many are as near. reached: block, of, body, d."""
    least = reached.groupBy("block", of, "body").agg(F.min("d").alias("d"))
    nearest = least.withColumn("best", F.min("d").over(Window.partitionBy("block", of))).where("d = best")
    return nearest.groupBy("block", of).agg(F.min("body").alias("found"), F.count(F.lit(1)).alias("n_found"))


def _same_words(a: str, b: str) -> Column:
    """Whether the words of two sorted arrays are, one by one, the same, abbreviated or mistyped; an acronym's letters begin them."""
    letters = lambda x: f"concat('^', regexp_replace({x}, '(.)', '$1.*'))"
    edits = f"levenshtein(p.x, p.y) <= least({RADIUS}, least(length(p.x), length(p.y)) div {LETTERS_AN_EDIT})"
    short = f"(least(length(p.x), length(p.y)) > 1 or role = 'acronym') and ((p.y rlike {letters('p.x')}) or (p.x rlike {letters('p.y')}))"
    same = f"p.x = p.y or {edits} or ({short})"
    return F.expr(f"forall(zip_with({a}, {b}, (x, y) -> struct(x, y)), p -> {same})")


def _met(nodes: DataFrame) -> DataFrame:
    """role, block, core, other: names without a purpose that meet at an anchor with the other words alike. nodes: block, core, forms."""
    each = cut(nodes.select(F.col("block").alias("of"), F.col("core").alias("node"), F.inline("forms")).withColumn("block", F.concat_ws("|", "of", "initials")))
    whole = each.where("role = 'whole'").select("block", F.col("anchor").alias("other"), F.col("node").alias("met"), F.col("rest").alias("their"))
    anchors, asked = whole.select("block", F.col("other").alias("core")).distinct(), each.select("block", F.col("anchor").alias("core")).distinct()
    near = radius_join(asked, anchors).select("block", F.col("core").alias("anchor"), "other")
    near = near.unionByName(asked.join(anchors, ["block", "core"], "left_semi").select("block", F.col("core").alias("anchor"), F.col("core").alias("other")))
    met = each.join(near, ["block", "anchor"]).join(whole, ["block", "other"]).where("node <> met").where(_same_words("rest", "their"))
    return met.select("role", F.col("of").alias("block"), F.col("node").alias("core"), F.col("met").alias("other")).distinct()


def _short_for(met: DataFrame, rooted: DataFrame) -> DataFrame:
    """block, core, other: a body whose names lack a word or are an acronym, and the only body that it may be short for. rooted: block, core, root."""
    shorter = met.where("role = 'less'").select("block", F.col("other").alias("core"), F.col("core").alias("long"))
    shorter = shorter.unionByName(met.where("role = 'acronym'").select("block", "core", F.col("other").alias("long")))
    of = rooted.select("block", F.col("core").alias("long"), F.col("root").alias("body"))
    each = shorter.join(of, ["block", "long"]).join(rooted, ["block", "core"]).where("root <> body")
    only = each.groupBy("block", "root").agg(F.min("body").alias("body"), F.count_distinct("body").alias("n")).where("n = 1")
    return only.select("block", F.col("root").alias("core"), F.col("body").alias("other"))


def bodies(parsed: DataFrame) -> DataFrame:
    """name, body: equal for the spellings of one body. parsed: what read_parts gives.

    Components are found twice, each time for all blocks at once: of the links between cores (and names without a purpose), and
    then of what these leave open, names with an initial alone and names that are short for others.
    """
    body = lambda *c: F.concat_ws("|", *c)
    named = parsed.where("kind <> 'other'").withColumn("block", _block())
    full = named.where("kind <> 'person' or given <> ''")
    points = cut(full.select("block", F.explode(F.array("core", "turned")).alias("core")).distinct())
    turns = _both_ways(full.where("core <> turned").select("block", "core", F.col("turned").alias("other")))
    plain = parsed.where("kind = 'other'").select("name", body(F.lit("other"), "number").alias("block"), "core", "forms")
    nodes = plain.groupBy("block", "core").agg(F.first("forms").alias("forms"))  # they follow the core
    met = cut(_met(nodes))
    links = radius_join(points, points).select("block", "core", "other").unionByName(turns).unionByName(met.where("role = 'whole'").select("block", "core", "other"))
    labels = components(cut(links))
    rooted = cut(_rooted(full, labels))
    whole = rooted.where("kind <> 'person' or purpose <> ''").withColumn("body", body("block", "root", "purpose"))
    # practices without their purpose: the one body of that person
    persons = whole.where("kind = 'person'").groupBy("block", "root").agg(F.collect_set("purpose").alias("all"), F.collect_set(F.when(F.col("doctor"), F.col("purpose"))).alias("doctors"))
    bare = rooted.where("kind = 'person' and purpose = ''").join(persons, ["block", "root"], "left")
    fitting = F.when(F.col("doctor"), F.col("doctors")).otherwise(F.col("all"))
    bare = bare.withColumn("body", body("block", "root", F.when(F.size(fitting) == 1, fitting[0]).otherwise(F.lit(""))))
    # only an initial: the nearest person of that purpose and initial
    by_initial = body(F.lit("initial"), "purpose", "initial").alias("block")
    short = named.where("kind = 'person' and given = ''").select("name", by_initial, "core")
    known = cut(whole.where("kind = 'person'").select(by_initial, "core", "body").distinct())
    shorts = cut(short.select("block", "core").distinct())
    same = shorts.join(known.select("block", "core"), ["block", "core"], "left_semi").select("block", "core", F.col("core").alias("other"), F.lit(0).alias("d"))
    close = radius_join(shorts, known.select("block", "core").distinct()).unionByName(same)
    reached = close.join(known.select("block", F.col("core").alias("other"), "body"), ["block", "other"])
    asked = shorts.join(_nearest(reached, "core"), ["block", "core"], "left")
    asked = cut(asked.select("block", "core", F.when(F.col("n_found") == 1, F.col("found")).alias("found"), (F.coalesce("n_found", F.lit(0)) > 1).alias("torn")))
    # those without such a person keep together by their components, and go with the nearest name in reach that found one
    left, sure = asked.where("found is null"), asked.where("found is not null").select("block", F.col("core").alias("other"), F.col("found").alias("body"))
    near = cut(radius_join(left, asked))
    grounds = written(_rooted(nodes.select("block", "core"), labels), "grounds")
    second = near.join(sure, ["block", "other"], "left_anti").select("block", "core", "other").unionByName(_both_ways(_short_for(met, grounds)))
    labels = components(cut(second))
    left = cut(_rooted(left.select("block", "core", "torn"), labels))
    torn = left.where("torn").select("block", "root").distinct()
    passed = _nearest(near.join(sure, ["block", "other"]).join(left, ["block", "core"]), "root").where("n_found = 1").join(torn, ["block", "root"], "left_anti")
    kept = left.join(passed, ["block", "root"], "left").select("block", "core", F.coalesce("found", body("block", "root")).alias("body"))
    initials = short.join(sure.withColumnRenamed("other", "core").unionByName(kept), ["block", "core"])
    tops = grounds.join(labels.select("block", F.col("core").alias("root"), F.col("root").alias("top")), ["block", "root"], "left")
    others = plain.join(tops, ["block", "core"]).withColumn("body", body("block", F.coalesce("top", "root")))
    out = whole.select("name", "body")
    for part in (bare, initials, others):
        out = out.unionByName(part.select("name", "body"))
    return out


def link(rows: DataFrame, columns: list[str]) -> DataFrame:
    """name, body: each distinct spelling of the columns and the body it means."""
    names = cut(folded(spellings(rows, columns)))
    return bodies(cut(read_parts(names, learn(names))))


def pairs(linked: DataFrame) -> DataFrame:
    """name_a, name_b: all pairs of a body's spellings, the lesser by code point first."""
    other = linked.select("body", F.col("name").alias("name_b"))
    return linked.withColumnRenamed("name", "name_a").join(other, "body").where("name_a < name_b").select("name_a", "name_b")
