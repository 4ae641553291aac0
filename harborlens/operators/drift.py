"""Files whose records drift: one consistent table of all records, and a report of each change.

Ingestion enforces a target schema in one parse; what is unknown or doesn't fit is kept as JSON in a rescue column. The report
reads the ingested table alone: a file's fields are the typed columns it fills and the fields it rescues, compared with those
of the feed's file before. Fields that someone approved as other names of target fields, for a feed or for all, are promoted,
and their rescued values replayed into the typed columns by casts that also undo the known changes of shape.

Defined cases
    * a line that is no JSON object is skipped (and counted by ``broken_lines``); a null value is an absent field.
    * an object with keys that the target doesn't know doesn't fit and is rescued whole.
    * a field's type in a file is that of most of its values; ties go to the first name in alphabetical order.
    * a gone and a new field pair as ``renamed`` if each is the other's best match by content; others are removed or added.
    * a feed's first file has no changes; a file without any readable record has lost all fields.
    * columns of the input other than src_file, line_no and record are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from harborlens.session import cut

#: Target fields and types of the consistent table.
TARGET = {
    "ip_str": "string", "port": "int", "transport": "string", "asn": "string", "org": "string", "isp": "string", "product": "string",
    "version": "string", "info": "string", "timestamp": "string", "hash": "string", "cpe23": "array<string>", "tags": "array<string>",
    "location": "struct<city:string,region_code:string,country_code:string>",
}
#: Least cosine of the contents of a renamed field's two names.
ALIKE = 0.3
ALL_FEEDS = "*"


def feed(name: Column) -> Column:
    return F.split_part(name, F.lit("-events-"), F.lit(1))


def broken_lines(lines: DataFrame) -> DataFrame:
    """src_file, n_broken."""
    bad = F.coalesce(~F.ltrim("record").startswith("{") | F.try_parse_json("record").isNull(), F.lit(True))
    return lines.groupBy("src_file").agg(F.count_if(bad).alias("n_broken"))


def _json_kind(text: Column) -> Column:
    """The JSON type of a JSON text."""
    opens = F.substring(text, 1, 1)
    return F.when(opens == '"', "string").when(opens == "{", "object").when(opens == "[", "array").when(opens.isin("t", "f"), "boolean").otherwise("number")


def _target_kind(kind: str) -> str:
    return "array" if kind.startswith("array") else "object" if kind.startswith("struct") else "string" if kind == "string" else "number"


def _cast(value: Column, kind: str) -> Column:
    """A JSON text as the target type, undoing changes of shape (an object's keys are in order of the alphabet); null where it can't be cast."""
    opens = F.substring(value, 1, 1)
    text = F.get_json_object(F.concat(F.lit('{"v":'), value, F.lit("}")), "$.v")
    if kind == "array<string>":
        flags = F.map_keys(F.map_filter(F.from_json(value, "map<string,string>"), lambda k, v: v == "true"))
        return F.when(opens == "[", F.from_json(value, kind)).when(opens == "{", flags).when(opens == '"', F.split(text, ","))
    if kind.startswith("struct"):
        return F.when(opens == "{", F.from_json(value, kind))
    if kind == "string":
        parts = F.map_values(F.from_json(value, "map<string,string>"))
        return F.when(opens == "{", F.array_join(parts, ".")).when(opens != "[", text)
    return F.when(~opens.isin("{", "["), text.try_cast(kind))


def _known(kind: str) -> list[str]:
    return [f.name for f in StructType.fromDDL(kind[len("struct<") : -1]).fields]


def _fitting(value: Column, plain: Column, kind: str) -> Column:
    """The target value of what has the target's shape already, without any change; else null. plain: the value, a string without its quotes."""
    opens = F.substring(value, 1, 1)
    if kind == "array<string>":
        return F.when(opens == "[", F.from_json(value, kind))
    if kind.startswith("struct"):
        parts, names = F.from_json(value, "map<string,string>"), _known(kind)
        given = F.transform(F.array(parts), lambda m: F.when(F.size(F.array_except(F.map_keys(m), F.array(*map(F.lit, names)))) == 0, F.struct(*[m[n].alias(n) for n in names])))
        return F.when(opens == "{", given[0])
    return F.when(opens == '"', plain) if kind == "string" else F.when(value.rlike(r"^-?\d+$"), value.try_cast(kind))


def ingest(lines: DataFrame, target: dict[str, str] = TARGET) -> DataFrame:
    """src_file, line_no, the typed target columns, and ``rescued``: the other values, by field, as JSON text. One projection."""
    kept = lines.where(F.ltrim("record").startswith("{"))
    parsed = kept.select("src_file", "line_no", F.try_variant_get(F.try_parse_json("record"), "$", "map<string,variant>").alias("each"), F.from_json("record", "map<string,string>").alias("plain"))
    texts = parsed.withColumn("doc", F.map_filter(F.transform_values("each", lambda k, v: F.to_json(v)), lambda k, v: v != "null"))
    # a generator drops the lines that are no object without a filter, which would be pushed down and parse again
    values = texts.select("src_file", "line_no", F.inline(F.array_compact(F.array(F.when(F.col("doc").isNotNull(), F.struct("doc", "plain"))))))
    typed = [_fitting(F.col("doc")[n], F.col("plain")[n], kind).alias(n) for n, kind in target.items()]
    out = values.select("src_file", "line_no", *typed, "doc", "plain")
    good = F.array_compact(F.array(*[F.when(F.col(n).isNotNull(), F.lit(n)) for n in target]))
    rest = F.map_filter("doc", lambda k, v: ~F.array_contains(F.col("good"), k))
    # a variant drops the zero of 7.0, which tells versions apart
    as_written = F.transform_values(rest, lambda k, v: F.when(_json_kind(v) == "number", F.coalesce(F.col("plain")[k], v)).otherwise(v))
    return out.withColumn("good", good).withColumn("rescued", as_written).drop("doc", "plain", "good")


def _features(text: Column) -> Column:
    """What a value's content is like: its words, or, without any, the shape of its dotted numbers."""
    lower = F.lower(text)
    words = F.regexp_extract_all(lower, F.lit(r"(\p{L}+)"), F.lit(1))
    shape = F.regexp_replace(lower, r"\d+", "9")
    none = F.array().cast("array<string>")
    return F.when(lower.isin("true", "false"), none).when(F.size(words) > 0, words).when(shape.contains("9.9"), F.array(shape)).otherwise(none)


def _entries(table: DataFrame, target: dict[str, str], value) -> DataFrame:
    """src_file, field, and what value(text, kind) makes of each value of what ingest gave."""
    text = {n: F.to_json(n) if kind[:5] in ("array", "struc") else F.col(n).cast("string") for n, kind in target.items()}
    typed = F.array_compact(F.array(*[F.when(F.col(n).isNotNull(), F.struct(F.lit(n).alias("field"), value(text[n], F.lit(_target_kind(kind))))) for n, kind in target.items()]))
    rescued = F.transform(F.map_entries("rescued"), lambda e: F.struct(e["key"].alias("field"), value(F.btrim(e["value"], F.lit('"')), _json_kind(e["value"]))))
    return table.select("src_file", F.inline(F.concat(typed, rescued)))


def field_kinds(table: DataFrame, target: dict[str, str] = TARGET) -> DataFrame:
    """src_file, field, kind: the fields of each file and the type of most of their values. table: what ingest gives."""
    counted = _entries(table, target, lambda text, kind: kind.alias("kind")).groupBy("src_file", "field", "kind").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("src_file", "field").agg(F.min_by("kind", F.struct(-F.col("n"), "kind")).alias("kind"))


def contents(table: DataFrame, names: DataFrame, target: dict[str, str] = TARGET) -> DataFrame:
    """field, feature, w: the unit vector of what each of the named fields holds, over all files. names: field."""
    each = _entries(table, target, lambda text, kind: text.alias("text")).join(names, "field")
    counted = each.select("field", F.explode(_features(F.col("text"))).alias("feature")).groupBy("field", "feature").agg(F.count(F.lit(1)).cast("double").alias("n"))
    norms = counted.groupBy("field").agg(F.sqrt(F.sum(F.col("n") * F.col("n"))).alias("norm"))
    return counted.join(norms, "field").select("field", "feature", (F.col("n") / F.col("norm")).alias("w"))


def file_order(lines: DataFrame) -> DataFrame:
    """src_file and the feed's file after (null for the last). A feed has one file a day, so its window is bounded."""
    names = lines.select("src_file").distinct()
    return names.withColumn("after", F.lead("src_file").over(Window.partitionBy(feed(F.col("src_file"))).orderBy("src_file")))


def _beside(kinds: DataFrame, order: DataFrame) -> DataFrame:
    """src_file, field, old_kind, new_kind of every file that has one before it, as one grouping of both sides."""
    none = F.lit(None).cast("string")
    sides = F.array(F.struct(F.col("src_file").alias("file"), none.alias("old_kind"), F.col("kind").alias("new_kind")), F.struct(F.col("after").alias("file"), F.col("kind").alias("old_kind"), none.alias("new_kind")))
    each = kinds.join(order, "src_file").select("field", F.inline(sides)).where("file is not null")
    first = order.groupBy(feed(F.col("src_file"))).agg(F.min("src_file").alias("file")).select("file")
    both = each.groupBy("file", "field").agg(F.max("old_kind").alias("old_kind"), F.max("new_kind").alias("new_kind"))
    return both.join(first, "file", "left_anti").withColumnRenamed("file", "src_file")


def _renames(table: DataFrame, gone: DataFrame, new: DataFrame, target: dict[str, str], alike: float) -> DataFrame:
    """src_file, old_field, new_field: pairs of a file that are each other's best match in content.

    Contents are taken over all files, for one file may hold too little; only names that can be a rename are compared.
    """
    possible = cut(gone.select("src_file", F.col("field").alias("old_field")).join(new.select("src_file", F.col("field").alias("new_field")), "src_file"))
    names = possible.select(F.explode(F.array("old_field", "new_field")).alias("field")).distinct()
    held = cut(contents(table, names, target))
    old, other = held.select(F.col("field").alias("old_field"), "feature", F.col("w").alias("o")), held.select(F.col("field").alias("new_field"), "feature", "w")
    met = possible.select("old_field", "new_field").distinct().join(old, "old_field").join(other, ["new_field", "feature"])
    cosines = met.groupBy("old_field", "new_field").agg(F.round(F.sum(F.col("o") * F.col("w")), 9).alias("cosine")).where(F.col("cosine") >= alike)
    scored = possible.join(cosines, ["old_field", "new_field"])
    rank = lambda side, other: F.row_number().over(Window.partitionBy("src_file", side).orderBy(F.desc("cosine"), other))
    best = scored.withColumn("r_old", rank("old_field", "new_field")).withColumn("r_new", rank("new_field", "old_field")).where("r_old = 1 and r_new = 1")
    return best.select("src_file", "old_field", "new_field")


def changes(table: DataFrame, lines: DataFrame, target: dict[str, str] = TARGET, alike: float = ALIKE) -> DataFrame:
    """src_file, change_kind, old_field, new_field. table: what ingest gives for the lines; of those only the file names are read."""
    both = cut(_beside(field_kinds(table, target), file_order(lines)))  # a row per file and field, read by all that follows
    renamed = cut(_renames(table, both.where("new_kind is null"), both.where("old_kind is null"), target, alike))
    ends = renamed.select("src_file", F.inline(F.array(F.struct(F.lit("removed").alias("change_kind"), F.col("old_field").alias("field")), F.struct(F.lit("added").alias("change_kind"), F.col("new_field").alias("field")))))
    kind = F.when(F.col("new_kind").isNull(), "removed").when(F.col("old_kind").isNull(), "added").when(F.col("old_kind") != F.col("new_kind"), "retyped")
    single = both.select("src_file", kind.alias("change_kind"), "field").where("change_kind is not null").join(ends, ["src_file", "change_kind", "field"], "left_anti")
    side = lambda absent: F.when(F.col("change_kind") == absent, "").otherwise(F.col("field"))
    return single.select("src_file", "change_kind", side("added").alias("old_field"), side("removed").alias("new_field")).unionByName(renamed.select("src_file", F.lit("renamed").alias("change_kind"), "old_field", "new_field"))


def proposals(report: DataFrame, target: dict[str, str] = TARGET) -> DataFrame:
    """feed, alias, field, n: renames from or to a target field, for someone to approve."""
    renamed = report.where("change_kind = 'renamed'").withColumn("feed", feed(F.col("src_file")))
    ways = F.array(F.struct(F.col("old_field").alias("field"), F.col("new_field").alias("alias")), F.struct(F.col("new_field").alias("field"), F.col("old_field").alias("alias")))
    each = renamed.select("feed", F.inline(ways)).where(F.col("field").isin(*target) & ~F.col("alias").isin(*target))
    return each.groupBy("feed", "alias", "field").agg(F.count(F.lit(1)).alias("n"))


def replay(table: DataFrame, approved: list[tuple[str, str, str]], target: dict[str, str] = TARGET) -> DataFrame:
    """Promotes what is approved, as (feed or ``*``, alias, field): rescued values move into the typed columns that are still null.

    A field's own name comes first, then its aliases in order of the alphabet; what can't be cast stays rescued.
    """
    here = feed(F.col("src_file"))

    def value(alias: str, feeds: list[str]) -> Column:
        rescued = F.col("rescued")[alias]
        return rescued if ALL_FEEDS in feeds else F.when(here.isin(*feeds), rescued)

    names = {f: {f: [ALL_FEEDS]} for f in target}
    for of, alias, field in sorted(approved, key=lambda a: a[1]):
        names[field].setdefault(alias, []).append(of)
    source = {f: F.coalesce(*[F.when(_cast(value(n, of), kind).isNotNull(), F.lit(n)) for n, of in names[f].items()]) for f, kind in target.items()}
    staged = table.withColumns({f"from_{f}": F.when(F.col(f).isNull(), c) for f, c in source.items()})
    filled = {f: F.coalesce(F.col(f), _cast(F.col("rescued")[F.col(f"from_{f}")], kind)) for f, kind in target.items()}
    used = F.array_compact(F.array(*[F.col(f"from_{f}") for f in target]))
    out = staged.select("src_file", "line_no", *[c.alias(f) for f, c in filled.items()], "rescued", used.alias("used"))
    return out.withColumn("rescued", F.map_filter("rescued", lambda k, v: ~F.array_contains(F.col("used"), k))).drop("used")
