"""Queries of the data-processing problems 2 to 7, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborlens.operators import drift, history, nested, once, skew, spans
from harborlens.session import written
from harborlens.sources.tables import table

SERVICE = ["ip", "port"]
HOT_SHARE = 0.04
#: Other names of target fields that were approved for the files of observation_files, for all feeds.
APPROVED = [
    (drift.ALL_FEEDS, alias, field)
    for field, aliases in {"isp": "carrier", "info": "extra_info", "version": "product_version softwareVersion ver", "cpe23": "cpe23Uri cpe_23 platform_ids", "tags": "Tags labels tag_list"}.items()
    for alias in aliases.split()
]


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return once.copies(table(spark, folder, "observations"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return nested.children(table(spark, folder, "daily_downloads"))


def p3_location(spark: SparkSession, folder: str) -> DataFrame:
    return nested.locations(table(spark, folder, "daily_downloads"))


def p3_hostnames(spark: SparkSession, folder: str) -> DataFrame:
    return nested.hostnames(table(spark, folder, "daily_downloads"))


def p3_vulns(spark: SparkSession, folder: str) -> DataFrame:
    return nested.vulns(table(spark, folder, "daily_downloads"))


def p3_affected(spark: SparkSession, folder: str) -> DataFrame:
    return nested.affected(table(spark, folder, "daily_downloads"))


def p3_references(spark: SparkSession, folder: str) -> DataFrame:
    return nested.references(table(spark, folder, "daily_downloads")).withColumn("tags", F.array_join("tags", "|"))


def p3_ranges(spark: SparkSession, folder: str) -> DataFrame:
    return nested.ranges(table(spark, folder, "daily_downloads"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    out = spans.periods(table(spark, folder, "lifecycle"), SERVICE)
    return out.select("ip", F.col("port").cast("bigint").alias("port"), "kind", F.col("from_day").cast("string").alias("from_day"), F.col("to_day").cast("string").alias("to_day"))


def _day_states(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "observations").select("obs_id", "ip", "port", "date", "product", "version", "banner_ts", "hash")
    stated = rows.where("port is not null and trim(product) <> '' and trim(version) <> ''").drop("hash")
    attributes = {a: F.lower(F.trim(a)) for a in ("product", "version")}
    again = written(once.copies(rows), "copies")  # joined by the size it has
    return history.day_states(stated.join(again, "obs_id", "left_anti"), SERVICE, "date", ["banner_ts", "obs_id"], attributes)


def _history(spark: SparkSession, folder: str, complete: bool) -> DataFrame:
    out = history.versions(_day_states(spark, folder), SERVICE, "date", ["product", "version"], complete)
    return out.select("ip", F.col("port").cast("bigint").alias("port"), "product", "version", F.col("valid_from").cast("string").alias("valid_from"), F.col("valid_to").cast("string").alias("valid_to"))


def p5_history(spark: SparkSession, folder: str) -> DataFrame:
    return _history(spark, folder, False)


def p5_complete(spark: SparkSession, folder: str) -> DataFrame:
    """The history if every day's rows were all there is: a service without a row on a collection day is gone."""
    return _history(spark, folder, True)


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return p5_history(spark, folder).select("ip", "port", "valid_from", "valid_to")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "observation_files")
    return drift.changes(written(drift.ingest(lines), "ingested"), lines)


def p6_table(spark: SparkSession, folder: str) -> DataFrame:
    """All records in the target schema, with the names of the fields that stay rescued."""
    out = drift.replay(drift.ingest(table(spark, folder, "observation_files")), APPROVED)
    texts = out.withColumns({"cpe23": F.array_join("cpe23", "|"), "tags": F.array_join("tags", "|"), "rescued": F.array_join(F.array_sort(F.map_keys("rescued")), ",")})
    place = F.concat_ws("|", *[F.coalesce(F.col(f"location.{c}"), F.lit("")) for c in ("city", "region_code", "country_code")])
    return texts.withColumn("location", F.when(F.col("location").isNotNull(), place))


def p6_proposals(spark: SparkSession, folder: str) -> DataFrame:
    return drift.proposals(p6_found(spark, folder))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return skew.hot_keys(table(spark, folder, "observations"), ["org", "asn"], "port", HOT_SHARE).select("field", "key_value")


def p7_profile(spark: SparkSession, folder: str) -> DataFrame:
    return skew.profile(table(spark, folder, "observations"), ["org", "asn"], "port", "ip")


QUERIES = {f.__name__: f for f in (p2_found, p3_found, p3_location, p3_hostnames, p3_vulns, p3_affected, p3_references, p3_ranges, p4_found, p5_found, p5_history, p5_complete, p6_found, p6_table, p6_proposals, p7_found, p7_profile)}

_MESSAGES = """m as (select obs_id, ip,
    case when hash is null or trim(hash) = 'None' then port end as p,
    case when hash is null or trim(hash) = 'None' then null else coalesce(case when regexp_full_match(trim(hash), '[+-]?[0-9]+([.]0*)?') then cast(try_cast(split_part(trim(hash), '.', 1) as hugeint) as varchar) end, trim(hash)) end as h,
    date_trunc('second', banner_ts) as t from observations where banner_ts is not null),
copies as (select obs_id from (select obs_id, row_number() over (partition by ip, p, h, t order by obs_id) as r from m) where r > 1)"""

_STATES = f"""with {_MESSAGES},
s as (select ip, port, date, lower(trim(product)) as product, lower(trim(version)) as version from (
    select *, row_number() over (partition by ip, port, date order by banner_ts desc nulls last, obs_id desc) as r from observations
    where obs_id not in (select obs_id from copies) and port is not null and trim(product) <> '' and trim(version) <> '') where r = 1)"""

_COMPLETE = f"""{_STATES},
days as (select date, row_number() over (order by date) as n from (select distinct date from s)),
l as (select s.*, n, lag(product) over w as op, lag(version) over w as ov, lag(n) over w as before, lead(n) over w as after from s join days using (date) window w as (partition by ip, port order by date)),
e as (select *, before is null or before < n - 1 or op <> product or ov <> version as starts from l),
b as (select ip, port, date, product, version, starts from e union all
    select e.ip, e.port, d.date, null, null, false from e join days d on d.n = e.n + 1 where e.after is null or e.after > e.n + 1)
select ip, cast(port as bigint) as port, product, version, cast(date as varchar) as valid_from, coalesce(cast(until - 1 as varchar), '9999-12-31') as valid_to
from (select *, lead(date) over (partition by ip, port order by date) as until from b where starts or product is null) where starts"""

_HISTORY = f"""{_STATES},
l as (select *, lag(product) over w as op, lag(version) over w as ov from s window w as (partition by ip, port order by date)),
e as (select * from l where op is null or op <> product or ov <> version)
select ip, cast(port as bigint) as port, {{columns}} cast(date as varchar) as valid_from,
    coalesce(cast(lead(date) over (partition by ip, port order by date) - 1 as varchar), '9999-12-31') as valid_to from e"""

_CVES = "cves as (select rec_id, unnest(map_keys(vulns)) as cve, unnest(map_values(vulns)) as t from daily_downloads), texts as (select * from cves where json_valid(t))"



def _drift_sql() -> str:
    """The consistent table, field by field from the first of its names that can be cast."""
    cast = {
        "string": "case json_type({v}) when 'OBJECT' then array_to_string(list_transform(list_sort(json_keys({v})), lambda k: {v} ->> k), '.') when 'ARRAY' then null else {v} ->> '$' end",
        "array<string>": "case json_type({v}) when 'ARRAY' then array_to_string({v} ->> '$[*]', '|') when 'OBJECT' then array_to_string(list_filter(list_sort(json_keys({v})), lambda k: ({v} ->> k) = 'true'), '|') when 'VARCHAR' then replace({v} ->> '$', ',', '|') end",
        "int": "case when json_type({v}) not in ('OBJECT', 'ARRAY') then try_cast({v} ->> '$' as int) end",
    }
    place = " || '|' || ".join(f"coalesce({{v}} ->> '{c}', '')" for c in ("city", "region_code", "country_code"))
    columns, used = [], []
    for field, kind in drift.TARGET.items():
        names = [field, *sorted(a for _, a, f in APPROVED if f == field)]
        sql = cast.get(kind, f"case when json_type({{v}}) = 'OBJECT' then {place} end")
        each = [(n, sql.replace("{v}", f"nullif(r -> '$.\"{n}\"', 'null'::json)")) for n in names]
        columns.append(f"coalesce({', '.join(c for _, c in each)}) as \"{field}\"")
        used.append("case " + " ".join(f"when {c} is not null then '{n}'" for n, c in each) + " end")
    return f"""with j as (select src_file, line_no, record::json as r from observation_files where json_valid(record)), o as (select * from j where json_type(r) = 'OBJECT')
select src_file, line_no, {", ".join(columns)},
    array_to_string(list_sort(list_filter(json_keys(r), lambda k: coalesce(json_type(r -> ('$."' || k || '"')), 'NULL') <> 'NULL' and not list_contains([{", ".join(used)}], k))), ',') as rescued from o"""


_CHANGES = f"""with j as (select src_file, record::json as r from observation_files where json_valid(record)), o as (select * from j where json_type(r) = 'OBJECT'),
e as (select src_file, k as field, r -> ('$."' || k || '"') as v from (select src_file, r, unnest(json_keys(r)) as k from o)),
v as (select src_file, field, case json_type(v) when 'VARCHAR' then 'string' when 'OBJECT' then 'object' when 'ARRAY' then 'array' when 'BOOLEAN' then 'boolean' else 'number' end as kind, lower(v ->> '$') as text
    from e where coalesce(json_type(v), 'NULL') <> 'NULL'),
kinds as (select src_file, field, arg_min(kind, (-n, kind)) as kind from (select src_file, field, kind, count(*) as n from v group by all) group by all),
files as (select src_file, lag(src_file) over (partition by split_part(src_file, '-events-', 1) order by src_file) as before from (select distinct src_file from observation_files)),
f as (select src_file, before from files where before is not null),
now as (select src_file, field, kind from kinds join f using (src_file)), old as (select f.src_file, field, kind from kinds k join f on k.src_file = f.before),
sides as (select src_file, field, old.kind as old_kind, now.kind as new_kind from now full join old using (src_file, field)),
possible as (select g.src_file, g.field as old_field, n.field as new_field from sides g join sides n on g.src_file = n.src_file and g.new_kind is null and n.old_kind is null),
words as (select field, unnest(case when text in ('true', 'false') then [] when len(regexp_extract_all(text, '\\p{{L}}+')) > 0 then regexp_extract_all(text, '\\p{{L}}+')
    when contains(regexp_replace(text, '[0-9]+', '9', 'g'), '9.9') then [regexp_replace(text, '[0-9]+', '9', 'g')] else [] end) as feature from v),
c as (select field, feature, count(*)::double as n from words group by all), norms as (select field, sqrt(sum(n * n)) as norm from c group by field),
dots as (select p.old_field, p.new_field, sum(a.n * b.n) as dot from (select distinct old_field, new_field from possible) p join c a on a.field = p.old_field join c b on b.field = p.new_field and b.feature = a.feature group by all),
cosines as (select d.old_field, d.new_field, round(dot / a.norm / b.norm, 9) as cosine from dots d join norms a on a.field = d.old_field join norms b on b.field = d.new_field),
ranked as (select p.*, row_number() over (partition by src_file, old_field order by cosine desc, new_field) as r_old, row_number() over (partition by src_file, new_field order by cosine desc, old_field) as r_new
    from possible p join cosines using (old_field, new_field) where cosine >= {drift.ALIKE}),
renamed as (select src_file, old_field, new_field from ranked where r_old = 1 and r_new = 1),
changes as (select src_file, 'renamed' as change_kind, old_field, new_field from renamed
    union all select src_file, 'retyped', field, field from sides where old_kind <> new_kind
    union all select src_file, 'removed', field, '' from sides where new_kind is null and (src_file, field) not in (select src_file, old_field from renamed)
    union all select src_file, 'added', '', field from sides where old_kind is null and (src_file, field) not in (select src_file, new_field from renamed))"""

_TARGETS = ", ".join(f"'{f}'" for f in drift.TARGET)

ORACLE = {
    "p6_found": f"{_CHANGES} select * from changes",
    "p6_proposals": f"""{_CHANGES}, ways as (select src_file, old_field as field, new_field as alias from changes where change_kind = 'renamed' union all select src_file, new_field, old_field from changes where change_kind = 'renamed')
select split_part(src_file, '-events-', 1) as feed, alias, field, count(*) as n from ways where field in ({_TARGETS}) and alias not in ({_TARGETS}) group by all""",
    "p6_table": _drift_sql(),
    "p2_found": f"with {_MESSAGES} select obs_id from copies",
    "p3_found": f"""with {_CVES},
refs as (select rec_id, cve, t, unnest(range(cast(json_array_length(t, '$.references') as bigint))) as i from texts where json_type(t, '$.references') = 'ARRAY'),
aff as (select rec_id, cve, t, i from (select rec_id, cve, t, unnest(range(cast(json_array_length(t, '$.affected') as bigint))) as i from texts where json_type(t, '$.affected') = 'ARRAY') where json_type(t, '$.affected[' || i || ']') = 'OBJECT'),
rng as (select rec_id, cve, t, i, unnest(range(cast(json_array_length(t, '$.affected[' || i || '].ranges') as bigint))) as j from aff where json_type(t, '$.affected[' || i || '].ranges') = 'ARRAY'),
hosts as (select rec_id, unnest(hostnames) as h, unnest(range(cast(len(hostnames) as bigint))) as i from daily_downloads)
select rec_id, 'location' as child, '0' as link from daily_downloads where coalesce(location.city, location.region_code, location.country_code) is not null
union all select rec_id, 'hostnames', cast(i as varchar) from hosts where h <> ''
union all select rec_id, 'vulns', cve from cves
union all select rec_id, 'references', cve || '/' || i from refs where json_type(t, '$.references[' || i || ']') = 'OBJECT'
union all select rec_id, 'affected', cve || '/' || i from aff
union all select rec_id, 'ranges', cve || '/' || i || '/' || j from rng where json_type(t, '$.affected[' || i || '].ranges[' || j || ']') = 'OBJECT'""",
    "p3_location": "select rec_id, location.city as city, location.region_code as region_code, location.country_code as country_code from daily_downloads where coalesce(location.city, location.region_code, location.country_code) is not null",
    "p3_hostnames": "select rec_id, place, hostname from (select rec_id, unnest(hostnames) as hostname, unnest(range(cast(len(hostnames) as bigint))) as place from daily_downloads) where hostname <> ''",
    "p3_vulns": """with v as (select rec_id, unnest(map_keys(vulns)) as cve, unnest(map_values(vulns)) as detail from daily_downloads),
o as (select *, case when json_valid(detail) and json_type(detail) = 'OBJECT' then detail end as t from v)
select rec_id, cve, try_cast(json_extract_string(t, '$.cvss') as double) as cvss, try_cast(json_extract_string(t, '$.verified') as boolean) as verified, detail from o""",
    "p3_affected": f"""with {_CVES},
aff as (select rec_id, cve, i, json_extract(t, '$.affected[' || i || ']') as e from (select rec_id, cve, t, unnest(range(cast(json_array_length(t, '$.affected') as bigint))) as i from texts where json_type(t, '$.affected') = 'ARRAY'))
select rec_id, cve, i as place, json_extract_string(e, '$.product') as product from aff where json_type(e) = 'OBJECT'""",
    "p3_references": f"""with {_CVES},
refs as (select rec_id, cve, t, unnest(range(cast(json_array_length(t, '$.references') as bigint))) as i from texts where json_type(t, '$.references') = 'ARRAY'),
one as (select rec_id, cve, i, json_extract(t, '$.references[' || i || ']') as e from refs)
select rec_id, cve, i as place, json_extract_string(e, '$.url') as url, case when json_type(e, '$.tags') = 'ARRAY' then array_to_string(json_extract_string(e, '$.tags[*]'), '|') else '' end as tags
from one where json_type(e) = 'OBJECT'""",
    "p3_ranges": f"""with {_CVES},
aff as (select rec_id, cve, i, json_extract(t, '$.affected[' || i || ']') as e from (select rec_id, cve, t, unnest(range(cast(json_array_length(t, '$.affected') as bigint))) as i from texts where json_type(t, '$.affected') = 'ARRAY')),
rng as (select rec_id, cve, i, j, json_extract(e, '$.ranges[' || j || ']') as r from (select *, unnest(range(cast(json_array_length(e, '$.ranges') as bigint))) as j from aff where json_type(e, '$.ranges') = 'ARRAY'))
select rec_id, cve, i as parent, j as place, json_extract_string(r, '$.from') as from_version, json_extract_string(r, '$.to') as to_version from rng where json_type(r) = 'OBJECT'""",
    "p4_found": """with c as (select distinct ip, port, first_seen as f, last_seen as l from lifecycle where first_seen <= last_seen and days_observed >= 1),
o as (select *, max(l) over (partition by ip, port order by f, l rows between unbounded preceding and 1 preceding) as upto from c),
g as (select *, sum(case when upto is null or f > upto + 1 then 1 else 0 end) over (partition by ip, port order by f, l rows unbounded preceding) as n from o),
p as (select ip, port, n, min(f) as f, max(l) as t from g group by ip, port, n),
b as (select *, lag(t) over (partition by ip, port order by n) as before from p)
select ip, cast(port as bigint) as port, 'period' as kind, cast(f as varchar) as from_day, cast(t as varchar) as to_day from p
union all select ip, cast(port as bigint), 'gap', cast(before + 1 as varchar), cast(f - 1 as varchar) from b where before is not null""",
    "p5_found": _HISTORY.format(columns=""),
    "p5_history": _HISTORY.format(columns="product, version,"),
    "p5_complete": _COMPLETE,
    "p7_found": f"""with k as (select 'org' as field, org as key_value from observations union all select 'asn', asn from observations)
select field, key_value from k where trim(key_value) <> '' group by field, key_value having count(*) >= {HOT_SHARE} * (select count(*) from observations)""",
    "p7_profile": """with k as (select 'org' as field, org as key_value, port, ip from observations union all select 'asn', asn, port, ip from observations),
v as (select * from k where trim(key_value) <> ''),
w as (select field, key_value, port, count(*) as n from v where port is not null group by all),
m as (select field, key_value, port as mode_port from (select *, row_number() over (partition by field, key_value order by n desc, port) as r from w) where r = 1)
select v.field, v.key_value, count(*) as n_rows, count(distinct port) as n_port, count(distinct ip) as n_ip, any_value(mode_port) as mode_port,
    quantile_disc(port, 0.5) as p50_port, quantile_disc(port, 0.9) as p90_port
from v left join m on m.field = v.field and m.key_value = v.key_value group by v.field, v.key_value""",
}
