"""The same queries as SQL, written from the definitions and not from the DataFrame code."""

from __future__ import annotations

from harborlens.operators import classify as C

_STATE = "cs as (select * from (select *, row_number() over (partition by ip, port order by date desc, banner_ts desc nulls last, obs_id desc) as rn from observations) where rn = 1)"
_LIFE = "lc as (select ip, port, min(date) as first_seen, max(date) as last_seen, count(distinct date) as days_observed, date_diff('day', min(date), max(date)) + 1 as span_days from observations group by ip, port)"
_LAST = "(select max(date) from observations)"
_DAY = "cast(replace(split_part(src_file, 'events-', -1), '.json.gz', '') as date)"


def _set(column: str, source: str) -> str:
    return f"{column} as (select date, ip, list_sort(list(distinct x)) as {column} from (select date, ip, unnest({source}) as x from b) where x is not null group by date, ip)"


_HOSTS = f"""b as (select *, ip_str as ip, {_DAY} as date from daily_downloads where ip_str <> ''),
base as (select date, ip, arg_min(org, rec_id) filter (where org <> '') as org, arg_min(location.city, rec_id) filter (where location.city <> '') as city,
    coalesce(list_sort(list(distinct port) filter (where port is not null)), []) as ports, max(case when port is null then 1 else 0 end) as portless,
    coalesce(list_sort(list(distinct product) filter (where product <> '')), []) as products, count(*) as n_banners from b group by date, ip),
{_set("hostnames", "hostnames")}, {_set("domains", "domains")}, {_set("cves", "map_keys(vulns)")},
h as (select base.date, base.ip, org, city, ports, products, coalesce(hostnames, []) as hostnames, coalesce(domains, []) as domains, coalesce(cves, []) as cves, n_banners,
    len(ports) + portless as n_ports from base left join hostnames using (date, ip) left join domains using (date, ip) left join cves using (date, ip))"""


def _words(words: list[str]) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def _first(text: str, words: list[str]) -> str:
    return f"list_filter({_words(words)}, lambda k: contains({text}, k))[1]"


def _ends(suffixes: list[str]) -> str:
    return "len(list_filter(domains, lambda x: " + " or ".join(f"suffix(x, '{s}')" for s in suffixes) + ")) > 0"


def _ports(names: dict[int, str]) -> str:
    return "list_filter([" + ", ".join(f"case when list_contains(ports, {p}) then '{n}' end" for p, n in names.items()) + "], lambda x: x is not null)"


_CLASSIFY = f"""t0 as (select *, lower(coalesce(org, '')) as org_text, array_to_string(hostnames, ' ') as hn, array_to_string(domains, ' ') as dn from h),
t1 as (select *, lower(case when hn <> '' and dn <> '' then hn || ' ' || dn else hn || dn end) as identity,
    {_first("org_text", C.CONSUMER + C.TRANSIT)} is not null as bulk, {_first("org_text", C.CONSUMER)} is not null as consumer, {_ports(C.ICS_PORTS)} as ics_named from t0),
t2 as (select *, case when bulk then identity else identity || ' ' || org_text end as txt, case when bulk then ' (via customer domain)' else '' end as via from t1),
t3 as (select *, {_first("txt", C.CRITICAL)} as kc, {_first("txt", C.GOVERNMENT)} as kg, {_first("txt", C.PARISHES)} as kp, {_first("txt", C.EDUCATION)} as ke from t2),
t4 as (select *, case
    when len(ics_named) > 0 then 1 when kc is not null then 2 when {_ends(C.GOVERNMENT_SUFFIXES)} then 3 when kg is not null then 4 when kp is not null then 5
    when {_ends(C.EDUCATION_SUFFIXES)} then 6 when ke is not null then 7
    when consumer and ({_first("identity", C.DYNAMIC)} is not null or (len(hostnames) = 0 and len(domains) = 0)) then 8
    when trim(identity) <> '' or (trim(org_text) <> '' and not bulk) then 9 when trim(org_text) <> '' then 10 else 11 end as rule from t3),
k as (select *, case when rule <= 2 then 'critical_infrastructure' when rule <= 5 then 'government' when rule <= 7 then 'education' when rule = 8 then 'residential'
    when rule = 9 then 'small_business' else 'unclassified' end as tier,
    case rule when 1 then 'ICS protocol exposed: ' || array_to_string(ics_named, ', ') when 2 then 'keyword ''' || kc || '''' || via when 3 then 'gov domain'
    when 4 then 'keyword ''' || kg || '''' || via when 5 then 'parish ''' || kp || '''' || via when 6 then 'edu domain' when 7 then 'keyword ''' || ke || '''' || via
    when 8 then 'consumer ISP / dynamic rDNS' when 9 then 'commercial org, not gov/edu/infra' when 10 then 'bulk network address space, no customer identity'
    else 'no attribution signal' end as reason from t4)"""

_SCORE = f"""with {_HOSTS}, {_CLASSIFY},
e as (select date, ip, count(*) filter (where cve in (select cve from kev_list)) as n_kev, max(coalesce(epss, 0.0)) as max_epss,
    list_sort(list(distinct cve) filter (where cve in (select cve from kev_list))) as kev from (select date, ip, unnest(cves) as cve from h) left join epss_scores using (cve) group by date, ip),
s0 as (select k.*, coalesce(n_kev, 0) as n_kev, coalesce(max_epss, 0.0) as max_epss, coalesce(kev, []) as kev_list_of, list_sort({_ports(C.ICS_PORTS)}) as ics, list_sort({_ports(C.ADMIN_PORTS)}) as admin, list_sort({_ports(C.DB_PORTS)}) as dbs
    from k left join e using (date, ip) where n_ports <= 100),
s as (select *, cast(n_kev * 100 + len(ics) * 40 + len(admin) * 15 + len(dbs) * 25 + trunc(max_epss * 50) as bigint) as score from s0)"""



def _merged(source: str, name: str) -> str:
    """Hosts merged from hits: date, ip, nth, label, obs_id, port, org, city, tags, hostnames, cves, banner_ts."""
    listed = lambda c: f"{name}_{c} as (select date, ip, list_sort(list(distinct x)) as {c} from (select date, ip, unnest({c}) as x from {source}) where x is not null group by date, ip)"
    return f"""{listed("tags")}, {listed("cves")},
{name}_names as (select date, ip, list(x order by k) as hostnames from (select date, ip, x, min(nth * 1000000000000000 + obs_id * 1000 + place) as k
    from (select date, ip, nth, obs_id, unnest(hostnames) as x, generate_subscripts(hostnames, 1) as place from {source}) where x is not null group by date, ip, x) group by date, ip),
{name} as (select m.*, coalesce(t.tags, []) as tags, coalesce(c.cves, []) as cves, coalesce(n.hostnames, []) as hostnames from (
    select date, ip, list_sort(list(distinct label)) as selectors, coalesce(list_sort(list(distinct port) filter (where port is not null)), []) as ports,
        arg_min(org, nth * 1000000000000 + obs_id) filter (where org <> '') as org, arg_min(city, nth * 1000000000000 + obs_id) filter (where city <> '') as city,
        max(banner_ts) as banner_ts, count(*) as n_hits from {source} group by date, ip) m
    left join {name}_tags t using (date, ip) left join {name}_cves c using (date, ip) left join {name}_names n using (date, ip))"""


_TWO = "(values (0, 'honeypot'), (1, 'proxy')) s(nth, tag)"
_HITS = f"""hits0 as (select o.* exclude (tags, hostnames), nth, 'tag:' || tag as label, list_filter(string_split(coalesce(o.tags, ''), ','), lambda x: x <> '') as tags,
    list_filter(string_split(coalesce(o.hostnames, ''), ','), lambda x: x <> '') as hostnames, cast([] as varchar[]) as cves from observations o join {_TWO} on list_contains(string_split(o.tags, ','), tag)),
{_merged("hits0", "hits")}"""
_BANNER_ROWS = f"select d.* exclude (tags), ip_str as ip, {_DAY} as date, rec_id as obs_id, location.city as city, coalesce(map_keys(vulns), []) as cves, try_cast(timestamp as timestamp) as banner_ts, list_filter(coalesce(d.tags, []), lambda x: x is not null) as tags"
_LINE = """case when length(ip) >= 39 then ip else lpad(ip, 39, ' ') end || '  ' || rpad(substring(coalesce(nullif(org, ''), '?'), 1, 28), 28, ' ') || '  ' ||
    rpad(substring(coalesce(nullif(city, ''), '?'), 1, 14), 14, ' ') || '  tags[' || coalesce(nullif(array_to_string(tags, ','), ''), '-') || ']  ports[' || array_to_string(ports, ',') ||
    ']  matched[' || array_to_string(selectors, ',') || ']  host[' || coalesce(hostnames[1], '') || ']  cves[' || coalesce(nullif(array_to_string(cves[1:5], ','), ''), '-') || ']'"""
_RUN = f"""{_HITS}, now as (select * from hits where date = {_LAST}), before as (select * from hits where date < {_LAST}),
active as (select ip from before where date = (select max(date) from before))"""

_IPV4 = "case when ip like '%.%' then cast(split_part(ip, '.', 1) as bigint) * 16777216 + cast(split_part(ip, '.', 2) as bigint) * 65536 + cast(split_part(ip, '.', 3) as bigint) * 256 + cast(split_part(ip, '.', 4) as bigint) end"
_LOCATED = f"""nets(lo, hi, size, country, region) as (values (167772160, 167804927, 17, 'QX', 'QA'), (167804928, 167837695, 17, 'QX', 'QB'), (167837696, 167903231, 16, 'QX', 'QA'),
    (167854080, 167870463, 18, 'QX', 'QC'), (167903232, 167919615, 18, 'QY', 'QA')),
ips as (select distinct ip, {_IPV4} as n from addresses where ip <> ''),
four as (select ip, arg_max(country, size) as country, arg_max(region, size) as region from ips join nets on n between lo and hi group by ip),
loc as (select ips.ip, case when ips.ip like '2001:db8:%' then 'QX' else country end as country,
    case when ips.ip like '2001:db8:1:%' then 'QA' when ips.ip like '2001:db8:%' then 'QD' else region end as region from ips left join four using (ip))"""
_GATES = f"""with addresses as (select ip_str as ip from daily_downloads), {_LOCATED},
g0 as (select d.*, coalesce(country = 'QX' and region = 'QA', false) as in_target, coalesce(location.country_code = 'QX' and location.region_code = 'QA', false) as keep_primary_alone
    from daily_downloads d left join loc on loc.ip = d.ip_str),
g as (select *, in_target or keep_primary_alone as keep_primary, in_target or keep_primary_alone or contains(lower(coalesce(org, '')), 'county') as keep_store from g0)"""
_KEY = "coalesce(hash, coalesce(ip_str, 'None') || ':' || coalesce(cast(port as varchar), 'None') || ':' || coalesce(timestamp, 'None'))"
_MANIFEST = f"""{_GATES},
saved as (select src_file, count(*) as saved from (select src_file, row_number() over (partition by src_file, {_KEY} order by rec_id) as r from g where keep_primary) where r = 1 group by src_file),
raw as (select src_file, count(*) as raw, count(*) filter (where not keep_primary) as dropped from g group by src_file),
rep as (select src_file, count(*) as reported from observations group by src_file),
m0 as (select src_file, coalesce(reported, 0) as reported, coalesce(raw, 0) as raw, coalesce(dropped, 0) as dropped, coalesce(saved, 0) as saved from rep full join raw using (src_file) left join saved using (src_file)),
m as (select *, case when reported = 0 then 100 else raw * 100 // reported end as pct, case when raw = 0 then 0 else dropped * 100 // raw end as drop_pct from m0)"""
_ON = "v.ip = cs.ip and v.port = cs.port and v.date = cs.date"
_PIPE = "array_to_string({0}, '|') as {0}"
_LEDGER = """select ip, min(date) as first_seen, max(date) as last_seen, array_to_string(list_sort(list_distinct(flatten(list(selectors)))), '|') as selectors,
    arg_max(banner_ts, date) filter (where banner_ts is not null) as last_banner_ts"""
_KINDS = f"""{_GATES}, sel as (select * from (values (0, 'tag:honeypot'), (1, 'category:Ledgerkeep cache'), (2, 'port = 502')) s(nth, label)),
kept as ({_BANNER_ROWS} from (select * from g where keep_primary and ip_str <> '') d),
kinds0 as (select kept.*, nth, label from kept join sel on (nth = 0 and list_contains(tags, 'honeypot')) or (nth = 1 and product = 'Ledgerkeep cache') or (nth = 2 and port = 502))"""

ORACLE = {
    "obs_projection": f"""with {_HOSTS}, {_CLASSIFY}
select b.rec_id, b.date, b.ip, b.port, transport, asn, b.org, isp, product, version, coalesce(array_to_string(cpe23, ','), '') as cpe23, _shodan.module as service, cast(null as varchar) as info,
    location.city as city, location.region_code as region_code, coalesce(array_to_string(b.hostnames, ','), '') as hostnames, coalesce(array_to_string(b.domains, ','), '') as domains,
    coalesce(array_to_string(tags, ','), '') as tags, try_cast(timestamp as timestamp) as banner_ts, coalesce(hash, 'None') as hash, k.tier from b join k on k.date = b.date and k.ip = b.ip""",
    "vuln_explode": f"""with v as (select {_DAY} as date, ip_str as ip, port, unnest(map_keys(vulns)) as cve, unnest(map_values(vulns)) as t from daily_downloads where ip_str <> '')
select v.date, ip, port, v.cve, case when json_valid(t) and json_type(t) = 'OBJECT' then try_cast(json_extract_string(t, '$.cvss') as double) end as cvss,
    v.cve in (select cve from kev_list) as in_kev, e.epss from v left join epss_scores e on e.cve = v.cve""",
    "current_state": f"with {_STATE} select ip, port, date, org, city, product, tier, hash, obs_id from cs",
    "lifecycle": f"with {_LIFE} select * from lc",
    "q1_tier_accounting": f"""with {_STATE} select cs.tier, count(*) as host_services, count(distinct cs.ip) as unique_hosts, count(distinct case when v.in_kev then cs.ip end) as hosts_with_kev
from cs left join vulns v on {_ON} group by cs.tier""",
    "tier_accounting_services": f"""with {_STATE}, v as (select ip, port, date, bool_or(in_kev) as in_kev from vulns group by ip, port, date)
select cs.tier, count(*) as host_services, count(distinct cs.ip) as unique_hosts, count(distinct case when v.in_kev then cs.ip end) as hosts_with_kev from cs left join v on {_ON} group by cs.tier""",
    "q2_top_kev": f"""with {_STATE} select tier, ip, org, city, port, cve, cvss, round(epss, 3) as epss from (
select distinct cs.tier, cs.ip, cs.org, cs.city, cs.port, v.cve, v.cvss, v.epss from cs join vulns v on {_ON} where v.in_kev and cs.tier in ('critical_infrastructure', 'government', 'education'))
order by epss desc nulls last, cvss desc nulls last, ip, port, cve limit 25""",
    "q3_new_exposures": f"with {_LIFE} select o.tier, o.ip, o.org, o.city, o.port, o.product from observations o join lc l on l.ip = o.ip and l.port = o.port where o.date = {_LAST} and l.first_seen = o.date",
    "new_exposures_by_day": f"with {_LIFE} select o.date, o.tier, o.ip, o.org, o.city, o.port, o.product from observations o join lc l on l.ip = o.ip and l.port = o.port and l.first_seen = o.date",
    "q4_longest_open": f"""with {_STATE}, {_LIFE} select l.ip, l.port, l.first_seen, l.last_seen, l.span_days, cs.tier, cs.org, cs.product from lc l join cs on cs.ip = l.ip and cs.port = l.port
where l.last_seen = {_LAST} order by l.span_days desc, l.first_seen, l.ip, l.port limit 25""",
    "q5_remediated": f"with {_LIFE} select ip, port, first_seen, last_seen as last_seen_before_gone from lc where last_seen < {_LAST} order by last_seen desc, ip, port nulls last limit 25",
    "q6_org_rollup": f"""with {_STATE} select cs.org, cs.tier, count(distinct cs.ip) as hosts, count(distinct case when v.in_kev then v.cve end) as kev_cves, round(max(v.epss), 3) as worst_epss
from cs left join vulns v on {_ON} group by cs.org, cs.tier having count(distinct case when v.in_kev then v.cve end) > 0 order by kev_cves desc, cs.org nulls last, cs.tier nulls last limit 30""",
    "q7_ics_latest": f"select date, ip, org, city, port, product from observations where port in (502, 20000, 47808, 102, 44818, 1911, 2404, 789) and date = {_LAST}",
    "keyed_dedup_first": f"select rec_id, src_file from (select *, row_number() over (partition by src_file, {_KEY} order by rec_id) as r from daily_downloads) where r = 1",
    "geo_gate_primary": f"{_GATES} select rec_id, in_target, keep_primary, keep_primary_alone from g",
    "geo_gate_store": f"{_GATES} select rec_id, keep_store, true as keep_rescue, true as keep_tripwire_alone from g",
    "gated_dedup": f"{_GATES} select rec_id, src_file from (select *, row_number() over (partition by src_file, {_KEY} order by rec_id) as r from g where keep_primary) where r = 1",
    "two_query_union": f"""{_GATES}, u as (select *, 0 as place from g where keep_primary union all select *, 1 from g where contains(lower(coalesce(org, '')), 'county'))
select rec_id, src_file, place from (select *, row_number() over (partition by src_file, {_KEY} order by place, rec_id) as r from u) where r = 1""",
    "merged_parts": f"""with u as (select *, case transport when 'udp' then 0 when 'tcp' then 1 else 2 end as place from daily_downloads)
select rec_id, src_file, place from (select *, row_number() over (partition by src_file, {_KEY} order by place, rec_id) as r from u) where r = 1""",
    "geo_range_join": f"with addresses as (select distinct ip from observations), {_LOCATED} select a.ip, country, region from addresses a left join loc on loc.ip = a.ip",
    "kev_membership": "select distinct cve, cve in (select cve from kev_list) as in_kev from vulns",
    "epss_lookup_null": "select distinct v.cve, e.epss from vulns v left join epss_scores e on e.cve = v.cve",
    "epss_lookup_zero": "select distinct v.cve, coalesce(e.epss, 0.0) as epss from vulns v left join epss_scores e on e.cve = v.cve",
    "host_aggregate": f"with {_HOSTS} select date, ip, org, city, n_banners, n_ports, {', '.join(_PIPE.format(c) for c in ('ports', 'products', 'hostnames', 'domains', 'cves'))} from h",
    "first_truthy_org": f"with {_HOSTS} select date, ip, org, city from h",
    "honeypot_guard": f"with {_HOSTS} select date, ip, n_ports from h where n_ports <= 100",
    "tier_classify": f"with {_HOSTS}, {_CLASSIFY} select date, ip, tier, reason from k",
    "actionability_score": f"{_SCORE} select date, ip, n_kev, round(max_epss, 3) as epss, len(cves) as n_cves, score, array_to_string(products[1:3], '|') as products from s",
    "report_tiers": f"""{_SCORE} select tier, count(*) as hosts, count(*) filter (where len(kev_list_of) > 0) as with_kev, count(*) filter (where len(admin) > 0) as with_admin,
    count(*) filter (where len(ics) > 0) as with_ics, count(*) filter (where score > 0) as signal from s where date = (select max(date) from b) group by tier""",
    "report_hosts": f"""{_SCORE}, r as (select *, row_number() over (partition by tier order by score desc, ip) as place from s where score > 0 and date = (select max(date) from b))
select tier, place, '| ' || concat_ws(' | ', score, ip, substring(coalesce(org, ''), 1, 24), substring(coalesce(city, ''), 1, 14), coalesce(nullif(array_to_string(kev_list_of[1:3], ' '), ''), '—'),
    coalesce(nullif(array_to_string(ics, ' '), ''), '—'), coalesce(nullif(array_to_string(admin, ' '), ''), '—'), coalesce(nullif(array_to_string(dbs, ' '), ''), '—'),
    case when max_epss > 0 then cast(round(max_epss, 3) as varchar) else '—' end, substring(reason, 1, 28)) || ' |' as line from r where place <= 15""",
    "port_protocol_lookup": f"{_SCORE} select date, ip, {', '.join(_PIPE.format(c) for c in ('ics', 'admin', 'dbs'))} from s",
    "tier_accounting_spine": f"""{_SCORE}, spine(tier) as (values {", ".join(f"('{t}')" for t in C.TIERS)})
select spine.tier, count(s.ip) as hosts, count(*) filter (where n_kev > 0) as with_kev, count(*) filter (where len(admin) > 0) as with_admin, count(*) filter (where len(ics) > 0) as with_ics
from spine left join s on s.tier = spine.tier group by spine.tier""",
    "topn_per_tier": f"{_SCORE} select date, tier, ip, score, rank from (select *, row_number() over (partition by date, tier order by score desc, ip) as rank from s where score > 0) where rank <= 15",
    "selector_union": f"with {_HITS} select date, ip, {_PIPE.format('selectors')}, {_PIPE.format('ports')}, n_hits from hits",
    "ledger_new": f"with {_RUN} select ip from now where ip not in (select ip from before)",
    "ledger_ongoing": f"with {_RUN} select ip from now where ip in (select ip from before)",
    "ledger_cleared": f"with {_RUN} select ip from active where ip not in (select ip from now)",
    "ledger_by_day": f"""with {_HITS}, runs as (select date, row_number() over (order by date) as n from (select distinct date from observations)),
e as (select ip, n, lead(n) over w as following, row_number() over w as r from hits join runs using (date) window w as (partition by ip order by n))
select date, ip, case when r = 1 then 'new' else 'ongoing' end as status from e join runs using (n)
union all select runs.date, ip, 'cleared' from e join runs on runs.n = e.n + 1 where following is null or following > e.n + 1""",
    "ledger_job": f"""with {_HITS}, days as (select distinct date from observations order by date desc limit 4) {_LEDGER}, max(date) = {_LAST} as active from hits where date in (select date from days) group by ip""",
    "selector_kinds": f"{_KINDS}, {_merged('kinds0', 'm')} select date, ip, {', '.join(_PIPE.format(c) for c in ('selectors', 'ports', 'tags', 'hostnames', 'cves'))}, n_hits from m",
    "selector_counts": f"{_KINDS} select label as selector, (select count(*) from kinds0 k where k.label = sel.label) as n from sel union all select 'no_such_column = 1', null",
    "hit_archive": f"with b0 as ({_BANNER_ROWS} from daily_downloads d where ip_str <> '') select 'tag:' || tag as selector, count(*) as n, count(distinct obs_id) as banners from b0 join {_TWO} on list_contains(tags, tag) group by tag",
    "alert_lines": f"""with {_RUN}, firsts as (select ip, min(date) as first_seen, arg_max(banner_ts, date) filter (where banner_ts is not null) as ts from hits group by ip),
note as (select *, case when date_diff('day', ts::date, {_LAST}) >= 2 then '  (last scanned ' || strftime(ts, '%Y-%m-%d') || ', ' || date_diff('day', ts::date, {_LAST}) || 'd ago — cached view)' else '' end as n from firsts)
select case when ip in (select ip from before) then 1 else 0 end as place, ip,
    rpad(case when ip in (select ip from before) then '[ongoing since ' || first_seen || ']' else '[NEW]' end, 28, ' ') || ' ' || {_LINE} || n as line from now join note using (ip)
union all select 2, ip, rpad('[CLEARED]', 28, ' ') || ' ' || ip || ' — no longer flagged' from active where ip not in (select ip from now)""",
    "ledger_roll_forward": f"with {_HITS} {_LEDGER}, max(date) = {_LAST} as active from hits group by ip",
    "staleness_days": f"""with {_HITS}, z as (select *, date_diff('day', cast(banner_ts as date), date) as days from hits)
select date, ip, days, case when days >= 2 then '  (last scanned ' || strftime(banner_ts, '%Y-%m-%d') || ', ' || days || 'd ago — cached view)' else '' end as note from z""",
    "host_summary_line": f"with b0 as ({_BANNER_ROWS} from daily_downloads d where ip_str <> ''), b1 as (select b0.*, nth, 'tag:' || tag as label from b0 join {_TWO} on list_contains(tags, tag)), {_merged('b1', 'm')} select date, ip, {_LINE} as line from m",
    "cidr_leaves": f"""with a as (select {_IPV4} as n, count(*) as c from observations where ip like '%.%' group by 1),
t as (select substring(lpad(bin(n), 32, '0'), 1, len) as prefix, len as length, cast(sum(c) as bigint) as n from a, (select cast(unnest(range(1, 33)) as int) as len) group by 1, 2)
select t.prefix, t.length, t.n from t left join t p on p.length = t.length - 1 and p.prefix = substring(t.prefix, 1, t.length - 1)
where (t.n <= 200 or t.length = 32) and (t.length = 1 or p.n > 200)""",
    "cidr_leaves_v6": """with h as (select ip, count(*) as c, string_split(split_part(ip, '::', 1), ':') as a, string_split(split_part(ip, '::', 2), ':') as z from observations where ip like '%::%' group by ip),
g as (select c, list_filter(a, lambda x: x <> '') as a, list_filter(z, lambda x: x <> '') as z from h),
k as (select c, array_to_string(list_transform(list_concat(list_concat(a, list_resize(cast([] as varchar[]), 8 - len(a) - len(z), '0')), z), lambda x: lpad(bin(cast('0x' || x as integer)), 16, '0')), '') as bits from g),
t as (select substring(bits, 1, len) as prefix, len as length, cast(sum(c) as bigint) as n from k, (select cast(unnest(range(3, 129)) as int) as len) where bits like '001%' group by 1, 2)
select t.prefix, t.length, t.n from t left join t p on p.length = t.length - 1 and p.prefix = substring(t.prefix, 1, t.length - 1)
where (t.n <= 200 or t.length = 128) and (t.length = 3 or p.n > 200)""",
    "tripwire_stream": f"with {_HITS} {_LEDGER}, max(date) = (select max(date) from hits) as active from hits group by ip",
    "tripwire_stream_resumed": f"with {_HITS} {_LEDGER}, max(date) = (select max(date) from hits) as active from hits group by ip",
    "completeness_manifest": f"{_MANIFEST} select src_file, reported, raw, dropped, saved, pct, drop_pct from m",
    "day_status": f"{_MANIFEST} select src_file, case when saved = 0 then 2 when drop_pct > 30 then 4 when reported > 0 and pct < 90 then 3 else 0 end as status from m",
    "script_status": f"{_MANIFEST} select src_file, case when raw = 0 then 1 when saved = 0 then 2 when reported <> 0 and pct < 90 then 3 else 0 end as status from m",
    "daily_window": """select date, count(*) filter (where cast(banner_ts as date) > date - 1 and cast(banner_ts as date) < date + 1) as inside,
    count(*) filter (where not (cast(banner_ts as date) > date - 1 and cast(banner_ts as date) < date + 1)) as outside, count(*) filter (where banner_ts is null) as untimed from observations group by date""",
    "report_summary": """select asn, count(distinct ip) as hosts, count(distinct (ip, port)) as services, count(distinct date) as days, min(date) as first_seen, max(date) as last_seen from observations group by asn""",
    "city_counts": "select city, count(distinct ip) as n from observations group by city",
    "asset_inventory": f"""with {_STATE}, l as (select ip, port, count(distinct date) as days_seen, max(date) as last_seen from observations group by ip, port)
select cs.ip, cs.port, cs.product, cs.city, l.days_seen, l.last_seen from cs join l on l.ip = cs.ip and l.port is not distinct from cs.port""",
    "appliances": f"with {_STATE} select ip, port, product, city from cs where product <> ''",
    "grand_totals": "select count(*) as rows, count(distinct date) as days, count(distinct ip) as hosts from observations",
    "retention_filter": f"select date, count(*) as n from observations where date > {_LAST} - 30 group by date",
    "json_archive_roundtrip": f"select {_DAY} as date, count(*) as n, count(distinct ip_str) as hosts from daily_downloads where ip_str <> '' group by 1",
}
