"""SQL for the queries of the general problems, by brute force and with the notations of the tables."""

from __future__ import annotations

# --- places

_NUM = r"[+-]?\d+(?:\.\d+)?"


def _angle(c: str) -> str:
    dec = rf"^\s*([+-]?\d+(?:[.,]\d+)?)\s*°?\s*([NSEWnsew]?)\s*$"
    dms = rf"^\s*(\d{{1,3}})[°\s]+(\d{{1,2}})[''′\s]+(\d{{1,2}}(?:[.,]\d+)?)[\"″\s]*([NSEWnsew])\s*$"
    get = lambda p, k: f"nullif(regexp_extract({c}, '{p}', {k}), '')"
    num = lambda x: f"try_cast(replace({x}, ',', '.') as double)"
    sign = lambda x: f"case when upper({x}) in ('S', 'W') then -1 else 1 end"
    return f"""coalesce(case when {get(dec, 2)} is null then {num(get(dec, 1))} else abs({num(get(dec, 1))}) * {sign(get(dec, 2))} end,
        ({num(get(dms, 1))} + {num(get(dms, 2))} / 60 + {num(get(dms, 3))} / 3600) * {sign(get(dms, 4))})"""


def _two(c: str, pattern: str, lat: int) -> str:
    get = lambda k: f"try_cast(nullif(regexp_extract({c}, '{pattern}', {k}), '') as double)"
    return f"{{'a': {get(lat)}, 'b': {get(3 - lat)}}}"


_WKT = rf"(?i)POINT\s*Z?\s*\(\s*({_NUM})[\s,]+({_NUM})"
_PAIR = rf"^\s*[(\[]?\s*({_NUM})\s*[,; ]\s*({_NUM})\s*[)\]]?\s*$"
_JSON = rf"(?s)\"coordinates\"\s*:\s*[\[\s]+({_NUM})\s*,\s*({_NUM})"
_NAMED = "{{'a': try_cast(nullif(regexp_extract({c}, '(?is)\\blat(?:itude)?\"?\\s*[:=]\\s*\"?({n})', 1), '') as double), 'b': try_cast(nullif(regexp_extract({c}, '(?is)\\blo?ng?(?:itude)?\"?\\s*[:=]\\s*\"?({n})', 1), '') as double)}}".format(c="location", n=_NUM)
_SLIPS = ", ".join(f"{{'a': {i}p.{x}, 'b': {j}p.{y}}}" for x, y in (("a", "b"), ("b", "a")) for i in ("", "-") for j in ("", "-"))

P1 = f"""
with stated as (select asset_id, unnest([{{'a': {_angle('latitude')}, 'b': {_angle('longitude')}}}, {_two('location', _WKT, 2)}, {_two('location', _PAIR, 1)}, {_NAMED}, {_two('geometry', _JSON, 2)}]) as p, generate_subscripts([1, 2, 3, 4, 5], 1) as k from assets),
meant as (select asset_id, k, list_filter([{_SLIPS}], lambda q: q.a between 43.0 and 45.7 and q.b between -83.0 and -78.0)[1] as q from stated where p.a is not null and p.b is not null),
pts as (select asset_id as id, arg_min(q.a, k) as lat, arg_min(q.b, k) as lon from meant where q is not null group by 1),
near as (select a.id as asset_id, 'asset' as other_kind, b.id as other_id from pts a join pts b on a.id < b.id and abs(a.lat - b.lat) < 0.001 and abs(a.lon - b.lon) < 0.001
    where 2 * 6371008.8 * asin(sqrt(pow(sin(radians(a.lat - b.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(a.lon - b.lon) / 2), 2))) < 30),
rings as (select district_id, unnest(cast(json_extract(geometry, '$.coordinates') as double[][][])) as r from districts where geometry_type = 'Polygon'
    union all select district_id, unnest(flatten(cast(json_extract(geometry, '$.coordinates') as double[][][][]))) from districts where geometry_type = 'MultiPolygon'),
edges as (select district_id, unnest(list_zip(r[1:len(r) - 1], r[2:len(r)])) as e from rings),
flat as (select district_id, e[1][1] as ax, e[1][2] as ay, e[2][1] as bx, e[2][2] as by_ from edges),
held as (select p.id as asset_id, 'district' as other_kind, district_id as other_id from pts p join flat on (ay > p.lat) <> (by_ > p.lat) and p.lon < (bx - ax) * (p.lat - ay) / (by_ - ay) + ax group by all having count(*) % 2 = 1)
select * from near union all select * from held"""

# --- instants

_ZONE = "America/Toronto"


def _utc(local: str, off: str) -> str:
    """Microseconds of a local time: by its offset, else the first of the instants at which the zone's
    clocks show it; null if they never do."""
    guess = f"epoch_us(timezone('{_ZONE}', {local}))"
    shown = f"epoch_us(timezone('{_ZONE}', timezone('UTC', make_timestamp(c))))"
    return f"case when {off} is not null then epoch_us({local}) - cast({off} as bigint) * 60000000 else list_min(list_filter([{guess} - 3600000000, {guess}, {guess} + 3600000000], lambda c: {shown} = epoch_us({local}))) end"


_MONTH = "case " + " ".join(f"when regexp_matches(w, '^(?:{p})') then {i}" for i, p in enumerate(["jan", "fe[vb]", "mar", "a[pv]r", "ma[iy]", "jun|juin", "jul|juil", "aug|aou", "sep", "oct", "nov", "dec"], 1)) + " end"
_STAMP = "try_cast(printf('%04d-%02d-%02d %02d:%02d:%02d', {}, {}, {}, h, mi, se) as timestamp) + to_microseconds(us)"

P6 = rf"""
with v as (select 'shelter_occupancy' as table_name, occ_id as rec_id, 'occupancy_date' as field_name, source_file, occupancy_date as raw from shelter_occupancy
    union all select 'outbreaks', outbreak_id, 'date_outbreak_began', source_file, date_outbreak_began from outbreaks
    union all select 'observations', obs_id, 'data_collection_date', source_file, data_collection_date from observations
    union all select 'observations', obs_id, 'collection_date', source_file, collection_date from observations),
z as (select *, trim(raw) as s, case when regexp_matches(raw, ':\d\d|T\d{{6}}') then regexp_extract(trim(raw), '(?:\d|[AaPp][Mm])\s*(Z|UTC|GMT|EST|EDT|[+-]\d\d:?\d\d|[+-]\d\d)$', 1) else '' end as zz from v where raw is not null),
b as (select *, trim(left(s, len(s) - len(zz))) as body, case when zz = '' then null when zz in ('Z', 'UTC', 'GMT') then 0 when zz = 'EST' then -300 when zz = 'EDT' then -240
    else case when zz[1] = '-' then -1 else 1 end * (try_cast(zz[2:3] as int) * 60 + coalesce(try_cast(nullif(right(regexp_replace(zz, '[^0-9]', '', 'g'), 2), '') as int) * (len(regexp_replace(zz, '[^0-9]', '', 'g')) > 2)::int, 0)) end as off from z),
t as (select *, try_cast(rpad(left(regexp_extract(body, ':\d\d\.(\d{{1,9}})$', 1), 6), 6, '0') as bigint) as us, regexp_replace(regexp_replace(body, '(:\d\d)\.\d+$', '\1'), '^[A-Za-z]{{3,9}},\s+(\d)', '\1') as x from b),
c as (select *, lower(strip_accents(regexp_extract(x, '(\p{{L}}{{3,}})', 1))) as w, regexp_extract(x, '(\d{{1,2}}):(\d\d)(?::(\d\d))?\s*([AaPp]?)[Mm]?$', ['h', 'm', 's', 'p']) as tm, regexp_extract(x, '^(?:19|20)\d{{6}}T(\d\d)(\d\d)(\d\d)$', ['h', 'm', 's']) as ct,
    regexp_extract(x, '^(\d{{4}})[-/](\d\d)[-/](\d\d)', ['y', 'm', 'd']) as iso, regexp_extract(x, '^((?:19|20)\d\d)(\d\d)(\d\d)(?:T\d{{6}})?$', ['y', 'm', 'd']) as cmp, regexp_extract(x, '^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}})', ['a', 'b', 'y']) as sl,
    regexp_extract(x, '^(\d{{1,2}})(?:er)?[-\s]+\p{{L}}+\.?[-\s]+(\d{{4}}|\d\d)(?:\s|$)', ['d', 'y']) as dn, regexp_extract(x, '^\p{{L}}+\.?\s+(\d{{1,2}}),?\s+(\d{{4}})', ['d', 'y']) as nd from t),
n as (select *, coalesce(try_cast(tm.h as int) % case when tm.p = '' then 24 else 12 end + case when lower(tm.p) = 'p' then 12 else 0 end, try_cast(ct.h as int), 0) as h, coalesce(try_cast(tm.m as int), try_cast(ct.m as int), 0) as mi, coalesce(try_cast(tm.s as int), try_cast(ct.s as int), 0) as se from c),
r as (select *, case when iso.y != '' then {_STAMP.format('try_cast(iso.y as int)', 'try_cast(iso.m as int)', 'try_cast(iso.d as int)')} when cmp.y != '' then {_STAMP.format('try_cast(cmp.y as int)', 'try_cast(cmp.m as int)', 'try_cast(cmp.d as int)')}
    when dn.y != '' then {_STAMP.format("try_cast(dn.y as int) + case when len(dn.y) = 2 then 2000 else 0 end", f'({_MONTH})', 'try_cast(dn.d as int)')} when nd.y != '' then {_STAMP.format('try_cast(nd.y as int)', f'({_MONTH})', 'try_cast(nd.d as int)')}
    when regexp_matches(x, '^\d{{5}}(?:\.\d+)?$') then timestamp '1899-12-30' + to_microseconds(cast(round(try_cast(x as decimal(18, 6)) * 86400000000) as bigint)) end as one,
    case when sl.y != '' then {_STAMP.format('try_cast(sl.y as int)', 'try_cast(sl.a as int)', 'try_cast(sl.b as int)')} end as mf, case when sl.y != '' then {_STAMP.format('try_cast(sl.y as int)', 'try_cast(sl.b as int)', 'try_cast(sl.a as int)')} end as df from n),
u as (select table_name, rec_id, field_name, source_file, sl.y != '' as slashed, case when regexp_matches(x, '^\d{{10}}$') then try_cast(x as bigint) * 1000000 when regexp_matches(x, '^\d{{13}}$') then try_cast(x as bigint) * 1000 else {_utc('one', 'off')} end as plain, {_utc('mf', 'off')} as umf, {_utc('df', 'off')} as udf from r),
o as (select *, max(slashed and umf is null and udf is not null) over (partition by table_name, source_file) as day_first from u)
select table_name, rec_id, field_name, case when slashed then case when day_first then udf else umf end else plain end as utc_us from o where case when slashed then case when day_first then udf else umf end else plain end is not null"""

# --- drift: types and names by file; renames by the establishments that two files share, whose field
# is that of numbers from nine million on

P5 = r"""
with f as (select raw_id, dataset_id, source_file, file_seq, unnest(json_keys(original)) as k, original from raw_records where json_valid(original)),
v as (select *, json_extract(original, '$."' || k || '"') as j, json_extract_string(original, '$."' || k || '"') as t from f),
w as (select raw_id, dataset_id, source_file, file_seq, k, t, case when t is null or lower(trim(t)) in ('', 'n/a', 'na', 'none', 'null', '-', '--', '.') then null when json_type(j) = 'VARCHAR' then 'string'
    when json_type(j) = 'BOOLEAN' then 'boolean' when json_type(j) in ('BIGINT', 'UBIGINT', 'HUGEINT') then 'integer' when json_type(j) = 'DOUBLE' then 'number' end as ty from v),
norm as (select *, case when ty is null then null when regexp_matches(trim(t), '^[0-9]{9,10}$') and cast(trim(t) as bigint) % 86400 = 0 then cast(cast(make_timestamp(cast(trim(t) as bigint) * 1000000) as date) as varchar)
    when regexp_matches(trim(t), '^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$') then strftime(try_strptime(trim(t), '%m/%d/%Y'), '%Y-%m-%d')
    when regexp_matches(trim(t), '^[+-]?[0-9]+([.][0-9]+)?$') then cast(cast(trim(t) as double) as varchar) when lower(trim(t)) in ('y', 'yes') then 'true' when lower(trim(t)) in ('n', 'no') then 'false' else lower(trim(t)) end as x from w),
files as (select dataset_id, source_file, file_seq, lag(file_seq) over (partition by dataset_id order by file_seq) as was from (select distinct dataset_id, source_file, file_seq from raw_records)),
types as (select dataset_id, file_seq, k, arg_max(ty, n) as ty from (select dataset_id, file_seq, k, ty, case when ty is null then 0 else count(*) end as n from norm group by dataset_id, file_seq, k, ty) group by all),
sides as (select fl.dataset_id, fl.source_file, fl.file_seq, fl.was, coalesce(a.k, b.k) as k, a.k is not null as now, b.k is not null as old, a.ty as nty, b.ty as oty from files fl
    join (select dataset_id, file_seq, k from types union select t.dataset_id, x.file_seq, t.k from types t join files x on t.dataset_id = x.dataset_id and t.file_seq = x.was) ks on ks.dataset_id = fl.dataset_id and ks.file_seq = fl.file_seq
    left join types a on a.dataset_id = fl.dataset_id and a.file_seq = fl.file_seq and a.k = ks.k left join types b on b.dataset_id = fl.dataset_id and b.file_seq = fl.was and b.k = ks.k where fl.was is not null),
ids as (select dataset_id, file_seq, raw_id, min(x) as id from norm where try_cast(x as double) between 9000000 and 9999999 group by all),
links as (select distinct a.dataset_id, a.file_seq, a.raw_id as nid, b.raw_id as oid from ids a join files fl on fl.dataset_id = a.dataset_id and fl.file_seq = a.file_seq join ids b on b.dataset_id = a.dataset_id and b.file_seq = fl.was and b.id = a.id),
cand as (select a.dataset_id, a.file_seq, a.was, a.source_file, a.k as nk, b.k as ok, a.nty, b.oty from sides a join sides b using (dataset_id, file_seq) where a.now and not a.old and b.old and not b.now),
votes as (select c.dataset_id, c.file_seq, c.source_file, c.nk, c.ok, c.nty, c.oty, count(*) filter (n.x is not null and o.x is not null) as n, count(*) filter (n.x = o.x or (contains(n.x, '.') and contains(o.x, '.') and try_cast(n.x as double) > 20 and floor(try_cast(n.x as double)) = floor(try_cast(o.x as double)))) as agree
    from cand c join links l using (dataset_id, file_seq) left join norm n on n.raw_id = l.nid and n.k = c.nk left join norm o on o.raw_id = l.oid and o.k = c.ok group by all),
named as (select *, row_number() over (partition by dataset_id, file_seq, ok order by agree / n desc, n desc) as ro, row_number() over (partition by dataset_id, file_seq, nk order by agree / n desc, n desc) as rn from votes
    where (n > 0 and agree >= 0.75 * n) or (n = 0 and regexp_replace(lower(nk), '[^a-z0-9]', '', 'g') = regexp_replace(lower(ok), '[^a-z0-9]', '', 'g'))),
ren as (select * from named where ro = 1 and rn = 1)
select dataset_id, source_file, k as field_name, 'retyped' as change_kind from sides where now and old and nty <> oty
union all select dataset_id, source_file, nk, 'renamed' from ren union all select dataset_id, source_file, nk, 'retyped' from ren where nty <> oty
union all select dataset_id, source_file, k, 'added' from sides b where now and not old and not exists (select 1 from ren r where r.dataset_id = b.dataset_id and r.file_seq = b.file_seq and r.nk = b.k)
union all select dataset_id, source_file, k, 'removed' from sides b where old and not now and not exists (select 1 from ren r where r.dataset_id = b.dataset_id and r.file_seq = b.file_seq and r.ok = b.k)"""

SQL = {"p1_found": P1, "p5_found": P5, "p6_found": P6}
