"""Queries of the lakehouse and search operators, each with its equivalent in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cedarloom.functions import classify as C
from cedarloom.functions import names as N
from cedarloom.functions.rules import DATA_TYPES, DATASET_ISSUES, FORMAT_SUFFIXES, STOP_WORDS, TAXONOMY
from cedarloom.io import table
from cedarloom.operators import medallion as M
from cedarloom.operators import resources as R
from cedarloom.operators import search as S
from cedarloom.operators.stores import latest, upserted
from cedarloom.sources.feeds import distinct_feeds, is_feed
from cedarloom.streaming.sync import gap, newer, pending, progress

Query = Callable[[SparkSession, str], DataFrame]
_Q: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _Q[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


# --- SQL pieces in the oracle's dialect
_NULLS = "('', 'n/a', 'na', 'none', 'null', '-', '--', '.')"


def _o_any(text: str, words: list[str]) -> str:
    return "(" + " or ".join(f"contains({text}, '{w}')" for w in words) + ")"


def _o_issue(ds: str, title: str = "''") -> str:
    text = f"lower(concat({ds}, ' ', coalesce({title}, '')))"
    known = " ".join(f"when {ds} = '{k}' then '{v[0]}'" for k, v in DATASET_ISSUES.items())
    words = " ".join(f"when {_o_any(text, kw)} then '{i}'" for i, (kw, _) in TAXONOMY.items())
    return f"case {known} {words} else 'uncategorized' end"


def _o_sub(ds: str, issue: str) -> str:
    known = " ".join(f"when {ds} = '{k}' then '{v[2]}'" for k, v in DATASET_ISSUES.items())
    words = " ".join(f"when {issue} = '{i}' and {_o_any(f'lower({ds})', kw)} then '{s}'" for i, (_, subs) in TAXONOMY.items() for s, kw in subs.items())
    return f"case {known} {words} else 'general' end"


def _o_type(ds: str) -> str:
    return "case " + " ".join(f"when {_o_any(f'lower({ds})', kw)} then '{t}'" for t, kw in DATA_TYPES.items()) + " else 'record' end"


def _o_trim(c: str) -> str:
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def _o_value(c: str) -> str:
    return f"case when lower({_o_trim(c)}) in {_NULLS} then null else {_o_trim(c)} end"


# --- classification and flagship


@query(f"""
with d as (select distinct dataset_id as dataset from documents where dataset_id is not null), i as (select dataset, {_o_issue('dataset')} as issue from d)
select dataset, issue, {_o_sub('dataset', 'issue')} as sub, {_o_type('dataset')} as data_type from i""")
def classify_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select(F.col("dataset_id").alias("dataset")).where("dataset is not null").distinct()
    d = d.selectExpr("dataset", f"{C.primary_issue('dataset', default='uncategorized')} as issue")
    return d.selectExpr("dataset", "issue", f"{C.subcategory('dataset', 'issue', 'general')} as sub", f"{C.data_type('dataset')} as data_type")


@query(f"select {_o_issue('dataset_id', 'text')} as value, count(*) as n from documents where dataset_id is not null group by 1")
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents through bronze and silver to counts by issue, the text standing as the title."""
    docs = table(spark, sf_dir, "documents").where("dataset_id is not null").selectExpr("dataset_id as dataset", "doc_id as id", "text as description")
    made = M.silver(docs.withColumnRenamed("dataset", "dataset_id"), "dataset_id", title="description")
    return S.facets(made, "primary_issue", None)


@query(f"select resource_type, count(*) as n from (select {_o_type('package_id')} as resource_type from resources) group by 1")
def classify_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "resources").groupBy(F.expr(C.data_type("package_id")).alias("resource_type")).agg(F.count("*").alias("n"))


@query(f"""
select doc_id, concat_ws(' ', {_o_issue('dataset_id')}, list_aggregate(list_sort(list_distinct(string_split(dataset_id, '-'))), 'string_agg', ',')) as words
from documents where dataset_id is not null""")
def issue_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").where("dataset_id is not null")
    return d.selectExpr("doc_id", f"concat_ws(' ', {C.primary_issue('dataset_id', default='uncategorized')}, array_join(array_sort(array_distinct(split(dataset_id, '-'))), ',')) as words")


# --- bronze and silver


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "assets").selectExpr("asset_id as id", "dataset_id", "asset_type", "asset_label", "latitude", "longitude")
    return M.bronze(src, "dataset_id", loaded_at="timestamp '2024-01-01 00:00:00'")


_O_CANON = "concat_ws('|', " + ", ".join(f"concat('{c}=', coalesce(cast({'asset_id' if c == 'id' else c} as varchar), '~'))" for c in ["asset_label", "asset_type", "dataset_id", "id", "latitude", "longitude"]) + ")"


@query(f"select concat_ws(':', dataset_id, 'unknown_source', cast(asset_id as varchar)) as raw_id, dataset_id as dataset, md5({_O_CANON}) as checksum from assets")
def bronze_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze(spark, sf_dir).selectExpr("_raw_id as raw_id", "_dataset_id as dataset", "_checksum as checksum")



@query(f"""
select outbreak_id, {_o_value('institution_name')} as institution_name, {_o_value('causative_agent_1')} as causative_agent_1,
    case when lower({_o_trim('is_active')}) in {_NULLS} then null else upper({_o_trim('is_active')}) in ('Y', 'YES', 'TRUE', '1', 'ACTIVE') end as is_active
from outbreaks""")
def silver_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "outbreaks").selectExpr("outbreak_id", "institution_name as `Institution Name`", "causative_agent_1 as `Causative Agent-1`", "is_active as Active", "dataset_id as _rank")
    return M.normalised(src)


@query(f"""
with s as (select outbreak_id, dataset_id, {_o_issue('dataset_id')} as issue from outbreaks)
select concat_ws(':', dataset_id, 'unknown_resource', cast(outbreak_id as varchar)) as unique_id, issue as primary_issue, {_o_sub('dataset_id', 'issue')} as subcategory, {_o_type('dataset_id')} as data_type from s""")
def silver_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "outbreaks").withColumnRenamed("outbreak_id", "_id")
    return M.silver(src, "dataset_id").selectExpr("_unique_id as unique_id", "primary_issue", "subcategory", "data_type")


@query(rf"""
select operator_id, trim(regexp_replace(concat_ws(' ', nullif(trim({_o_value('est_name')}), ''), replace(replace(dataset_id, '-', ' '), '_', ' '), 'misc', 'health'), '\s+', ' ', 'g')) as searchable_text from operators""")
def searchable_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "operators").select("operator_id", "dataset_id", F.col("est_name").alias("name"))
    at = M.normalised(src).withColumns({"primary_issue": F.lit("health"), "subcategory": F.lit("misc")})
    kinds = {f.name: f.dataType.simpleString() for f in at.schema}
    return at.selectExpr("operator_id", f"{M.searchable_text(at.columns, kinds)} as searchable_text")


@query("""
select occ_id, case when occupancy_date ~ '^.{4}-.{2}-.{2}' then occupancy_date[1:10]
    when occupancy_date ~ '^.{2}/.{2}/.{4}$' then strftime(try_strptime(occupancy_date, '%m/%d/%Y'), '%Y-%m-%d') end as ins_date
from shelter_occupancy""")
def transform_shelter(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "shelter_occupancy").withColumn("_unique_id", F.col("occ_id").cast("string"))
    return M.transformed(src, "shelter").selectExpr("cast(_unique_id as bigint) as occ_id", "insDate as ins_date")


@query("""
select outbreak_id, case when dataset_id = 'outbreaks-in-toronto-healthcare-institutions' and length(date_outbreak_began) >= 10 then date_outbreak_began[1:10] end as ins_date, 'health' as primary_issue
from outbreaks""")
def transform_outbreak(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "outbreaks").withColumn("_unique_id", F.col("outbreak_id").cast("string"))
    return M.transformed(src, "outbreak").selectExpr("cast(_unique_id as bigint) as outbreak_id", "insDate as ins_date", "primary_issue")


@query("select obs_id, case when length(data_collection_date) >= 10 then data_collection_date[1:10] end as ins_date, 'uncategorized' as primary_issue from observations")
def transform_generic(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "observations").withColumn("_unique_id", F.col("obs_id").cast("string"))
    return M.transformed(src, "generic").selectExpr("cast(_unique_id as bigint) as obs_id", "insDate as ins_date", "primary_issue")


@query("select s_suppkey as supp_id, 'transportation' as primary_issue, 'road_safety' as subcategory, 'public_safety' as secondary, s_name as location_name from supplier")
def transform_red_light_charges(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "supplier").selectExpr("cast(s_suppkey as string) as _unique_id", "s_name as location_name", "s_nationkey as ward_number")
    return M.transformed(src, "red_light_charges").selectExpr("cast(_unique_id as bigint) as supp_id", "primary_issue", "subcategory", "array_join(secondary_issues, ',') as secondary", "location_name")


@query("""
select asset_id, nullif(try_cast(latitude as double), 0) as lat, nullif(try_cast(longitude as double), 0) as lon from assets
where nullif(try_cast(latitude as double), 0) is not null and nullif(try_cast(longitude as double), 0) is not null""")
def gold_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "assets").select("asset_id", "dataset_id", "latitude", "longitude")
    return M.gold(src, "timestamp '2024-01-01'").where("location is not null").selectExpr("asset_id", "location.lat as lat", "location.lon as lon")


@query(f"""
with v as (select outbreak_id, nullif(outbreak_type, '') as ot, nullif(causative_agent_1, '') as ag, nullif(is_active, '') as ac from outbreaks)
select outbreak_id, array_to_string(list_sort(list_distinct(list_filter([concat('outbreak_' || replace(lower(ot), ' ', '_')), case when ot is not null then 'outbreak' end,
    case when ac in ('true', 'Y', 'Yes', 'YES') then 'active' when ac in ('false', 'N', 'No', 'NO') then 'resolved' end,
    case when lower(trim(ag)) not in {_NULLS} then 'agent_' || replace(lower(ag), ' ', '_') end], lambda x: x is not null and x != ''))), ',') as tags from v""")
def outbreak_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "outbreaks").select("outbreak_id", "outbreak_type", "causative_agent_1", "is_active")
    return src.selectExpr("outbreak_id", f"array_join({M.tags(src.columns)}, ',') as tags")


@query(f"""
with s as (select asset_id, dataset_id, {_o_issue('dataset_id')} as issue from assets where dataset_id is not null)
select asset_id as id, issue as primary_issue, {_o_sub('dataset_id', 'issue')} as subcategory from s""")
def reprocess_from_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = M.from_bronze(_bronze(spark, sf_dir).where("_dataset_id is not null"), "id bigint, asset_type string, asset_label string, latitude string, longitude string", loaded_at="timestamp '2024-01-01'")
    return made.select("id", "primary_issue", "subcategory")


@query(f"""
select pos, package_id || '_' || coalesce(nullif(lower(trim(regexp_replace(regexp_replace(coalesce(nullif(name, ''), 'data'), '[^\\w\\s-]', '', 'g'), '[-\\s]+', '_', 'g'), '_'))[1:50], ''), '') as dataset_id,
    {_o_type("concat(package_id, ' ', coalesce(name, ''))")} as data_type from resources""")
def dataset_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = M.metadata("package_id", "name")
    return table(spark, sf_dir, "resources").selectExpr("pos", *[f"{meta[c]} as {c}" for c in ("dataset_id", "data_type")])


# --- upsert, delete, counts


@query("select user_id, event_id, event_type, value from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1")
def upsert_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts")
    order = [F.desc("ts"), F.desc("event_id")]
    cut = F.lit("2024-01-01").cast("timestamp_ntz")
    old, new = latest(e.where(F.col("ts") < cut), ["user_id"], order), latest(e.where(F.col("ts") >= cut), ["user_id"], order)
    return upserted(old, new, ["user_id"]).drop("ts")


@query("select c_custkey, coalesce(n.seg, c_mktsegment) as c_mktsegment, c_acctbal from customer left join (select o_custkey, max(o_orderpriority) as seg from orders where o_orderstatus = 'F' group by 1) n on o_custkey = c_custkey")
def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    new = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderpriority").alias("c_mktsegment"))
    return upserted(old, new.join(old.select("c_custkey"), "c_custkey", "left_semi"), ["c_custkey"], merge=True)




@query("select 'db.' || r_name as source, 'manual' as target from region where r_regionkey < 3 union all select 'db.' || n_name, lower(n_name) from nation where 'db.' || n_name not in (select 'db.' || r_name from region where r_regionkey < 3)")
def mapping_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cedarloom.config import mappings

    manual = table(spark, sf_dir, "region").where("r_regionkey < 3").selectExpr("concat('db.', r_name) as source", "'manual' as target")
    return mappings(manual, table(spark, sf_dir, "nation").selectExpr("concat('db.', n_name) as source", "lower(n_name) as target"))


# --- catalogue entries

_O_NAME = "trim(lower(coalesce(name, '')))"
for _s in FORMAT_SUFFIXES:
    _O_NAME = f"regexp_replace({_O_NAME}, '{_s.replace('.', '[.]')}$', '')"
_O_NAME = rf"trim(regexp_replace({_O_NAME}, '\s*\((csv|json|xml|xlsx|xls|txt|zip|shp)\)', '', 'gi'))"


@query(f"select normal_name, count(*) as n, array_to_string(list_sort(list_distinct(list(upper(coalesce(format, ''))))), ',') as formats from (select {_O_NAME} as normal_name, format from resources) group by 1 having count(*) > 1")
def find_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.find_duplicates(table(spark, sf_dir, "resources")).withColumn("formats", F.array_join("formats", ","))


_O_URLF = "nullif(regexp_extract(lower(url), '\\.(xlsx|xls|csv|json|geojson|xml|txt|zip|shp)$', 1), '')"


@query(f"""
select category, count(*) as n from (select case when datastore_active then 'datastore' when lower(coalesce(format, '')) = 'json' or {_O_URLF} = 'json' then 'json'
    when lower(coalesce(format, '')) = 'csv' or {_O_URLF} = 'csv' then 'csv'
    when lower(coalesce(format, '')) in ('shp', 'shapefile', 'geojson') or {_O_URLF} in ('shp', 'geojson') or regexp_matches(lower(coalesce(name, '')), 'shapefile|shape|geo') then 'geo'
    when lower(coalesce(format, '')) in ('xlsx', 'xls') or {_O_URLF} in ('xlsx', 'xls') then 'excel' else 'other' end as category
    from resources where coalesce(url, '') != '') group by 1""")
def categorize_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.categories(table(spark, sf_dir, "resources")).groupBy("category").agg(F.count("*").alias("n"))


_O_METHOD = """case {f} when 'xlsx' then 'xlsx' when 'xls' then 'xlsx' when 'csv' then 'csv' when 'json' then 'json_file' when 'geojson' then 'json_file' when 'xml' then 'xml' when 'txt' then 'txt' when 'shp' then 'shp' when 'shapefile' then 'shp'
    when 'zip' then case when regexp_matches(lower(concat(coalesce(name, ''), '|', url)), 'shapefile|shp|geo|boundary|wgs84|map|polygon|point|line|spatial|gis|geometry|coordinate|lat|lon|shape') then 'shp' else 'zip' end end"""


@query(f"select coalesce(method, 'none') as method, count(*) as n from (select case when coalesce(url, '') = '' then null when {_O_URLF} is not null then {_O_METHOD.format(f=_O_URLF)} when datastore_active then 'datastore' else {_O_METHOD.format(f='lower(format)')} end as method from resources) group by 1")
def resource_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.described(table(spark, sf_dir, "resources")).groupBy(F.coalesce("method", F.lit("none")).alias("method")).agg(F.count("*").alias("n"))


_O_YEAR = r"[_\-\s]?((?:19|20)\d{2})(?:[_\-\s]|$)"
_O_FILE = _O_NAME.replace("coalesce(name, '')", "regexp_extract(regexp_replace(coalesce(url, ''), '[?].*$', ''), '([^/]*)$', 1)")


@query(f"""
with a as (select *, {_O_NAME} as nn, {_O_FILE} as ff, regexp_extract(coalesce(url, ''), '{_O_YEAR}', 1) as yy from resources),
b as (select *, case when yy != '' then yy when ff != '' and ff != nn then ff else '' end as more from a),
c as (select *, coalesce(nullif(case when more != '' and regexp_extract(nn, '{_O_YEAR}', 1) = '' then concat(nn, ':', more) else nn end, ''), id, 'unknown') as sig,
    case when coalesce(url, '') = '' then null when {_O_URLF} is not null then {_O_URLF} when datastore_active then 'datastore'
        when lower(format) in ('json', 'geojson', 'csv', 'xlsx', 'xls', 'xml', 'txt', 'zip') then lower(format) when lower(format) in ('shp', 'shapefile') then 'shp' end as fm from b),
d as (select *, coalesce(list_position(['datastore', 'json', 'geojson', 'csv', 'xlsx', 'xls', 'xml', 'txt', 'zip', 'shp'], fm) - 1, 99) as prio from c)
select pos, signature, group_size from (select pos, sig as signature, count(*) over (partition by sig) as group_size, row_number() over (partition by sig order by prio, pos) as rn from d) where rn = 1""")
def dedup_best_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.deduplicated(table(spark, sf_dir, "resources")).select("pos", "signature", "group_size")


@query(f"""
select group_name, count(*) as n from (select coalesce(nullif(trim(regexp_replace(regexp_replace(regexp_replace({_O_NAME}, '{_O_YEAR}', '', 'g'), '[_\\-\\s]?v?\\d+(?:\\.\\d+)?(?:[_\\-\\s]|$)', '', 'g'), '[_\\-]+$', '')), ''), id, 'unknown') as group_name from resources) group by 1""")
def group_by_base_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.by_name(table(spark, sf_dir, "resources"), base=True).select("group_name", "n")


# --- names


@query(r"select p_partkey, trim(lower(regexp_replace(regexp_replace(regexp_replace(p_type || ' ' || p_name, '[- ]', '_', 'g'), '([a-z])([A-Z])', '\1_\2', 'g'), '_+', '_', 'g')), '_') as snake, lower(trim(regexp_replace(regexp_replace(p_name, '[^\w\s-]', '', 'g'), '[-\s]+', '_', 'g'), '_'))[1:50] as clean from part")
def snake_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr("p_partkey", f"{N.snake_sql(chr(99) + 'oncat(p_type, ' + chr(39) + ' ' + chr(39) + ', p_name)')} as snake", f"{N.clean_id_sql('p_name')} as clean")


@query("select outbreak_id, case when lower(trim(is_active)) in ('y', 'yes', 'true', '1', 'active', 'open') then true when lower(trim(is_active)) in ('n', 'no', 'false', '0', 'inactive', 'closed') then false end as flag from outbreaks")
def parse_booleans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "outbreaks").selectExpr("outbreak_id", f"{C.parse_boolean('is_active')} as flag")


# --- filters, facets, statistics


@query("select o_orderkey from orders where o_orderstatus = 'F' and o_orderpriority in ('1-URGENT', '2-HIGH') and o_totalprice between 1000 and 200000")
def filter_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.where(S.condition(o, {"o_orderstatus": "F", "o_orderpriority": ["1-URGENT", "2-HIGH"]})).where("o_totalprice between 1000 and 200000").select("o_orderkey")



@query("select event_type as value, count(*) as n from events where event_type is not null group by 1 order by n desc, value limit 50")
def facet_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.facets(table(spark, sf_dir, "events"), "event_type", 50)


@query("select asset_id from assets where len(list_filter(regexp_split_to_array(lower(asset_type), '[^a-z]+'), lambda t: t in ('bike', 'stop'))) > 0")
def search_neighbourhood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.in_neighbourhood(table(spark, sf_dir, "assets"), "The Bike Stop", "asset_type").select("asset_id")


@query("select value, count(*) as n from (select unnest(list_distinct(list_filter(string_split(lower(asset_type || ' ' || dataset_id), ' '), lambda x: x != ''))) as value from assets) group by 1")
def facet_multivalued(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = table(spark, sf_dir, "assets").selectExpr("filter(split(lower(concat(asset_type, ' ', dataset_id)), ' '), x -> x != '') as words")
    return S.facets(at, "words", None)


@query("""
select 'total' as kind, cast(null as varchar) as value, count(*) as n from documents union all select 'dataset', dataset_id, count(*) from documents group by 2
union all select 'category', source, count(*) from documents group by 2""")
def index_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.statistics(table(spark, sf_dir, "documents"), "dataset_id", "source")




_O_DIST = "2 * 6371.0088 * asin(sqrt(pow(sin(radians(lat - 43.65) / 2), 2) + cos(radians(43.65)) * cos(radians(lat)) * pow(sin(radians(lon - -79.38) / 2), 2)))"


@query(f"select c_custkey, round({_O_DIST}, 6) as km from (select c_custkey, 43 + (c_custkey % 1000) / 500.0 as lat, -80 + (c_custkey % 777) / 500.0 as lon from customer) where {_O_DIST} <= 50")
def geo_nearby(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = table(spark, sf_dir, "customer").selectExpr("c_custkey", "43 + (c_custkey % 1000) / 500D as latitude", "-80 + (c_custkey % 777) / 500D as longitude")
    return S.within(at, 43.65, -79.38, "50km").selectExpr("c_custkey", "round(distance_km, 6) as km")


# --- text search

_O_STOP = "(" + ", ".join(f"'{w}'" for w in STOP_WORDS) + ")"
def _o_bm25(terms: str, boost: str) -> str:
    return f"""
toks as (select field, doc_id, list_filter(regexp_split_to_array(lower(txt), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t != '' and t not in {_O_STOP}) as ts from fields),
lens as (select field, doc_id, len(ts) as len from toks where len(ts) > 0),
corpus as (select field, count(*) as n, avg(len) as avgdl from lens group by 1),
occ as (select field, doc_id, tok, count(*) as tf from (select field, doc_id, unnest(ts) as tok from toks) where tok in {terms} group by all),
df as (select field, tok, count(*) as df from occ group by all),
per as (select field, doc_id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / avgdl))) as s from occ join df using (field, tok) join lens using (field, doc_id) join corpus using (field) group by all)
select doc_id, round(max(s * {boost}), 6) as score from per group by 1"""


@query("with fields as (select 'text' as field, doc_id, text as txt from documents)," + _o_bm25("('inspection', 'water', 'kitchen')", "1"))
def text_search_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = S.build_index(table(spark, sf_dir, "documents"), "doc_id", ["text"])
    return S.scored(index, S.analyse("inspection of water in the kitchen")).selectExpr("doc_id", "round(score, 6) as score")


@query("with fields as (select 'estName' as field, pos as doc_id, name as txt from resources union all select 'description', pos, description from resources)," + _o_bm25("('beach', 'samples')", "case field when 'estName' then 2 else 1 end"))
def multi_field_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "resources").selectExpr("pos", "name as estName", "description")
    return S.scored(S.build_index(docs, "pos", ["estName", "description"]), ["beach", "samples"]).selectExpr("doc_id", "round(score, 6) as score")


@query("""
select tok, count(*) as df from (select distinct asset_id, unnest(list_filter(regexp_split_to_array(lower(asset_type), '[^\\p{L}\\p{N}]+'), lambda t: t != '')) as tok from assets)
where damerau_levenshtein(tok, 'fountian') <= 2 or damerau_levenshtein(tok, 'tre') <= 1 group by 1""")
def fuzzy_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = S.build_index(table(spark, sf_dir, "assets").select("asset_id", "asset_type"), "asset_id", ["asset_type"], stop=False)
    return S.expanded(index, ["fountian", "tre"], fuzzy=True).select("tok", "df")


@query("select operator_id from operators where len(list_filter(regexp_split_to_array(lower(est_name), '[^\\p{L}\\p{N}]+'), lambda t: starts_with(t, 'cat'))) > 0")
def autocomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "operators").where(f"array_contains({S.prefixes('est_name')}, 'cat')").select("operator_id")


@query(r"select asset_id, regexp_replace(asset_type, '\b(tree|fountain)\b', '<em>\1</em>', 'gi') as marked from assets")
def highlight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "assets").selectExpr("asset_id", f"{S.highlighted('asset_type', ['tree', 'fountain'])} as marked")


@query()
def search_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    index = S.build_index(docs, "doc_id", ["text"], stemming=True)
    return S.search(docs, index, "doc_id", S.Request("broken handrails", {"source": ["inspection_notes", "council_minutes"]}, size=20))[0].select("doc_id", "score")


# --- synchronisation


@query("select occ_id from shelter_occupancy where loaded_at > timestamp '2022-01-01'")
def incremental_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "shelter_occupancy")
    state = src.select("dataset_id").distinct().withColumn("watermark", F.lit("2022-01-01").cast("timestamp_ntz"))
    return newer(src, state).select("occ_id")


@query("select dataset_id, count(*) as documents, max(loaded_at) as watermark from shelter_occupancy group by 1")
def sync_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progress(table(spark, sf_dir, "shelter_occupancy"))


@query("select dataset_id, count(*) as in_source, count(*) filter (loaded_at <= timestamp '2022-01-01') as in_target, count(*) filter (loaded_at > timestamp '2022-01-01') as gap from outbreaks group by 1")
def sync_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "outbreaks")
    return gap(src, src.where("loaded_at <= timestamp_ntz '2022-01-01 00:00:00'"))


@query("select distinct dataset_id from assets where dataset_id not in (select min(dataset_id) from assets)")
def pending_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "assets")
    return pending(a, a.agg(F.min("dataset_id").alias("dataset_id")).withColumn("status", F.lit("completed")))


# --- JSON, feeds


@query("select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr("event_id", "try_variant_get(try_parse_json(props), '$.k', 'bigint') as k")


@query("""
select pos, case when url is null or regexp_matches(lower(url), '\\.(html|htm|php|aspx|jsp)$') then false when regexp_matches(lower(url), '//[^/?#]*feeds\\.') then true when regexp_matches(url, '#.') then false
    else regexp_matches(lower(url), '\\.rss|\\.xml|\\.atom|\\.feed|rss|atom|feed|xml|/news/|/feeds/|/syndication/') end as feed from resources""")
def feed_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "resources").selectExpr("pos", f"{is_feed('url')} as feed")


@query("select url, min(pos) as pos from resources where coalesce(url, '') != '' group by 1")
def feed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_feeds(table(spark, sf_dir, "resources").select("pos", "url"), ["pos"])


@query()
def infer_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cedarloom.operators.infer import field_types, fields

    raw = table(spark, sf_dir, "raw_records").selectExpr("source_file", "try_parse_json(original) as record").where("record is not null")
    return field_types(fields(raw))
