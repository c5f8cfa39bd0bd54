"""Queries that write tables as files or stores and read them again through the operators."""

from __future__ import annotations

import os
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cedarloom.functions.values import sanitised
from cedarloom.io import scratch, table
from cedarloom.operators import medallion as M
from cedarloom.operators import resources as R
from cedarloom.operators import search as S
from cedarloom.operators.stores import Store
from cedarloom.plans.lakehouse import _O_NAME, Query, _o_issue, _o_value
from cedarloom.sources import feeds, files, sheets
from cedarloom.streaming.sync import Sync, index_enriched, load, quick_sync, status, sync_report

_Q: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str):
    def add(f: Query) -> Query:
        _Q[f.__name__], _SQL[f.__name__] = f, sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _local(spark: SparkSession, label: str) -> str:
    """A scratch folder for files that Python writes; made here, seen by the executors."""
    path = scratch(spark, label).removeprefix("file:")
    os.makedirs(path)
    return path


# --- files


@query("select c_custkey, c_name, c_mktsegment, c_acctbal from customer")
def source_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "csv")
    table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal").write.option("header", True).csv(path)
    return files.read_csv(spark, path).selectExpr("cast(c_custkey as bigint) as c_custkey", "c_name", "c_mktsegment", "cast(c_acctbal as double) as c_acctbal")


@query("select premise_id, address, city from premises")
def source_csv_latin1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values with accents, in an encoding nobody states."""
    path = scratch(spark, "latin1")
    table(spark, sf_dir, "premises").select("premise_id", "address", "city").write.options(header=True, encoding="ISO-8859-1", nullValue="\\N", emptyValue="", quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    back = files.read_csv(spark, path, infer=False)
    return back.selectExpr("cast(premise_id as bigint) as premise_id", *[f"nullif({c}, '\\\\N') as {c}" for c in ("address", "city")])


@query("select 'records' as structure, n_nationkey, n_name, n_regionkey from nation")
def source_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document a region, with its nations under the key records."""
    path = scratch(spark, "json")
    docs = table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.collect_list(F.struct("n_nationkey", "n_name", "n_regionkey")).alias("records"))
    docs.selectExpr("n_regionkey as part", "to_json(struct(records)) as value").write.partitionBy("part").text(path)
    at = files.read_json(spark, path)
    return at.selectExpr("structure", "try_variant_get(record, '$.n_nationkey', 'bigint') as n_nationkey", "try_variant_get(record, '$.n_name', 'string') as n_name", "try_variant_get(record, '$.n_regionkey', 'bigint') as n_regionkey")


@query("select district_id, ward_name, geometry_type as kind, 'Feature' as feature_type from districts")
def source_geojson(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "geojson")
    feature = "struct('Feature' as type, district_id as id, struct(district_id, ward_name) as properties, parse_json(geometry) as geometry)"
    table(spark, sf_dir, "districts").selectExpr(f"{feature} as f").agg(F.collect_list("f").alias("features")).selectExpr("to_json(struct('FeatureCollection' as type, features)) as value").write.text(path)
    flat = files.flatten_features(files.read_json(spark, path))
    return flat.selectExpr("cast(fields['district_id'] as bigint) as district_id", "cast(fields['ward_name'] as string) as ward_name", "get_json_object(geometry, '$.type') as kind", "_feature_type as feature_type")


@query("select s_suppkey, s_name, s_nationkey from supplier")
def source_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "xml")
    row = "concat('<row><s_suppkey>', s_suppkey, '</s_suppkey><s_name> ', s_name, ' </s_name><s_nationkey>', s_nationkey, '</s_nationkey></row>')"
    at = table(spark, sf_dir, "supplier").groupBy(F.expr("s_suppkey % 4 as part")).agg(F.array_join(F.collect_list(F.expr(row)), "").alias("rows"))
    at.selectExpr("concat('<rows xmlns=\"urn:x\">', rows, '</rows>') as value", "part").write.partitionBy("part").text(path)
    read = files.read_xml(spark, path)
    return read.selectExpr("cast(fields['s_suppkey'] as bigint) as s_suppkey", "fields['s_name'] as s_name", "cast(fields['s_nationkey'] as bigint) as s_nationkey")


@query("select p_partkey, p_name, p_type from part")
def source_delimited_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delimiter is found in the first lines; a column without values goes."""
    path = scratch(spark, "pipe")
    table(spark, sf_dir, "part").selectExpr("p_partkey as `P-PartKey`", "p_name as `P Name`", "p_type as `p.type`", "cast(null as string) as nothing", "'' as empty").coalesce(1).write.options(header=True, sep="|").csv(path)
    return files.read_txt(spark, path).selectExpr("cast(p_partkey as bigint) as p_partkey", "p_name", "p_type")


@query("select row_number() over (order by p_partkey) * 2 as line_number, 'part ' || p_partkey || ' ' || p_name as content from part")
def source_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second line is blank: numbers are those of the file, blank lines are no rows."""
    path = scratch(spark, "lines")
    rows = table(spark, sf_dir, "part").orderBy("p_partkey").selectExpr("concat(' \\n  part ', p_partkey, ' ', p_name, ' ') as value")
    rows.coalesce(1).write.text(path)
    return files.read_txt(spark, path).selectExpr("cast(line_number as bigint) as line_number", "content")


@query("select cast(n_nationkey as varchar) as n_nationkey, n_name, cast(n_regionkey as varchar) as n_regionkey from nation")
def source_fixed_width(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "fixed")
    head = spark.range(1).selectExpr("0 as i", "concat(rpad('n_nationkey', 15, ' '), rpad('n_name', 30, ' '), 'n_regionkey') as value")
    body = table(spark, sf_dir, "nation").selectExpr("1 + n_nationkey as i", "concat(rpad(n_nationkey, 15, ' '), rpad(n_name, 30, ' '), n_regionkey) as value")
    head.unionByName(body).coalesce(1).sortWithinPartitions("i").select("value").write.text(path)
    return files.read_txt(spark, path)


@query("select n_name as nation_name, cast(n_nationkey as varchar) as nation_no, cast(n_regionkey * 10.0 as varchar) as nation_no_pct from nation")
def source_xlsx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A title above the header, a column of shares, an empty column, a row of sums."""
    rows = [[r["n_name"], r["n_nationkey"], r["n_regionkey"] / 10, None] for r in table(spark, sf_dir, "nation").collect()]  # 25 rows
    path = _local(spark, "xlsx") + "/n.xlsx"
    sheets.write_xlsx(path, {"Nations": [["List of nations", None, None, None], ["Nation  Name", "Nation No", "%", None], *rows, ["Total", 300, 1, None]]})
    return sheets.read_xlsx(spark, path)


@query("select 'a' as sheet, 'r_name' as k, r_name as v from region union all select 'b', 'n_name', n_name from nation")
def source_xlsx_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _local(spark, "xlsx") + "/two.xlsx"
    col = lambda t, c: [[c, "x no"], *([r[c], 1] for r in table(spark, sf_dir, t).select(c).collect())]  # noqa: E731, 5 and 25 rows
    sheets.write_xlsx(path, {"a": col("region", "r_name"), "b": col("nation", "n_name")})
    at = sheets.read_xlsx_sheets(spark, path, 0)
    return at.selectExpr("sheet", "explode(map_filter(fields, (k, v) -> k like '%name')) as (k, v)")


@query("select n_nationkey, n_name, 'data/n.csv' as member from nation")
def source_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The member of the best format of an archive."""
    folder = _local(spark, "zip")
    lines = "".join(f"{r['n_nationkey']},{r['n_name']}\n" for r in table(spark, sf_dir, "nation").collect())  # 25 rows
    with zipfile.ZipFile(f"{folder}/a.zip", "w") as z:
        z.writestr("readme.txt", "x")
        z.writestr("data/n.csv", "n_nationkey,n_name\n" + lines)
        z.writestr("__MACOSX/n.csv", "x")
    os.makedirs(f"{folder}/out")
    at = files.read_zip(spark, f"{folder}/a.zip", f"{folder}/out")
    return at.selectExpr("cast(n_nationkey as bigint) as n_nationkey", "n_name", f"'{files.list_files(f'{folder}/out')[0]}' as member")


@query("""select dataset_id, count(*) as indexed, max(p) as last from (select dataset_id, row_number() over (partition by dataset_id order by outbreak_id) - 1 as p from outbreaks where dataset_id is not null) group by 1""")
def index_enriched_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published files with metadata and records, indexed under positional ids."""
    path, store = scratch(spark, "enriched"), Store(spark, scratch(spark, "indexed"), "_unique_id")
    src = table(spark, sf_dir, "outbreaks").where("dataset_id is not null").select("dataset_id", "outbreak_id", "institution_name")
    M.enriched(src, "dataset_id", {"primary_issue": "'health'"}).selectExpr("md5(value) as part", "value").write.partitionBy("part").text(path)
    index_enriched(files.read_enriched(spark, path), store)
    return store.read().groupBy("dataset_id").agg(F.count("*").alias("indexed"), F.max(F.expr("cast(substring_index(_unique_id, ':', -1) as bigint)")).alias("last"))


@query("""select pos as page_id, regexp_replace(url, '\\.[a-z]+([?].*)?$', '.xml') as url, name as title, source from resources, (values ('link_tag'), ('a_tag')) s(source)
where url like 'http%' and name is not null and trim(name) != '' and name not like '%  %' and trim(name) = name""")
def feeds_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with a feed in the head, one in an anchor with a relative address, and other links."""
    at = table(spark, sf_dir, "resources").where("url like 'http%' and name is not null and trim(name) != '' and name not like '%  %' and trim(name) = name")
    feed = "regexp_replace(url, r'[.][a-z]+([?].*)?$', '.xml')"
    html = f"""concat('<html><head><link type="application/rss+xml" href="', {feed}, '" title="', name, '"><link rel="x" href="/s.css"></head><body><a href="/about.html">x</a>',
        '<a href="', regexp_extract({feed}, '[^/]*$', 0), '">', name, '</a></body></html>')"""
    return feeds.feeds(at.selectExpr("pos as page_id", "url", f"{html} as html")).select("page_id", "url", "title", "source")


# --- stores


@query("select user_id, event_id, event_type, value from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1")
def store_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches into one store; the last of a key wins, also where its dataset changed."""
    e = table(spark, sf_dir, "events").selectExpr("user_id", "event_id", "event_type", "value", "ts", "cast(event_id % 7 as string) as dataset_id")
    store, order, at = Store(spark, scratch(spark, "store"), "user_id"), [F.desc("ts"), F.desc("event_id")], F.lit("2024-01-01").cast("timestamp_ntz")
    store.upsert(e.where(F.col("ts") < at), order)
    store.upsert(e.where(F.col("ts") >= at), order)
    return store.read().select("user_id", "event_id", "event_type", "value")


@query("select (select count(distinct user_id) from events where event_id % 2 = 0) as stored, count(distinct user_id) as matched from (select user_id from events where event_id % 2 = 0 intersect select user_id from events where event_id % 2 = 1)")
def store_upsert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").selectExpr("user_id", "event_id", "'d' as dataset_id")
    store = Store(spark, scratch(spark, "store"), "user_id")
    store.upsert(e.where("event_id % 2 = 1"))
    got = store.upsert(e.where("event_id % 2 = 0"))
    return spark.createDataFrame([(got["stored"], got["matched"])], "stored bigint, matched bigint")


@query(f"select asset_id, dataset_id from assets where coalesce(dataset_id, '') != 'traffic-signals' and coalesce({_o_issue('dataset_id')}, '') != 'environment'")
def store_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset goes, then a category."""
    from cedarloom.functions.classify import primary_issue

    store = Store(spark, scratch(spark, "store"), "asset_id")
    store.upsert(table(spark, sf_dir, "assets").selectExpr("asset_id", "dataset_id", f"{primary_issue('dataset_id', default='uncategorized')} as primary_issue"))
    store.delete_dataset("traffic-signals")
    store.delete_by_category("environment")
    return store.read().select("asset_id", "dataset_id")


@query("select 'documents' as kind, cast(null as varchar) as value, count(*) as n from documents union all select 'datasets', null, count(distinct dataset_id) from documents union all select 'category', source, count(*) from documents group by 2")
def store_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, scratch(spark, "store"), "doc_id")
    store.upsert(table(spark, sf_dir, "documents").select("doc_id", "dataset_id", "source"))
    return store.stats("source")


@query("select asset_id, dataset_id from assets where dataset_id = 'traffic-signals' order by asset_id limit 7 offset 3")
def store_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, scratch(spark, "store"), "asset_id")
    store.upsert(table(spark, sf_dir, "assets").select("asset_id", "dataset_id"))
    return store.by_dataset("traffic-signals", 7, 3)


@query("select distinct dataset_id from assets union select distinct dataset_id from outbreaks")
def store_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, scratch(spark, "store"), "k")
    for t, k in (("assets", "asset_id"), ("outbreaks", "outbreak_id")):
        store.upsert(table(spark, sf_dir, t).selectExpr(f"concat('{t}', {k}) as k", "dataset_id"))
    return store.datasets()


@query("select count(*) filter (asset_id % 10 != 0) as valid, count(*) filter (asset_id % 10 = 0) as invalid, min(dataset_id || ':unknown_source:' || asset_id) filter (asset_id % 10 = 0) as first_invalid from assets where dataset_id is not null")
def integrity_of_changed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth record of the source changed after it was stored."""
    src = table(spark, sf_dir, "assets").where("dataset_id is not null").selectExpr("asset_id as id", "dataset_id", "asset_type")
    store = Store(spark, scratch(spark, "bronze"), "_raw_id", "_dataset_id")
    store.upsert(M.bronze(src, "dataset_id"))
    fresh = M.bronze(src.withColumn("asset_type", F.expr("case when id % 10 = 0 then concat(coalesce(asset_type, ''), '!') else asset_type end")), "dataset_id")
    return M.integrity(store.read(), fresh).selectExpr("valid", "invalid", "invalid_ids[0] as first_invalid")


@query(f"select 'outbreaks:unknown_resource:' || outbreak_id as unique_id, {_o_value('institution_name')} as institution_name from outbreaks")
def load_all_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze, silver and gold in turn; what stands in gold."""
    b, s, g = (Store(spark, scratch(spark, n), k) for n, k in (("b", "_raw_id"), ("s", "_unique_id"), ("g", "_unique_id")))
    src = table(spark, sf_dir, "outbreaks").select(F.col("outbreak_id").alias("id"), "institution_name")
    load(src, "'outbreaks'", b, s, g)
    return g.read().selectExpr("_unique_id as unique_id", "institution_name")


# --- synchronisation


def _synced(spark: SparkSession, sf_dir: str) -> tuple[Sync, DataFrame]:
    src = table(spark, sf_dir, "outbreaks").selectExpr("cast(outbreak_id as string) as _unique_id", "dataset_id", "institution_name", "loaded_at")
    sync = Sync(spark, Store(spark, scratch(spark, "gold"), "_unique_id"), scratch(spark, "state"))
    sync.run(src.where("loaded_at <= timestamp_ntz '2022-01-01 00:00:00'"))
    return sync, src


@query("select cast(outbreak_id as varchar) as unique_id, dataset_id from outbreaks")
def sync_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs equal one; the second takes only what is newer than the watermarks."""
    sync, src = _synced(spark, sf_dir)
    sync.run(src)
    return sync.target.read().selectExpr("_unique_id as unique_id", "dataset_id")


@query("select dataset_id, 'completed' as status, count(*) filter (loaded_at > timestamp '2022-01-01') as documents_synced, max(loaded_at) as watermark from outbreaks group by 1")
def sync_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    sync, src = _synced(spark, sf_dir)
    sync.run(src)
    return sync.state().selectExpr("dataset_id", "status", "documents_synced", "cast(watermark as timestamp_ntz) as watermark")


@query("select count(distinct dataset_id) as tracked, count(*) as documents, 0 as failed from outbreaks")
def sync_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    sync, src = _synced(spark, sf_dir)
    sync.full_resync(src)
    return status(sync.state()).selectExpr("tracked", "documents", "size(failed) as failed")


@query("select dataset_id, count(*) as in_source, count(*) filter (outbreak_id % 2 = 0) as in_target, 'completed' as status from outbreaks group by 1 having count(*) filter (outbreak_id % 2 = 0) > 0")
def sync_quick_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "outbreaks").selectExpr("cast(outbreak_id as string) as _unique_id", "outbreak_id", "dataset_id", "loaded_at")
    store, state = Store(spark, scratch(spark, "gold"), "_unique_id"), scratch(spark, "state")
    quick_sync(spark, src.where("outbreak_id % 2 = 0"), store, state)
    return sync_report(spark, store, state, src).where("in_target > 0").select("dataset_id", "in_source", "in_target", "status")


@query("select cast(outbreak_id as varchar) as unique_id, dataset_id from outbreaks")
def sync_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stream over the files of the table."""
    path = scratch(spark, "in")
    src = table(spark, sf_dir, "outbreaks").selectExpr("cast(outbreak_id as string) as _unique_id", "dataset_id", "loaded_at")
    src.repartition(3).write.parquet(path)
    sync = Sync(spark, Store(spark, scratch(spark, "gold"), "_unique_id"), scratch(spark, "state"))
    sync.stream(spark.readStream.schema(src.schema).parquet(path), scratch(spark, "ck")).awaitTermination()
    return sync.target.read().selectExpr("_unique_id as unique_id", "dataset_id")


# --- search


@query("select doc_id, published_at from documents where source in ('inspection_notes', 'council_minutes') and lang = 'en' order by published_at desc nulls last, doc_id limit 20 offset 10")
def search_newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a query: filters, newest first, the second page."""
    docs = table(spark, sf_dir, "documents")
    request = S.Request("", {"source": ["inspection_notes", "council_minutes"], "lang": "en"}, size=20, offset=10, time="published_at", fields=["doc_id", "published_at"])
    return S.search(docs, None, "doc_id", request)[0]


@query("select count(*) as total from documents where source = 'inspection_notes' and published_at >= timestamp '2022-01-01' and published_at <= timestamp '2023-06-30'")
def search_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    request = S.Request("", {"source": "inspection_notes"}, date_range=("published_at", "2022-01-01", "2023-06-30"))
    return S.search(table(spark, sf_dir, "documents"), None, "doc_id", request)[1]


@query("select event_id, ts from events where ts >= (select max(ts) from events) - interval 30 day order by ts desc, event_id limit 1000000")
def search_recent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    now = e.agg(F.max("ts")).first()[0]
    return S.recent(e, "ts", 30, f"timestamp_ntz '{now}'", 1_000_000).select("event_id", "ts")


_O_KM = "2 * 6371.0088 * asin(sqrt(pow(sin(radians(lat - 43.9) / 2), 2) + cos(radians(43.9)) * cos(radians(lat)) * pow(sin(radians(lon + 79.4) / 2), 2)))"


@query(f"select asset_id, round({_O_KM}, 6) as km from (select asset_id, try_cast(latitude as double) as lat, try_cast(longitude as double) as lon from assets) where {_O_KM} <= 60 order by {_O_KM}, asset_id limit 25")
def search_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assets near a place, nearest first."""
    at = table(spark, sf_dir, "assets").selectExpr("asset_id", "try_cast(latitude as double) as latitude", "try_cast(longitude as double) as longitude")
    page = S.search(at, None, "asset_id", S.Request("", near=(43.9, -79.4, "60km"), size=25))[0]
    return page.selectExpr("asset_id", "round(distance_km, 6) as km")


@query("select asset_type as value, count(*) as n from assets where dataset_id = 'street-tree-inventory' and asset_type is not null group by 1 order by n desc, 1 limit 20")
def aggregate_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.facets(table(spark, sf_dir, "assets"), "asset_type", 20, "dataset_id = 'street-tree-inventory'")


@query("""with t as (select distinct asset_id, unnest(list_filter(regexp_split_to_array(lower(asset_type), '[^\\p{L}\\p{N}]+'), lambda t: t != '')) as tok from assets)
select tok, count(*) as df from t where damerau_levenshtein(tok, 'fuontian') <= 2 or damerau_levenshtein(tok, 'rtee') <= 1 group by 1""")
def fuzzy_swaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms two swaps and one swap away."""
    index = S.build_index(table(spark, sf_dir, "assets").select("asset_id", "asset_type"), "asset_id", ["asset_type"], stop=False)
    return S.expanded(index, ["fuontian", "rtee"], fuzzy=True).select("tok", "df")


@query("select doc_id, count(*) as hits from (select doc_id, unnest(list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda t: t in ('kitchen', 'water')))) as t from documents) group by 1")
def written_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index that is written, and read by the buckets of its terms."""
    path = scratch(spark, "index")
    S.save_index(S.build_index(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", ["text"]), path)
    index = S.load_index(spark, path)
    found = S.scored(index, ["kitchen", "water"]).select("doc_id")
    return index.postings.where("tok in ('kitchen', 'water')").join(found, "doc_id").groupBy("doc_id").agg(F.count("*").alias("hits"))


# --- projections and names


_SHELTER = ["occupancy_date", "shelter_name", "facility_name", "sector", "shelter_address", "shelter_city", "shelter_postal_code", "shelter_province", "organization_name", "program_name"]


@query(f"""select cast(occ_id as varchar) as doc_id, dataset_id, 'housing' as primary_issue, 'shelter' as subcategory, 'record' as data_type, 'tenant' as issue_keywords, 'tenant' as searchable_text,
coalesce(capacity, -1) as capacity, coalesce(occupancy, -1) as occupancy, {', '.join(_SHELTER)} from shelter_occupancy""")
def transform_shelter_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "shelter_occupancy").withColumn("_unique_id", F.col("occ_id").cast("string"))
    head = ["doc_id", "dataset_id", "primary_issue", "subcategory", "data_type", "array_join(issue_keywords, ',') as issue_keywords", "searchable_text", "coalesce(capacity, -1) as capacity", "coalesce(occupancy, -1) as occupancy"]
    return M.transformed(src, "shelter").selectExpr(*head, *_SHELTER)


@query("select cast(outbreak_id as varchar) as doc_id, dataset_id, 'health' as primary_issue, cast(null as varchar) as subcategory, 'record' as data_type, date_outbreak_began, date_declared_over from outbreaks")
def transform_outbreak_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = table(spark, sf_dir, "outbreaks").withColumn("_unique_id", F.col("outbreak_id").cast("string"))
    return M.transformed(src, "outbreak").select("doc_id", "dataset_id", "primary_issue", "subcategory", "data_type", "date_outbreak_began", "date_declared_over")


@query("""select obs_id, case when isnan(w) then null else w end as water_temp, strftime(loaded_at, '%Y-%m-%dT%H:%M:%S') as loaded_at from (select obs_id, case when obs_id % 5 = 0 then 'NaN'::double else water_temp end as w, loaded_at from observations)""")
def sanitised_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = table(spark, sf_dir, "observations").selectExpr("obs_id", "case when obs_id % 5 = 0 then double('NaN') else water_temp end as water_temp", "loaded_at")
    return sanitised(at)


@query("select asset_id, concat_ws(' | ', nullif(asset_label, ''), nullif(dataset_id, '')) as text from assets")
def indexed_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where no field of the issue has a value all short texts count."""
    at = table(spark, sf_dir, "assets").selectExpr("asset_id", "asset_label", "dataset_id", "cast(null as string) as address", "'safety' as primary_issue").drop("x")
    kinds = {c: t for c, t in at.dtypes if c != "primary_issue"}
    return at.selectExpr("asset_id", f"{M.indexed_text(['asset_label', 'dataset_id', 'address'], kinds)} as text")


@query(f"""with r as (select *, {_O_NAME} as nn from resources) select a.pos as a, b.pos as b, lower(coalesce(a.format, '')) != lower(coalesce(b.format, '')) and a.nn = b.nn as is_duplicate
from r a join r b on a.package_id = b.package_id and a.pos < b.pos""")
def format_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the pairs of entries of a package, whether they are one file in two formats."""
    r = table(spark, sf_dir, "resources").select("package_id", "pos", "name", "format")
    side = lambda p: r.selectExpr("package_id", f"pos as {p}", f"name as name_{p}", f"format as format_{p}")
    return R.format_duplicates(side("a").join(side("b"), "package_id").where("a < b")).select("a", "b", "is_duplicate")
