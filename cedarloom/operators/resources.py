"""Catalogue entries: duplicates of a file in several formats, groups, categories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cedarloom.functions import classify as C
from cedarloom.functions.names import base_name_sql, names_match, resource_name_sql, signature_sql, url_name_sql
from cedarloom.functions.rows import once


def described(resources: DataFrame) -> DataFrame:
    """With normal_name, base_name, signature, method, method_format and priority (of the format to
    fetch, 99 where there is none)."""
    at = once(resources, normal_name=resource_name_sql("name"), _url_name=url_name_sql("url"))
    at = once(at, signature=signature_sql("normal_name", "_url_name", "url", "id"), how=C.resource_method("name", "format", "url", "datastore_active"))
    prio = C.format_priority("coalesce(case when how.method = 'datastore' then 'datastore' else how.format end, '')")
    return at.selectExpr(*resources.columns, "normal_name", f"{base_name_sql('normal_name')} as base_name", "signature", "how.method as method", "how.format as method_format", f"{prio} as priority")


def deduplicated(resources: DataFrame) -> DataFrame:
    """The entry of the best format of each signature (ties: first position), with the position
    where the signature first stood as group_pos."""
    at = described(resources)
    best = at.groupBy("signature").agg(F.min(F.struct("priority", "pos")).alias("b"), F.min("pos").alias("group_pos"), F.count("*").alias("group_size"))
    return at.join(best.selectExpr("b.pos as pos", "group_pos", "group_size"), "pos")


def by_name(resources: DataFrame, base: bool = False) -> DataFrame:
    """(group_name, n, positions) by normalised name, or without year and version; entries without a
    name go by their id."""
    at = described(resources)
    key = F.expr(f"coalesce(nullif({'base_name' if base else 'normal_name'}, ''), id, 'unknown')").alias("group_name")
    return at.groupBy(key).agg(F.count("*").alias("n"), F.sort_array(F.collect_list("pos")).alias("positions"))


def find_duplicates(resources: DataFrame) -> DataFrame:
    """(normal_name, n, formats) of names that several entries have."""
    at = described(resources).groupBy("normal_name").agg(F.count("*").alias("n"), F.expr("array_sort(array_distinct(collect_list(upper(coalesce(format, '')))))").alias("formats"))
    return at.where("n > 1")


def categories(resources: DataFrame) -> DataFrame:
    """Each entry with a URL and its category: datastore, json, csv, geo, excel or other."""
    fmt, end = "lower(coalesce(format, ''))", C.url_format("url")
    case = f"""case when datastore_active then 'datastore' when {fmt} = 'json' or {end} = 'json' then 'json' when {fmt} = 'csv' or {end} = 'csv' then 'csv'
        when {fmt} in ('shp', 'shapefile', 'geojson') or {end} in ('shp', 'geojson') or lower(coalesce(name, '')) rlike 'shapefile|shape|geo' then 'geo'
        when {fmt} in ('xlsx', 'xls') or {end} in ('xlsx', 'xls') then 'excel' else 'other' end"""
    return resources.where("coalesce(url, '') != ''").withColumn("category", F.expr(case))


def summary(resources: DataFrame) -> DataFrame:
    """A line of text for each duplicated name."""
    return find_duplicates(resources).selectExpr("concat(normal_name, ': ', cast(n as string), ' (', array_join(formats, ', '), ')') as line")


def format_duplicates(pairs: DataFrame) -> DataFrame:
    """pairs (name_a, format_a, name_b, format_b, ...) with is_duplicate: one name, two formats."""
    return pairs.withColumn("is_duplicate", F.expr(f"{names_match('name_a', 'name_b')} and lower(coalesce(format_a, '')) != lower(coalesce(format_b, ''))"))


def yearly(resources: DataFrame) -> DataFrame:
    """(base_name, n, names): the entries that are one but for year and version, where there are two
    names or more."""
    at = described(resources).where("normal_name != ''").groupBy("base_name").agg(F.count("*").alias("n"), F.sort_array(F.collect_set("normal_name")).alias("names"))
    return at.where("size(names) > 1")


def supported(resources: DataFrame) -> DataFrame:
    """The entries that some reader can read."""
    return described(resources).where("method is not null").select(*resources.columns)
