"""Queries of the general problems: places, drifting schemas, instants."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from cedarloom.io import cut, table
from cedarloom.operators.drift import Drift, one_table
from cedarloom.operators.instants import long_values, normalise_instants
from cedarloom.operators.nearby import Tree, pairs_within, points_in_regions, stated_points

TIME_FIELDS = [
    ("shelter_occupancy", "occ_id", ["occupancy_date"]),
    ("outbreaks", "outbreak_id", ["date_outbreak_began"]),
    ("observations", "obs_id", ["data_collection_date", "collection_date"]),
]


def _times(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [long_values(table(spark, sf_dir, t), t, k, f) for t, k, f in TIME_FIELDS]
    return normalise_instants(reduce(DataFrame.unionByName, parts), "raw", ["table_name", "source_file"])


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _times(spark, sf_dir).where("utc_us is not null").select("table_name", "rec_id", "field_name", "utc_us")


# All true points lie in this box (south, north, west, east).
BOX = (43.0, 45.7, -83.0, -78.0)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = cut(stated_points(table(spark, sf_dir, "assets"), BOX), "points")
    tree = Tree(points)
    near = pairs_within(tree, 30.0).selectExpr("id_a as asset_id", "'asset' as other_kind", "id_b as other_id")
    regions = table(spark, sf_dir, "districts").selectExpr("district_id as region_id", "geometry")
    held = points_in_regions(tree, regions).selectExpr("id as asset_id", "'district' as other_kind", "region_id as other_id")
    return near.unionByName(held)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Drift(table(spark, sf_dir, "raw_records")).changes()


def p5_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = table(spark, sf_dir, "raw_records")
    return one_table(records, Drift(records))


def queries() -> dict:
    return {"p1_found": p1_found, "p5_found": p5_found, "p5_table": p5_table, "p6_found": p6_found}


def oracle_sql() -> dict[str, str]:
    from cedarloom.plans.problem_oracles import SQL

    return SQL
