"""Settings from the environment, and the mapping of source tables to search tables."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Config:
    warehouse: str = "warehouse"
    feed_urls: tuple[str, ...] = ()
    tables: tuple[str, ...] = ()
    manual: dict[str, str] = field(default_factory=dict)
    prefixes: dict[str, str] = field(default_factory=dict)
    batch: int = 500


def _list(text: str) -> list[str]:
    return [x.strip() for x in text.split(",") if x.strip()]


def parse_pairs(text: str) -> dict[str, str]:
    """"a:b,c:d"; what has no colon or an empty side is left out, a later one of a key wins."""
    out = {}
    for item in _list(text):
        k, sep, v = item.rpartition(":")
        if sep and k.strip() and v.strip():
            out[k.strip()] = v.strip()
    return out


@lru_cache
def config() -> Config:
    e = os.environ.get
    return Config(e("WAREHOUSE_DIR", "warehouse"), tuple(_list(e("FEED_URLS", ""))), tuple(_list(e("SOURCE_TABLES", ""))), parse_pairs(e("TABLE_MAPPINGS", "")), parse_pairs(e("DATABASE_PREFIXES", "")), int(e("BATCH_SIZE", "500")))


def target_name(database: str, table: str, prefixes: dict[str, str]) -> str:
    """prefix-table with dashes for underscores; the database stands in for a missing prefix."""
    return f"{prefixes.get(database, database)}-{table}".replace("_", "-").lower()


def discovered(spark: SparkSession, databases: list[str], prefixes: dict[str, str]) -> DataFrame:
    """(source, target) of the tables of the databases, but for system ones."""
    rows = [(f"{d}.{t.name}", target_name(d, t.name, prefixes)) for d in databases for t in spark.catalog.listTables(d) if not re.match(r"system[._]", t.name) and not t.isTemporary]
    return spark.createDataFrame(rows, "source string, target string")


def mappings(manual: DataFrame, auto: DataFrame) -> DataFrame:
    """The manual mappings, and the automatic ones of sources without a manual one."""
    return manual.unionByName(auto.join(manual.select("source"), "source", "left_anti"))


def paths(base: str, dataset: str, name: str) -> dict[str, str]:
    """Where files of a dataset lie: raw, json, logs."""
    return {k: os.path.join(base, k, dataset, name) for k in ("raw", "json", "logs")}


def make_folders(base: str) -> None:
    for k in ("raw", "json", "logs"):
        os.makedirs(os.path.join(base, k), exist_ok=True)


@lru_cache
def store(layer: str, path: str | None = None):
    """The one store of a layer (bronze, silver, gold) below the warehouse, or at another path."""
    from cedarloom.operators.stores import Store

    key, dataset = {"bronze": ("_raw_id", "_dataset_id"), "silver": ("_unique_id", "dataset_id"), "gold": ("_unique_id", "dataset_id")}[layer]
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    return Store(spark, path or os.path.join(config().warehouse, layer), key, dataset)


__all__ = ["Config", "config", "discovered", "make_folders", "mappings", "parse_pairs", "paths", "store", "target_name"]
