"""Portals over HTTP: files, package metadata, and paged records as a data source. Nothing here runs
unless it is called; tests use a local server."""

from __future__ import annotations

import json
import os
import urllib.error
import urllib.request
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PAGE = 32000


@dataclass
class Fetched:
    ok: bool
    path: str | None = None
    reason: str = ""


def download(url: str, path: str, timeout: float = 60) -> Fetched:
    """Bytes of a URL into a file; ok is false, with the reason, on an HTTP error or no answer."""
    try:
        with urllib.request.urlopen(url, timeout=timeout) as r:
            os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
            with open(path, "wb") as f:
                while chunk := r.read(1 << 20):
                    f.write(chunk)
        return Fetched(True, path)
    except urllib.error.HTTPError as e:
        return Fetched(False, None, {403: "forbidden", 404: "not found"}.get(e.code, f"status {e.code}"))
    except (urllib.error.URLError, TimeoutError) as e:
        return Fetched(False, None, f"no answer: {e}")


def _json(url: str, timeout: float = 60):
    with urllib.request.urlopen(url, timeout=timeout) as r:
        return json.load(r)


def package(base: str, name: str) -> dict:
    return _json(f"{base.rstrip('/')}/api/3/action/package_show?id={quote(name)}").get("result") or {}


def resources_of(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The catalogue entries of a package, with their position."""
    rows = [(i, name, *(r.get(k) for k in ("id", "name", "format", "url", "datastore_active"))) for i, r in enumerate(package(base, name).get("resources", []))]
    return spark.createDataFrame(rows, "pos bigint, package_id string, id string, name string, format string, url string, datastore_active boolean")


def records_at(url: str) -> list[dict]:
    """A list; the first list under data, records or results; else the object itself."""
    data = _json(url)
    if isinstance(data, list):
        return data
    if not isinstance(data, dict):
        raise ValueError("neither an object nor a list")
    return next((data[k] for k in ("data", "records", "results") if isinstance(data.get(k), list)), [data])


class _Page(InputPartition):
    def __init__(self, offset: int):
        self.offset = offset


class RecordsSource(DataSource):
    """Format "ckan_records": options base, resource, limit. One partition a page; (position, record)
    with the record as JSON."""

    @classmethod
    def name(cls) -> str:
        return "ckan_records"

    def schema(self) -> str:
        return "position bigint, record string"

    def reader(self, schema) -> DataSourceReader:
        return _RecordsReader(self.options)


class _RecordsReader(DataSourceReader):
    def __init__(self, options):
        self.limit = int(options.get("limit", PAGE))
        self.url = f"{options['base'].rstrip('/')}/api/3/action/datastore_search?id={quote(options['resource'])}&limit="

    def partitions(self):
        total = (_json(f"{self.url}0&offset=0").get("result") or {}).get("total", 0)
        return [_Page(o) for o in range(0, max(total, 1), self.limit)]

    def read(self, partition):
        rows = (_json(f"{self.url}{self.limit}&offset={partition.offset}").get("result") or {}).get("records", [])
        for i, r in enumerate(rows):
            yield partition.offset + i, json.dumps(r)


def read_records(spark: SparkSession, base: str, resource: str, limit: int = PAGE) -> DataFrame:
    spark.dataSource.register(RecordsSource)
    return spark.read.format("ckan_records").options(base=base, resource=resource, limit=str(limit)).load()
