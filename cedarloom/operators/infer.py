"""Field types of heterogeneous records, and the schema and report made of them."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cedarloom.functions.names import mapping_name

# Words in field names, date shapes, and rules by name.
DATE_WORDS = ["date", "time", "created", "updated", "timestamp", "began", "ended", "over"]
GEO_WORDS = ["lat", "lng", "longitude", "latitude", "location", "geometry", "coordinates"]
ID_WORDS = ["id", "_id", "code", "number", "no", "num"]
DATE_SHAPE = r"^(?:\d{4}-\d{2}-\d{2}$|\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}|\d{2}/\d{2}/\d{4}$|\d{4}/\d{2}/\d{2}$|\d{2}-\d{2}-\d{4}$)"
NAME_RULES = [(r".*_id", "keyword"), (r".*_code", "keyword"), (r".*_no", "keyword"), (r".*_pct", "float"), (r".*_date", "date"), (r"lat|lon|latitude|longitude|x_coord|y_coord", "float")]
SAMPLE = 100


def fields(records: DataFrame, source: str = "source_file", record: str = "record", depth: int = 4) -> DataFrame:
    """(path, value VARIANT, source, seq): every field of every record; objects are recorded and
    opened, down to `depth` levels."""
    spark = records.sparkSession
    own = records.selectExpr(f"`{source}` as source", f"`{record}` as v", "xxhash64(to_json(" + f"`{record}`" + ")) as seq")
    level = spark.sql("select source, seq, key as path, value as v from {own}, lateral variant_explode(v)", own=own)
    out = level
    for _ in range(depth - 1):
        opened = level.where("schema_of_variant(v) like 'OBJECT%'").withColumnRenamed("v", "doc")
        level = spark.sql("select source, seq, concat(path, '.', key) as path, value as v from {opened}, lateral variant_explode(doc)", opened=opened)
        out = out.unionByName(level)
    return out


def _words(words: list[str]) -> str:
    return "(" + " or ".join(f"contains(lower(path), '{w}')" for w in words) + ")"


def field_types(found: DataFrame) -> DataFrame:
    """(path, n, sources, type): by name, and the first 100 values that are not empty (by a hash of
    their record, so that the sample does not depend on the order of the files)."""
    text = "try_variant_get(v, '$', 'string')"
    kind = "regexp_extract(schema_of_variant(v), '^[A-Z]+', 0)"
    at = found.selectExpr("path", "source", "seq", f"{text} as s", f"{kind} as k", "try_variant_get(v, '$.lat', 'string') is not null and try_variant_get(v, '$.lon', 'string') is not null as pt",
        "(size(try_variant_get(v, '$', 'array<double>')) = 2 and not exists(try_variant_get(v, '$', 'array<double>'), x -> x is null)) as pair", "try_variant_get(v, '$.type', 'string') is not null and try_variant_get(v, '$.coordinates', 'string') is not null as shape")
    full = at.where("k != 'VOID' and coalesce(s, '') != ''")
    # the first values of each part of a field, then the first of those: no window holds a whole field
    part = full.selectExpr("*", "pmod(xxhash64(seq, s), 512) as part").selectExpr("*", "row_number() over (partition by path, part order by seq, s) as pn").where(f"pn <= {SAMPLE}")
    ranked = part.selectExpr("*", "row_number() over (partition by path order by seq, s) as rn").where(f"rn <= {SAMPLE}")
    kinds = "collect_set(case when k in ('BIGINT') then 'int' when k in ('DECIMAL', 'DOUBLE', 'FLOAT') then 'float' when k = 'BOOLEAN' then 'bool' when k = 'ARRAY' then 'list' when k = 'OBJECT' then 'dict' else 'str' end)"
    sums = ranked.groupBy("path").agg(
        F.expr(kinds).alias("kinds"), F.expr("max(rn <= 5 and (pt or coalesce(pair, false)))").alias("point"), F.expr("max(rn <= 5 and shape)").alias("shape"),
        F.expr(f"avg(case when rn <= 20 then case when s rlike r'{DATE_SHAPE}' then 1D else 0D end end)").alias("dates"), F.avg(F.length("s")).alias("len"), F.expr("count(distinct s) / count(*)").alias("uniq"),
    )
    only = lambda *k: f"size(array_except(kinds, array({', '.join(repr(x) for x in k)}))) = 0"
    case = f"""case when kinds is null then 'keyword' when {_words(GEO_WORDS)} and point then 'geo_point' when {_words(GEO_WORDS)} and shape then 'geo_shape'
        when {_words(DATE_WORDS)} or dates > 0.5 then 'date' when {only('int')} then 'long' when {only('int', 'float')} then 'float' when {only('bool')} then 'boolean'
        when array_contains(kinds, 'list') then 'keyword' when array_contains(kinds, 'dict') then 'object'
        when {only('str', 'int', 'float')} then case when {_words(ID_WORDS)} or (len < 50 and uniq > 0.8) or (len < 100 and uniq < 0.1) then 'keyword' else 'text' end
        else 'keyword' end as type"""
    every = found.groupBy("path").agg(F.count("*").alias("n"), F.count_distinct("source").alias("sources"))
    return every.join(sums, "path", "left").selectExpr("path", "n", "sources", case)


_SPARK = {"keyword": T.StringType(), "text": T.StringType(), "long": T.LongType(), "float": T.DoubleType(), "boolean": T.BooleanType(), "date": T.TimestampType(), "geo_point": T.StructType().add("lat", "double").add("lon", "double"), "geo_shape": T.StringType(), "object": T.VariantType()}
STANDARD = {
    "_unique_id": "keyword", "dataset_id": "keyword", "dataset_name": "text", "primary_issue": "keyword", "secondary_issues": "keyword", "subcategory": "keyword", "data_type": "keyword",
    "issue_keywords": "keyword", "searchable_text": "text", "loaded_at": "date", "indexed_at": "date", "source_file": "keyword", "location": "geo_point", "centroid": "geo_point",
}


def type_by_name(name: str, found: str) -> str:
    """Rules on the name before the type found."""
    import re

    return next((t for p, t in NAME_RULES if re.fullmatch(p, name)), found)


def mapping(types: DataFrame) -> dict[str, str]:
    """Normalised name to type: the standard fields, and over them those found, the later of one name
    winning; keys that begin with an underscore are left out, but for _id. One row a field comes to
    the driver."""
    out = dict(STANDARD)
    for r in types.orderBy("path").collect():
        leaf = r["path"]
        if not leaf.startswith("_") or leaf == "_id":
            out[mapping_name(leaf)] = r["type"]
    return out


def schema(fields_: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(k, _SPARK[v], True, {"role": v}) for k, v in fields_.items()])


def save(fields_: dict[str, str], path: str) -> None:
    with open(path, "w") as f:
        json.dump({"schema": json.loads(schema(fields_).json()), "roles": fields_}, f, indent=1)


def report(types: DataFrame) -> DataFrame:
    return types.selectExpr("format_string('%-40s %-10s %8d %4d', path, type, n, sources) as line")


def main(args: list[str] | None = None) -> None:
    """Command line: path [--output FILE] [--report]."""
    import argparse

    from pyspark.sql import SparkSession

    from cedarloom.sources.files import read_json

    p = argparse.ArgumentParser()
    p.add_argument("path")
    p.add_argument("--output")
    p.add_argument("--report", action="store_true")
    a = p.parse_args(args)
    types = field_types(fields(read_json(SparkSession.builder.getOrCreate(), a.path))).cache()
    if a.report:
        for r in report(types).collect():
            print(r["line"])
    if a.output:
        save(mapping(types), a.output)


if __name__ == "__main__":
    main()
