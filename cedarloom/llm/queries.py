"""Queries of the problems on training data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cedarloom.io import cut, table
from cedarloom.llm.addresses import same_address
from cedarloom.llm.garble import judged
from cedarloom.llm.mixing import mix_report, mixed
from cedarloom.llm.names import same_name
from cedarloom.llm.packing import fill_report, packed
from cedarloom.llm.survivors import survivors
from cedarloom.llm.tokens import sized


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return same_address(table(spark, sf_dir, "premises"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return same_name(table(spark, sf_dir, "operators"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = survivors(table(spark, sf_dir, "resources"))
    return kept.selectExpr("keep_pos", "explode(map_concat(map('format', keep_pos), from_pos)) as (field_name, from_pos)")


def _sizes(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    return cut(sized(table(spark, sf_dir, "documents"), ["doc_id", *keep]), "sizes")


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(_sizes(spark, sf_dir), table(spark, sf_dir, "capacities"))


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_report(p7_containers(spark, sf_dir), table(spark, sf_dir, "capacities"))


def p7_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(capacity_id, documents, overfull, cut, uncovered, well_filled): documents packed, containers over
    their capacity, documents cut though they fit, and documents whose pieces are not all of them."""
    sizes, caps = _sizes(spark, sf_dir), table(spark, sf_dir, "capacities")
    pieces = cut(packed(sizes, caps).join(F.broadcast(caps), "capacity_id"), "pieces")
    bins = pieces.groupBy("capacity_id", "capacity_tokens", "container_id").agg(F.sum(F.expr("token_end - token_start")).alias("used"))
    bins = bins.groupBy("capacity_id").agg(F.count_if(F.expr("used > capacity_tokens")).alias("overfull"), F.expr("sum(used) / sum(capacity_tokens) >= 0.95").alias("well_filled"))
    docs = pieces.groupBy("capacity_id", "capacity_tokens", "doc_id").agg(F.count("*").alias("n"), F.sum(F.expr("token_end - token_start")).alias("t"), F.max("token_end").alias("end")).join(sizes, "doc_id")
    docs = docs.groupBy("capacity_id").agg(F.count("*").alias("documents"), F.count_if(F.expr("n > 1 and n_tokens <= capacity_tokens")).alias("cut"), F.count_if(F.expr("t != n_tokens or end != n_tokens")).alias("uncovered"))
    return docs.join(bins, "capacity_id").select("capacity_id", "documents", "overfull", "cut", "uncovered", "well_filled")


def p8_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, taken, over_cap, near_target): whether any document is taken, documents used too often,
    and whether the share is within a hundredth of the target among the sources that have documents."""
    targets, mix = table(spark, sf_dir, "mix_targets"), cut(p8_mix(spark, sf_dir), "mix")
    over = mix.join(F.broadcast(targets), "source").groupBy("source").agg(F.count_if(F.expr("copies > max_repeats")).alias("over_cap"))
    at = mix_report(mix, targets).join(over, "source", "left")
    got = at.where("tokens > 0").agg(F.sum("target_share").alias("whole"))
    at = at.join(F.broadcast(got))
    return at.selectExpr("source", "tokens > 0 as taken", "coalesce(over_cap, 0L) as over_cap", "tokens = 0 or abs(actual_share - target_share / whole) <= 0.01 * target_share / whole as near_target")


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(_sizes(spark, sf_dir, "source"), table(spark, sf_dir, "mix_targets")).drop("rate")


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(p8_mix(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents")).select("doc_id")


def p9_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents"), texts=True)


def queries() -> dict:
    return {
        "p2_found": p2_found,
        "p3_found": p3_found,
        "p4_found": p4_found,
        "p7_containers": p7_containers,
        "p7_fill": p7_fill,
        "p7_invariants": p7_invariants,
        "p8_mix": p8_mix,
        "p8_shares": p8_shares,
        "p8_invariants": p8_invariants,
        "p9_found": p9_found,
        "p9_restored": p9_restored,
    }


def oracle_sql() -> dict[str, str]:
    from cedarloom.llm.oracle import SQL

    return SQL
