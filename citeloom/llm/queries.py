"""Registered queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from . import canonical, dedupe, matching, names, packing, quality, survivorship, tokens, vectors
from .graph import stage


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.match(_read(spark, sf_dir, "paper_new"), _read(spark, sf_dir, "load_to_zilliz")).select("row_id", "id")


def p1_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The matches with their calibrated probabilities."""
    found = matching.match(_read(spark, sf_dir, "paper_new"), _read(spark, sf_dir, "load_to_zilliz"))
    return found.withColumnRenamed("confidence", "probability")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.find_repeats(_read(spark, sf_dir, "paper_new"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivorship.survivors(_read(spark, sf_dir, "paper_new"))


def p3_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surviving record of each paper; sources with full papers are trusted more."""
    trust = _read(spark, sf_dir, "source_mapping").groupBy("source").agg(F.max(F.when(F.col("full_paper") == "yes", 1).otherwise(0)).alias("priority"))
    return survivorship.surviving_records(_read(spark, sf_dir, "paper_new"), trust=trust)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.close_pairs(_read(spark, sf_dir, "paper_prod")).select("uid_a", "uid_b")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda t: _read(spark, sf_dir, t)
    return canonical.map_column(read("coverage_input"), "input_id", "dblp_source", read("source_mapping"), read("source_list"))


def p6_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of typed venues that are in no list."""
    read = lambda t: _read(spark, sf_dir, t)
    return canonical.misses(read("coverage_input"), "dblp_source", read("source_mapping"), read("source_list"))


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.encode(_read(spark, sf_dir, "documents"))


def _sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents")
    return stage(tokens.token_counts(documents).join(documents.select("doc_id", "source"), "doc_id"), "counts")


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_sized(spark, sf_dir), _read(spark, sf_dir, "embed_window"))


def p8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How near runs of containers come to given targets: once the sources' own shares, once shares that favour small sources."""
    counts, windows = _sized(spark, sf_dir), _read(spark, sf_dir, "embed_window")
    parts = []
    for target, shares in (("own", packing.own_shares(counts)), ("damped", packing.damped_shares(counts))):
        parts.append(packing.mixture(packing.pack(counts, windows, shares), shares).withColumn("target", F.lit(target)))
    return parts[0].unionAll(parts[1])


def p8_room_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.room_left(p8_containers(spark, sf_dir))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.variant_pairs(_read(spark, sf_dir, "load_to_zilliz"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_prose(quality.text_statistics(_read(spark, sf_dir, "documents")))


def p9_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.text_statistics(_read(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p1_found": p1_found, "p1_confidence": p1_confidence, "p2_found": p2_found, "p3_found": p3_found, "p3_records": p3_records, "p4_found": p4_found, "p5_found": p5_found, "p6_found": p6_found, "p6_misses": p6_misses, "p7_ids": p7_ids, "p8_containers": p8_containers, "p8_room_left": p8_room_left, "p8_mixture": p8_mixture, "p9_found": p9_found, "p9_statistics": p9_statistics}


def oracle_sql() -> dict[str, str]:
    return {}
