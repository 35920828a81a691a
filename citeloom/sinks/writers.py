"""Writers: routed and partitioned JSON, sorted value lists, CSV, caches that only grow, run reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X


def partitioned_json(rows: DataFrame, path: str, *columns: str, mode: str = "errorifexists") -> None:
    """One directory for each value of the columns. Rows are gathered by them first, so that files stay few; Spark splits what is
    gathered for a value that many rows have."""
    rows.hint("rebalance", *(F.col(c) for c in columns)).write.mode(mode).partitionBy(*columns).json(path)


def manifest(rows: DataFrame, *columns: str) -> DataFrame:
    """What ``partitioned_json`` writes: each value of the columns with its number of rows."""
    return rows.groupBy(*columns).agg(F.count("*").alias("papers"))


def file_names(rows: DataFrame, column: str) -> DataFrame:
    """(value, file_name) of each distinct value: safe names that differ without case too. Of values (without extra blanks) whose names
    are equal the first keeps the plain one, the others get a digest."""
    names = rows.select(column, X.collapse(F.col(column)).alias("_text")).distinct()
    each = names.select("_text").distinct().withColumn("_safe", X.safe_name(F.col("_text"))).withColumn("_n", F.row_number().over(Window.partitionBy(F.lower("_safe")).orderBy("_text")))
    digest = F.concat(F.substring("_safe", 1, 149), F.lit("_"), F.substring(F.sha1("_text"), 1, 10))
    return names.join(each.select("_text", F.concat(F.when(F.col("_n") == 1, F.col("_safe")).otherwise(digest), F.lit(".json")).alias("file_name")), "_text").select(column, "file_name")


def sorted_values(rows: DataFrame, column: str, path: str) -> None:
    """The distinct non-blank values in order, as text files whose names follow the order."""
    rows.select(X.collapse(F.col(column)).alias("value")).where("value <> ''").distinct().orderBy("value").write.text(path)


def csv(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    rows.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def grow_cache(spark: SparkSession, fresh: DataFrame, path: str, key: str, statuses: tuple[str, ...]) -> DataFrame:
    """Adds entries with a terminal status whose key is not in the cache, and returns the cache."""
    new = fresh.where(F.col("status").isin(*statuses)).dropDuplicates([key])
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        new = new.join(spark.read.parquet(path).select(key), key, "left_anti").select(*fresh.columns)
    new.write.mode("append").parquet(path)
    return spark.read.parquet(path)


def run_report(counted: DataFrame, name: str, value: str, path: str | None = None) -> dict[str, int]:
    """A small table of counters as a dict, and as one JSON line if a path is given."""
    if path:
        counted.coalesce(1).write.mode("overwrite").json(path)
    return {r[name]: r[value] for r in counted.select(name, value).collect()}


def markdown(summary: DataFrame) -> str:
    """A Markdown table of a small summary."""
    head = "| " + " | ".join(summary.columns) + " |\n|" + "---|" * len(summary.columns)
    return "\n".join([head, *("| " + " | ".join("" if v is None else str(v) for v in row) + " |" for row in summary.collect())])
