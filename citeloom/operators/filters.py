"""New-record detection, exclusion and deduplication against keys of what is there already."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X


def bibliography_key(c: Column) -> Column:
    return X.collapse(c)


def classify_new(batch: DataFrame, existing: DataFrame, excluded: DataFrame | None = None, excluded_titles: DataFrame | None = None) -> DataFrame:
    """``batch`` with a column ``reason``: excluded_title, excluded, missing_key, existing_key, existing_doi or new, the first that holds.

    Two left joins set flags, so no join is on an OR and each reason can be counted. Blank keys and DOIs match nothing."""
    keys = existing.select(bibliography_key(F.col("dblp_key")).alias("_k")).where("_k <> ''").distinct().withColumn("_has_key", F.lit(True))
    dois = existing.select(X.doi_key(F.col("doi")).alias("_d")).where("_d <> ''").distinct().withColumn("_has_doi", F.lit(True))
    out = batch.withColumn("_k", bibliography_key(F.col("dblp_key"))).withColumn("_d", X.doi_key(F.col("doi")))
    out = out.join(keys, "_k", "left").join(dois, "_d", "left")
    is_out = F.lit(False)
    if excluded is not None:
        bad = excluded.select(bibliography_key(F.col("dblp_key")).alias("_k")).where("_k <> ''").distinct().withColumn("_excluded", F.lit(True))
        out = out.join(bad, "_k", "left")
        is_out = F.coalesce("_excluded", F.lit(False))
    title_out = F.lit(False)
    if excluded_titles is not None:
        titles = excluded_titles.select(X.exclusion_title(F.col("title")).alias("_t")).where("_t <> ''").distinct().withColumn("_title", F.lit(True))
        out = out.withColumn("_t", X.exclusion_title(F.col("title"))).join(titles, "_t", "left")
        title_out = F.coalesce("_title", F.lit(False))
    reason = (
        F.when(title_out, "excluded_title").when(is_out, "excluded").when(F.coalesce("_has_key", F.lit(False)), "existing_key")
        .when(F.coalesce("_has_doi", F.lit(False)), "existing_doi").when(F.col("_k") == "", "missing_key").otherwise("new")
    )
    return out.withColumn("reason", reason).drop("_k", "_d", "_t", "_has_key", "_has_doi", "_excluded", "_title")


def reason_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy(X.label(F.col("source")).alias("source"), "reason").agg(F.count("*").alias("papers"))


def first_by_key(rows: DataFrame, key: Column, *order: Column) -> DataFrame:
    """The first row of each key in the given order; rows with a blank key are all kept.

    The key is combined before the window: only the first row's order is needed, so a hot key is no burden to one task."""
    keyed = rows.withColumn("_key", key)
    keyed = keyed.withColumn("_order", F.struct(*order))
    firsts = keyed.where("_key <> ''").groupBy("_key").agg(F.min("_order").alias("_first"))
    kept = keyed.join(firsts, "_key", "left").where("_key = '' or _key is null or _order = _first")
    return kept.drop("_key", "_order", "_first")


def keys_and_dois(papers: DataFrame) -> DataFrame:
    """The distinct keys and DOIs of a collection with how often each occurs: kind, value, n."""
    both = papers.select(F.explode(F.array(F.struct(F.lit("dblp_key").alias("kind"), bibliography_key(F.col("dblp_key")).alias("value")), F.struct(F.lit("doi").alias("kind"), X.doi_key(F.col("doi")).alias("value")))).alias("e"))
    return both.select("e.*").where("value <> ''").groupBy("kind", "value").agg(F.count("*").alias("n"))


def key_counts(papers: DataFrame) -> DataFrame:
    """kind, distinct_values, duplicates: how many keys and DOIs there are and how many rows repeat one."""
    return keys_and_dois(papers).groupBy("kind").agg(F.count("*").alias("distinct_values"), (F.sum("n") - F.count("*")).alias("duplicates"))


def backfill_candidates(papers: DataFrame, year: int | None = None) -> DataFrame:
    """Rows with a DOI and without an abstract, of one year or of all."""
    out = papers.where(X.has_value(F.col("doi")) & ~X.has_value(F.col("abstract")))
    if year is not None:
        out = out.where(F.col("year") == year)
    return out.select("paper_uid", "dblp_key", "doi", "year", F.lit("").alias("abstract"), F.lit("Unknown").alias("source"), F.lit("Unknown").alias("dblp_source"))


def map_venues(records: DataFrame, venues: DataFrame) -> DataFrame:
    """Records with the source of their exact venue name; those without are dropped. The list is broadcast if Spark finds it small."""
    listed = venues.select(X.collapse(F.col("dblp_source")).alias("_v"), F.col("source").alias("mapped_source"), X.to_flag(F.col("full_paper")).alias("mapped_full_paper"))
    return records.withColumn("_v", X.collapse(F.col("dblp_source"))).join(listed, "_v").drop("_v")


def check_venues(venues: DataFrame) -> DataFrame:
    """The list itself; a venue with two sources ends the query."""
    bad = F.size(F.collect_set("source").over(Window.partitionBy("dblp_source")))
    return venues.withColumn("_n", bad).where(F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("venue with several sources: "), F.col("dblp_source")))).otherwise(F.lit(True)).cast("boolean")).drop("_n")


def without_known_dois(rows: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows whose DOI no existing row has; rows without a DOI stay."""
    known = existing.select(X.doi_key(F.col("doi")).alias("_d")).where("_d <> ''").distinct()
    return rows.withColumn("_d", X.doi_key(F.col("doi"))).join(known, "_d", "left_anti").drop("_d")


def equal_to(rows: DataFrame, column: str, value, most: int, *order: str) -> DataFrame:
    """The first rows whose column has a value, in an order that leaves no ties."""
    return rows.where(F.col(column) == F.lit(value)).orderBy(*order).limit(most)


def of_source(rows: DataFrame, source: str | None = None, most: int | None = None, *order: str) -> DataFrame:
    """Rows of one source (without case), or of all, and at most so many of them in an order."""
    out = rows if source is None else rows.where(X.casefold(X.collapse(F.col("source"))) == X.casefold(F.lit(source)))
    return out if most is None else out.orderBy(*order).limit(most)


def asked_keys(first: DataFrame, second: DataFrame, key: str, position: str) -> DataFrame:
    """(key, position) of two ordered lists one after the other, each key once where it comes first."""
    both = first.select(key, F.lit(0).alias("_list"), position).unionByName(second.select(key, F.lit(1).alias("_list"), position)).where(X.has_value(F.col(key)))
    return both.groupBy(key).agg(F.min(F.struct("_list", position)).alias("_at")).select(key, F.col("_at._list").alias("list"), F.col(f"_at.{position}").alias(position))


def remaining(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among those done, each key once: a job that goes on where it stopped."""
    return rows.join(done.select(key).distinct(), key, "left_anti").dropDuplicates([key])


def requested(keys: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Each requested key with whether it was found."""
    found = rows.select(key).where(F.col(key).isNotNull()).distinct().withColumn("found", F.lit(True))
    return keys.select(key).where(X.has_value(F.col(key))).distinct().join(found, key, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def numbered_slice(rows: DataFrame, ordinal: str, start: int, end: int) -> DataFrame:
    """Rows whose saved ordinal lies in [start, end)."""
    return rows.where((F.col(ordinal) >= start) & (F.col(ordinal) < end))


def skip(rows: DataFrame, *order: str, n: int) -> DataFrame:
    """All but the first ``n`` rows in an order that leaves no ties."""
    return rows.orderBy(*order).offset(n)
