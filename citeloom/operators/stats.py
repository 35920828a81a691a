"""Counts of papers and of their gaps, profiles by source, pivots and shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X


def flags(papers: DataFrame) -> DataFrame:
    """source, dblp_source and year as groups ('Unknown' for blank labels, null for a bad year) with has_doi and has_abstract."""
    return papers.select(
        X.label(F.col("source")).alias("source"), X.label(F.col("dblp_source")).alias("dblp_source"), X.year_or_null(F.col("year")).alias("year"),
        X.has_value(F.col("doi")).alias("has_doi"), X.has_value(F.col("abstract")).alias("has_abstract"),
    )


def _counts() -> list:
    return [
        F.count("*").alias("paper_count"),
        F.count_if(~F.col("has_doi")).alias("missing_doi_count"),
        F.count_if(~F.col("has_abstract")).alias("missing_abstract_count"),
        F.count_if(F.col("has_doi") & F.col("has_abstract")).alias("complete_count"),
    ]


def grouping_sets(papers: DataFrame, collection: str = "papers", generated_at: int = 0) -> DataFrame:
    """Counts by (source, year), (source, dblp_source) and (source) in one pass, with a deterministic key.

    A null year is a group of its own, so the kind of row is told by the grouping id, not by nulls."""
    f = flags(papers)
    grouped = f.groupingSets([[F.col("source"), F.col("year")], [F.col("source"), F.col("dblp_source")], [F.col("source")]], F.col("source"), F.col("dblp_source"), F.col("year"))
    out = grouped.agg((F.grouping("dblp_source") * 2 + F.grouping("year")).alias("g"), *_counts())
    kind = F.when(F.col("g") == 2, "source_year").when(F.col("g") == 1, "source_dblp_completeness").otherwise("source_summary")
    out = out.withColumn("stat_type", kind)
    of = lambda *parts: X.stat_key(F.col("stat_type"), F.lit(collection), *map(F.col, parts))
    key = F.when(F.col("g") == 2, of("source", "year")).when(F.col("g") == 1, of("source", "dblp_source")).otherwise(of("source"))
    return out.select(key.alias("stat_key"), "stat_type", F.lit(collection).alias("source_collection"), "source", "dblp_source", "year", "paper_count", "missing_doi_count", "missing_abstract_count", "complete_count", F.lit(generated_at).cast("bigint").alias("generated_at"))


def in_order(stats: DataFrame) -> DataFrame:
    """Stats rows with their position within their kind: by source without case, then year (unknown last) or venue without case."""
    fold = lambda c: X.casefold(F.col(c))
    w = Window.partitionBy("stat_type").orderBy(fold("source"), "source", F.col("year").asc_nulls_last(), fold("dblp_source").asc_nulls_first(), "dblp_source")
    return stats.withColumn("position", F.row_number().over(w))


#: Orders of the report's tables: largest share first, then largest count, then the name without case.
REPORT_ORDERS = {"doi": ("doi_share", "paper_count"), "complete": ("complete_share", "paper_count"), "papers": ("paper_count",), "name": ()}


def report_in_order(report: DataFrame, order: str) -> DataFrame:
    return report.orderBy(*(F.desc(c) for c in REPORT_ORDERS[order]), X.casefold(F.col("source")), "source")


def summary(papers: DataFrame) -> DataFrame:
    """The report by source as it is exported: counts, percentages, venues with counts, first and last year."""
    r = source_report(papers)
    n, doi, text, both = F.col("paper_count"), F.col("paper_count") - F.col("missing_doi_count"), F.col("paper_count") - F.col("missing_abstract_count"), F.col("complete_count")
    pair = lambda name, c: (c.alias(name), X.percent(c, n).alias(f"{name.removeprefix('with_')}_percent"))
    return r.select(
        "source", n.alias("total"), *pair("with_doi", doi), F.col("missing_doi_count").alias("without_doi"), *pair("with_abstract", text), F.col("missing_abstract_count").alias("without_abstract"), *pair("complete", both),
        (doi - both).alias("with_doi_without_abstract"), X.percent(doi - both, n).alias("with_doi_without_abstract_percent"), F.col("venue_counts").alias("dblp_sources"), F.col("first_year").alias("year_min"), F.col("last_year").alias("year_max"),
    ).select("source", "total", "with_doi", "without_doi", "doi_percent", "with_abstract", "without_abstract", "abstract_percent", "complete", "complete_percent", "with_doi_without_abstract", "with_doi_without_abstract_percent", "dblp_sources", "year_min", "year_max")


def year_profile(papers: DataFrame) -> DataFrame:
    """(source, year_counts): each source's years with their counts, 'Unknown' for a bad year, as 'year:count' in order."""
    counted = papers.groupBy(X.label(F.col("source")).alias("source"), X.year_label(F.col("year").cast("string")).alias("year")).agg(F.count("*").alias("n"))
    return counted.groupBy("source").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("year", "n"))), lambda e: F.concat(e["year"], F.lit(":"), e["n"].cast("string"))), "; ").alias("year_counts"))


def heat_map(papers: DataFrame) -> DataFrame:
    """The matrix of sources and years with the intensity of each cell against the largest."""
    m = year_matrix(papers)
    return m.withColumn("intensity", F.round(X.heat(F.col("paper_count"), F.max("paper_count").over(Window.partitionBy())), 6))


def readiness(papers: DataFrame) -> DataFrame:
    """One row about a batch: total, with_doi, with_abstract, missing_abstract, and how many have a DOI and lack an abstract."""
    doi, text = X.doi_key(F.col("doi")) != "", X.has_value(F.col("abstract"))
    return papers.agg(F.count("*").alias("total"), F.count_if(doi).alias("with_doi"), F.count_if(text).alias("with_abstract"), F.count_if(~text).alias("missing_abstract"), F.count_if(doi & ~text).alias("doi_missing_abstract"))


def one_kind(papers: DataFrame, *keys: str) -> DataFrame:
    return flags(papers).groupBy(*keys).agg(*_counts())


def source_report(papers: DataFrame) -> DataFrame:
    """One row per source: counts, shares, first and last year, number of venues, and the venues with their counts."""
    f = flags(papers)
    by_venue = f.groupBy("source", "dblp_source").agg(
        *_counts(), F.min("year").alias("first"), F.max("year").alias("last")
    )
    out = by_venue.groupBy("source").agg(
        F.sum("paper_count").alias("paper_count"), F.sum("missing_doi_count").alias("missing_doi_count"), F.sum("missing_abstract_count").alias("missing_abstract_count"), F.sum("complete_count").alias("complete_count"),
        F.min("first").alias("first_year"), F.max("last").alias("last_year"), F.count("*").alias("venues"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("paper_count")).alias("n"), X.casefold(F.col("dblp_source")).alias("k"), F.col("dblp_source").alias("v")))), lambda e: F.concat(e["v"], F.lit(":"), (-e["n"]).cast("string"))), "; ").alias("venue_counts"),
    )
    share = lambda c: F.round(X.ratio(F.col("paper_count") - F.col(c), F.col("paper_count")), 6)
    return out.withColumn("doi_share", share("missing_doi_count")).withColumn("abstract_share", share("missing_abstract_count")).withColumn("complete_share", F.round(X.ratio(F.col("complete_count"), F.col("paper_count")), 6))


def totals(papers: DataFrame) -> DataFrame:
    f = flags(papers)
    return f.agg(*_counts(), F.count_distinct("source").alias("sources"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))


def year_matrix(papers: DataFrame) -> DataFrame:
    """Counts of every source in every year that occurs, zero where there are none."""
    counted = flags(papers).where("year is not null").groupBy("source", "year").agg(*_counts())
    # one row with the years that occur; years are few whatever the number of papers
    years = counted.agg(F.sort_array(F.collect_set("year")).alias("years"))
    grid = counted.select("source").distinct().join(F.broadcast(years)).select("source", F.explode("years").alias("year"))
    incomplete = F.col("paper_count") - F.col("complete_count")
    out = grid.join(counted, ["source", "year"], "left").na.fill(0)
    return out.select("source", "year", "paper_count", F.round(X.ratio(incomplete, F.col("paper_count")), 6).alias("incomplete_ratio"))


def year_pivot(papers: DataFrame, years: list[int] | None = None) -> DataFrame:
    """The matrix with a column for each of the given years, or for each year that occurs (they are few)."""
    if years is None:
        years = [r[0] for r in flags(papers).where("year is not null").select("year").distinct().orderBy("year").collect()]
    return flags(papers).groupBy("source").pivot("year", years).count().na.fill(0)


def quality(papers: DataFrame) -> DataFrame:
    """Gaps by source; papers that lack both fields follow from the other counts."""
    s = one_kind(papers, "source")
    any_gap = F.col("paper_count") - F.col("complete_count")
    both = F.greatest(F.lit(0), F.col("missing_doi_count") + F.col("missing_abstract_count") - any_gap)
    return s.select("source", "paper_count", any_gap.alias("missing_any"), both.alias("missing_both"), F.round(X.ratio(any_gap, F.col("paper_count")), 6).alias("missing_ratio"))


def composition(papers: DataFrame) -> DataFrame:
    """Each source's parts (by venue, largest first) with the running offset at which each begins."""
    parts = flags(papers).groupBy("source", "dblp_source").agg(F.count("*").alias("paper_count"))
    w = Window.partitionBy("source").orderBy(F.desc("paper_count"), "dblp_source")
    return parts.select("source", "dblp_source", "paper_count", F.coalesce(F.sum("paper_count").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"))


def source_examples(papers: DataFrame, order: str, most: int = 3) -> DataFrame:
    """Count and the first few distinct DOIs of each raw source, in order of arrival, without collecting a source's rows."""
    seen = papers.select(X.label(F.col("source")).alias("source"), X.strip_doi(F.col("doi")).alias("doi"), F.col(order).alias("at"))
    counts = seen.groupBy("source").agg(F.count("*").alias("papers"), F.count_if(F.col("doi") != "").alias("with_doi"))
    firsts = seen.where("doi <> ''").groupBy("source", "doi").agg(F.min("at").alias("at"))
    ranked = firsts.withColumn("rank", F.row_number().over(Window.partitionBy("source").orderBy("at"))).where(F.col("rank") <= most)
    examples = ranked.groupBy("source").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "doi"))), lambda e: e["doi"]), " ").alias("examples"))
    return counts.join(examples, "source", "left").withColumn("examples", F.coalesce("examples", F.lit("")))


def frequency(papers: DataFrame, column: str) -> DataFrame:
    """Counts of a column's labels with their share of all rows."""
    counted = papers.groupBy(X.label(F.col(column)).alias("value")).agg(F.count("*").alias("n"))
    return counted.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


def venue_growth(old: DataFrame, new: DataFrame, venues: DataFrame) -> DataFrame:
    """Counts of each listed source in the old and the new collection beside how many of its venues are full-paper ones."""
    count = lambda df, name: df.groupBy(X.label(F.col("source")).alias("source")).agg(F.count("*").alias(name))
    listed = venues.groupBy("source").agg(F.count("*").alias("venues"), F.count_if(X.to_flag(F.col("full_paper"))).alias("full_venues"))
    return listed.join(count(old, "old_papers"), "source", "left").join(count(new, "new_papers"), "source", "left").na.fill(0, ["old_papers", "new_papers"])


def names_in_order(rows: DataFrame, column: str) -> DataFrame:
    """The different values of a column with their place in the order of the language, case and accents coming last."""
    named = rows.select(F.col(column)).where(F.col(column).isNotNull()).distinct()
    return named.withColumn("position", F.row_number().over(Window.orderBy(F.collate(F.col(column), "UNICODE_CI"), F.col(column))))
