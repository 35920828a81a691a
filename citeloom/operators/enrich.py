"""Look-up caches merged into records, with the precedence of each kind of source, and the state of a record afterwards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.udfs import piece_keys, sequence_ratio, window_keys

TERMINAL = ("found", "not_found")


def valid_cache(cache: DataFrame, version: int, key: str = "doi", order: str | None = None) -> DataFrame:
    """Entries of the current schema version with a terminal status; of several for one key the last by ``order``, else the largest."""
    good = cache.where((F.col("cache_schema_version") == version) & F.col("status").isin(*TERMINAL))
    others = [c for c in cache.columns if c not in (key, order)]
    row = F.struct(*([order] if order else []), *others)
    return good.groupBy(key).agg(F.max(row).alias("_row")).select(*(F.col(c) if c == key else F.col(f"_row.`{c}`").alias(c) for c in cache.columns))


def _list(now: Column, found: Column) -> Column:
    return F.when(F.size(F.coalesce(found, F.array().cast("array<string>"))) > 0, found).otherwise(now)


def by_doi(records: DataFrame, cache: DataFrame, rule: str) -> DataFrame:
    """Records with abstract, keywords and citation_count merged from a cache (doi, abstract, keywords, citation_count).

    Rules: ``overwrite`` takes the cache's abstract even if it is empty, its keywords if there are any and its count if there is
    one; ``prefer`` takes an abstract that is not empty and fills other gaps; ``fill`` only fills gaps. Blanks within an abstract that
    is taken are collapsed; unknown DOIs change nothing."""
    right = cache.select(X.doi_key(F.col("doi")).alias("_k"), F.lit(True).alias("_there"), X.collapse(F.col("abstract")).alias("_abstract"), F.col("keywords").alias("_keywords"), F.col("citation_count").alias("_count")).where("_k <> ''")
    out = records.withColumn("_k", X.doi_key(F.col("doi"))).join(right, "_k", "left")
    there = F.coalesce("_there", F.lit(False))
    if rule == "overwrite":
        abstract = F.when(there, F.col("_abstract")).otherwise(F.col("abstract"))
        keywords, count = _list(F.col("keywords"), F.col("_keywords")), F.coalesce("_count", "citation_count")
    elif rule in ("prefer", "fill"):
        found = F.coalesce(F.col("_abstract"), F.lit("")) != ""
        abstract = F.when(found if rule == "prefer" else found & ~X.has_value(F.col("abstract")), F.col("_abstract")).otherwise(F.col("abstract"))
        keywords, count = _list(F.col("_keywords"), F.col("keywords")), F.coalesce("citation_count", "_count")
    else:
        raise ValueError(rule)
    return out.withColumn("abstract", abstract).withColumn("keywords", keywords).withColumn("citation_count", count).drop("_k", "_there", "_abstract", "_keywords", "_count")


def apply_found(records: DataFrame) -> DataFrame:
    """Records with a struct ``found`` (doi, abstract, keywords, citation_count; null for none) merged into their gaps: a DOI that was
    missing is taken and renames the record, a blank abstract, an empty keyword list and a missing count are filled."""
    f = lambda c: F.col(f"found.{c}")
    doi = X.strip_doi(f("doi"))
    new = (doi != "") & (X.strip_doi(F.col("doi")) == "")
    none = F.array().cast("array<string>")
    out = records.withColumn("paper_uid", F.when(new, F.concat(F.lit("doi:"), X.casefold(doi))).otherwise(F.col("paper_uid")))
    out = out.withColumn("abstract", F.when((X.collapse(f("abstract")) != "") & (X.collapse(F.col("abstract")) == ""), X.collapse(f("abstract"))).otherwise(F.col("abstract")))
    out = out.withColumn("keywords", F.when((F.size(F.coalesce(f("keywords"), none)) > 0) & (F.size(F.coalesce("keywords", none)) == 0), f("keywords")).otherwise(F.col("keywords")))
    return out.withColumn("citation_count", F.coalesce("citation_count", f("citation_count"))).withColumn("doi", F.when(new, doi).otherwise(F.col("doi"))).drop("found")


def by_title(records: DataFrame, cache: DataFrame) -> DataFrame:
    """Records joined to a cache of title searches (key, found) on the key of title, year and source, and merged (``apply_found``)."""
    keyed = records.withColumn("key", X.search_key(F.col("title"), F.col("year"), F.col("source")))
    return apply_found(keyed.join(cache.select("key", "found"), "key", "left").drop("key"))


def state(records: DataFrame) -> DataFrame:
    """Records with their state: missing_doi, enriched (DOI and abstract) or missing_abstract."""
    return records.withColumn("state", F.when(~X.has_value(F.col("doi")), "missing_doi").when(X.has_value(F.col("abstract")), "enriched").otherwise("missing_abstract"))


def accept_match(title: Column, overlap: Column, apart: Column, generic: Column) -> Column:
    """Why a candidate is accepted as the same paper, or why not."""
    near = F.coalesce(apart <= 1, F.lit(False))
    return (
        F.when(generic & (overlap <= 0), "generic_title").when((title >= 0.985) & (near | (overlap > 0)), "near_exact_title")
        .when((title >= 0.94) & near & (overlap >= 0.25), "title_year_author").when((title >= 0.90) & near & (overlap >= 0.5), "strong_author_overlap").otherwise("below_threshold")
    )


def best_matches(papers: DataFrame, others: DataFrame, uid: str = "paper_uid", other: str = "id") -> DataFrame:
    """(uid, other, title_similarity, overlap, reason): the best accepted candidate of each paper, or reason 'ambiguous'.

    All pairs with years at most one apart or unknown are decided by ``accept_match`` on titles compared by matching blocks and
    authors by shared names; the best by title and overlap (both with four digits) and year distance is ambiguous if the runner-up is within 0.02 and 0.25
    of it. Only pairs that the rule cannot accept are left out before: an accepted pair shares a name or, with both years known,
    a piece of a title of at least 0.985."""

    def normal(df: DataFrame, key: str) -> DataFrame:
        year = F.nullif(X.year_or_null(F.col("year")), F.lit(0))
        return df.select(key, X.match_title(F.col("title")).alias("t"), "authors", year.alias("y"), X.is_generic_title(F.col("title")).alias("g"), F.xxhash64(key).alias("h")).where("t <> ''")

    def keyed(df: DataFrame, one: bool) -> DataFrame:
        names = F.array_distinct(F.filter(F.transform(F.coalesce("authors", F.array().cast("array<string>")), X.match_author), lambda x: x != ""))
        # years in pairs: a paper is in one of them, a candidate in those of the year before and the year after
        spans = F.array(F.floor(F.col("y") / 2)) if one else F.array_distinct(F.array(F.floor((F.col("y") - 1) / 2), F.floor((F.col("y") + 1) / 2)))
        spans = F.when(F.col("y").isNotNull(), spans).otherwise(F.array().cast("array<bigint>"))
        always, unknown = ("b", "a") if one else ("a", "b")
        spans_of_names = F.array_union(F.transform(spans, lambda x: x.cast("string")), F.when(F.col("y").isNull(), F.array(F.lit(always), F.lit(unknown))).otherwise(F.array(F.lit(always))))
        by_name = F.flatten(F.transform(names, lambda x: F.transform(spans_of_names, lambda s: F.xxhash64(x, s))))
        held = df.select("h", F.length("t").alias("n"), "y", by_name.alias("by_name"), spans.alias("spans"), (window_keys if one else piece_keys)("t").alias("pieces"))
        by_title = F.flatten(F.transform("pieces", lambda x: F.transform("spans", lambda s: F.xxhash64(x, s))))
        return held.select("h", "n", "y", F.explode(F.concat("by_name", by_title)).alias("key"))

    a, b = normal(papers, uid), normal(others, other)
    b = b.select(other, F.col("t").alias("t2"), F.col("authors").alias("a2"), F.col("y").alias("y2"), F.col("h").alias("h2"))
    left = keyed(a, True)
    right = keyed(b.select(F.col("t2").alias("t"), F.col("a2").alias("authors"), F.col("y2").alias("y"), F.col("h2").alias("h")), False).toDF("h2", "n2", "y2", "key")
    near = left.join(right, "key").where("y is null or y2 is null or abs(y - y2) <= 1").where("abs(n - n2) <= if(y is not null and y2 is not null, 0.1, 0.015) * (n + n2) + 0.000001").select("h", "h2").distinct()
    pairs = near.join(a.withColumnsRenamed({"authors": "a1", "y": "y1"}), "h").join(b, "h2").where("y1 is null or y2 is null or abs(y1 - y2) <= 1")
    pairs = pairs.withColumn("overlap", X.author_overlap(F.col("a1"), F.col("a2"))).withColumn("apart", F.abs(F.col("y1") - F.col("y2")))
    # a title_similarity of s leaves at most (1 - s) of all signs unmatched, and so no more to edit
    known = F.col("apart").isNotNull()
    room = F.when(known & (F.col("overlap") >= 0.5), 0.10).when(known & (F.col("overlap") >= 0.25), 0.06).when(known | (F.col("overlap") > 0), 0.015).otherwise(-1.0)
    pairs = pairs.where(F.levenshtein("t", "t2") <= room * (F.length("t") + F.length("t2")) + 0.000001)
    scored = pairs.withColumn("title_similarity", sequence_ratio("t", "t2"))
    scored = scored.withColumn("reason", accept_match(F.col("title_similarity"), F.col("overlap"), F.col("apart"), F.col("g"))).where(~F.col("reason").isin("below_threshold", "generic_title"))
    # the two best of each paper in one pass over the scored pairs
    order = F.struct(F.round("title_similarity", 4).alias("s"), F.round("overlap", 4).alias("o"), (-F.coalesce("apart", F.lit(99))).alias("d"), F.col(other).alias("i"), F.col("reason").alias("r"))
    ranked = scored.select(uid, order.alias("_o")).withColumn("_n", F.row_number().over(Window.partitionBy(uid).orderBy(F.desc("_o")))).where("_n <= 2")
    both = ranked.groupBy(uid).agg(F.max(F.when(F.col("_n") == 1, F.col("_o"))).alias("one"), F.max(F.when(F.col("_n") == 2, F.col("_o"))).alias("two"))
    close = F.coalesce((F.col("one.s") - F.col("two.s") < 0.02) & (F.col("one.o") - F.col("two.o") < 0.25), F.lit(False))
    return both.select(uid, F.col("one.i").alias(other), F.round("one.s", 4).alias("title_similarity"), F.round("one.o", 4).alias("overlap"), F.when(close, "ambiguous").otherwise(F.col("one.r")).alias("reason"))


def similar_titles(a: DataFrame, b: DataFrame, key: str, other: str, least: float) -> DataFrame:
    """(key, other, similarity) of all pairs of rows of one year whose titles have a Jaccard similarity of at least ``least``; exact.

    The words of a title are ordered by how rare they are. Two titles so similar share one of the first n - ceil(least * n) + 1 words of
    either, so only these are joined, and only titles of like length are compared. Equal titles are compared once."""

    def titled(df: DataFrame, id_column: str) -> DataFrame:
        return df.select(id_column, F.array_sort(F.array_distinct(X.tokens(F.col("title")))).alias("t"), "year").where("size(t) > 0")

    one, two = titled(a, key), titled(b, other)
    texts = one.select("t", "year").unionAll(two.select("t", "year"))
    often = texts.select(F.explode("t").alias("w")).groupBy("w").agg(F.count("*").alias("n"))

    def prefixes(df: DataFrame) -> DataFrame:
        words = df.select("t", "year").distinct().select("t", "year", F.explode("t").alias("w")).join(often, "w")
        place = F.row_number().over(Window.partitionBy("t", "year").orderBy("n", "w"))
        return words.withColumn("_p", place).where(F.col("_p") <= F.size("t") - F.ceil(F.size("t") * F.lit(least) - 1e-9) + 1).select("t", "year", "w")

    left, right = prefixes(one), prefixes(two).withColumnRenamed("t", "u")
    x, y = F.size("t"), F.size("u")
    pairs = left.join(right, ["year", "w"]).where((x >= y * least - 1e-9) & (y >= x * least - 1e-9)).select("t", "u", "year").distinct()
    both = F.size(F.array_intersect("t", "u"))
    close = pairs.withColumn("_s", both / (x + y - both)).where(F.col("_s") >= least - 1e-9)
    found = one.join(close, ["t", "year"]).join(two.withColumnRenamed("t", "u"), ["u", "year"])
    return found.select(key, other, F.round("_s", 4).alias("similarity")).distinct()
