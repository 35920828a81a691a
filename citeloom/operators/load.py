"""Records made ready for loading: full coercion, partial updates, and the options of an upload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

#: Columns that exports of metadata leave out.
HEAVY = ("embedding", "umap", "search_text", "search_sparse")


def first_present(rows: DataFrame, *names: str) -> Column:
    """The first of the columns that the table has, even where it is null; null if it has none of them."""
    return next((F.col(f"`{n}`") for n in names if n in rows.columns), F.lit(None))


def picked(rows: DataFrame, *names: str) -> Column:
    """The first value that is not null of the columns that the table has (names that differ in case are different columns)."""
    there = [F.col(f"`{n}`") for n in names if n in rows.columns]
    return F.coalesce(*there) if there else F.lit(None)


def loaded_uid(rows: DataFrame) -> Column:
    """The uid a record has, else one built from its fields; at most 1,024 signs."""
    built = X.paper_uid(F.col("doi"), F.col("dblp_key"), F.col("title"), F.col("authors"), F.col("year").cast("string"), F.col("dblp_source"))
    own = X.collapse(F.col("paper_uid")) if "paper_uid" in rows.columns else F.lit("")
    return F.when(own != "", F.substring(own, 1, 1024)).otherwise(F.substring(built, 1, 1024))


def to_entity(rows: DataFrame) -> DataFrame:
    """Records with every column of the staging collection, trimmed, cut and typed; ``citation_count`` and ``full_paper`` may come
    from the columns of older files."""
    c = F.col
    none = lambda a: F.when(F.size(a) > 0, a)
    doi, abstract = X.clip(c("doi"), 512, True), X.clip(c("abstract"), 65535, True)
    authors = X.clean_list(c("authors"))
    return rows.select(
        loaded_uid(rows).alias("paper_uid"), X.clip(c("dblp_key"), 1024, True).alias("dblp_key"), doi.alias("doi"), F.lit(None).cast("array<float>").alias("embedding"), F.lit(None).cast("string").alias("umap"),
        X.search_text(c("title"), c("abstract"), c("keywords"), c("authors")).alias("search_text"), X.clip(c("title"), 4096).alias("title"), abstract.alias("abstract"), authors.alias("authors"), X.author_names(authors).alias("authors_normalised"),
        none(X.clean_list(c("keywords"))).alias("keywords"), X.clip(c("source"), 1024).alias("source"), X.clip(c("dblp_source"), 1024).alias("dblp_source"), X.to_int(c("year")).alias("year"),
        X.to_int(first_present(rows, "citation_count", "citationCounts"), True).alias("citation_count"), X.to_flag(first_present(rows, "full_paper", "Full paper")).alias("full_paper"), doi.isNotNull().alias("has_doi"), abstract.isNotNull().alias("has_abstract"),
    )


def to_update(rows: DataFrame) -> DataFrame:
    """Partial updates of records with an abstract: keywords and count are null where they are to stay as they are."""
    doi, abstract = X.strip_doi(F.col("doi")), X.collapse(F.col("abstract"))
    out = rows.select(
        X.collapse(F.col("paper_uid")).alias("paper_uid"), F.nullif(doi, F.lit("")).alias("doi"), F.nullif(abstract, F.lit("")).alias("abstract"), X.search_text(F.col("title"), F.col("abstract"), F.col("keywords"), F.col("authors")).alias("search_text"),
        (doi != "").alias("has_doi"), (abstract != "").alias("has_abstract"), F.when(F.size("keywords") > 0, F.col("keywords")).alias("keywords"), "citation_count",
    )
    return out.where("has_abstract")


def to_load(rows: DataFrame, order: tuple[str, ...], there: DataFrame | None = None, skip: int = 0, skip_missing_doi: bool = False, resume: bool = False, allow_non_empty: bool = False) -> DataFrame:
    """The records that an upload adds to a table with the uids of ``there``: all but the first ``skip`` by ``order``, without those
    that lack a DOI if so asked, and without known uids. ``resume`` goes on after as many records as the table has; a table that is
    not empty is refused unless that is allowed."""
    have = 0 if there is None else there.count()
    if resume:
        if skip not in (0, have):
            raise ValueError(f"the table has {have} records, but {skip} are to be skipped")
        skip = have
    elif have and not allow_non_empty:
        raise ValueError(f"the table has {have} records already")
    ready = to_entity(rows.orderBy(*order).offset(skip) if skip else rows)
    if skip_missing_doi:
        ready = ready.where("has_doi")
    return ready if there is None else ready.join(there.select("paper_uid").distinct(), "paper_uid", "left_anti")


def clean_flags(rows: DataFrame) -> DataFrame:
    """Exported rows with a whole year and flags; where the table has no flag column, a DOI that is there counts, an abstract does not."""
    doi = X.to_flag(F.col("has_doi")) if "has_doi" in rows.columns else X.has_value(F.col("doi"))
    text = X.to_flag(F.col("has_abstract")) if "has_abstract" in rows.columns else F.lit(False)
    return rows.withColumn("year", X.year_or_null(F.col("year"))).withColumn("has_doi", doi).withColumn("has_abstract", text)


def metadata(rows: DataFrame, heavy: tuple[str, ...] = HEAVY) -> DataFrame:
    """All columns but the heavy ones."""
    return rows.drop(*heavy)


def without_coordinates(rows: DataFrame, column: str = "umap") -> DataFrame:
    """Rows whose coordinates are missing: null, or a struct without x."""
    return rows.where(F.col(column).isNull() | F.col(f"{column}.x").isNull())


def from_older(rows: DataFrame) -> DataFrame:
    """Records of older files, whose columns are written in two ways, in the columns and bounds of the previous collection."""
    p = lambda *n: picked(rows, *n)
    year = X.to_int(p("Year", "year").cast("string"))
    return rows.select(
        X.clip(p("ID", "id"), 512).alias("id"), X.clip(p("Title", "title"), 4096).alias("title"), X.clip(p("Abstract", "abstract"), 65535).alias("abstract"), X.clean_list(p("Authors", "authors")).alias("authors"), X.clean_list(p("Keywords", "keywords")).alias("keywords"),
        X.clip(p("Source", "source"), 1024).alias("source"), year.alias("year"), p("CitationCount", "citation_count").try_cast("double").alias("citation_count"), X.clip(p("Lang", "lang"), 64).alias("lang"),
    )


def long_abstracts(rows: DataFrame, least: int = 50, most: int = 1000, order: tuple[str, ...] = ("id",)) -> DataFrame:
    """The first records with an abstract longer than so many signs."""
    return rows.where(F.length("abstract") > least).orderBy(*order).limit(most)


def saved_coordinates(saved: DataFrame, rows: DataFrame, start: int, end: int, uid: str = "paper_uid") -> DataFrame:
    """Saved coordinates (ordinal, uid, x, y) of ordinals in [start, end) joined to the rows that still are there."""
    return saved.where((F.col("ordinal") >= start) & (F.col("ordinal") < end)).join(rows, uid)
