"""Problem 3: the best value of each field among the records of one paper.

One aggregation over the groups of problem 2: for each field the maximum of a composite struct whose entries say whether the value can
be used at all, how far its source is trusted, what makes it better (length, date, number), the negated row id for ties, and the value.
Rows of a hot group are combined before the shuffle. ``survivors`` names the rows that hold the values, ``surviving_records`` builds the
record of the values themselves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import dedupe

# Keywords and counts that stand for nothing.
FILLER_KEYWORDS = ["", "-", "--", "n/a", "na", "none", "null", "nil", "keyword", "keywords", "no keywords", "unknown", "tbd", "?", "."]
FILLER_COUNTS = [99999999, 2147483647, 999999999, 9999999, 999999, 9223372036854775807, 4294967295]
#: Stand-in notices: a first sentence that says within its first words that the abstract is missing, or nothing but "n/a".
NOTICE = r"(?i)^\W*(?:[^\s.!?。]+\s+){0,12}?(?:(?:no|without(?: an)?|not|missing|see full text for|unavailable)\b[^.!?。]{0,25}\babstract|abstract\b[^.!?。]{0,25}\b(?:not|un)\s?(?:available|provided|supplied))|^\W*n/?a\W*$"
#: Words that a complete abstract has at least.
LEAST_WORDS = 5


#: Marks that may stand behind the end of a sentence.
CLOSERS = "\"'”’)]"
#: What is left out as one tag has at most so many characters.
TAG = 64


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often ``then`` names it."""
    return F.get(F.transform(F.array(value), then), 0)


def _bare(c: Column) -> Column:
    """Letters and digits only, without case and markup."""
    low = F.when(c.contains("<") | c.contains("&"), F.regexp_replace(F.lower(c), r"</?[a-z][^<>]{0,60}>|&amp;", "")).otherwise(F.lower(c))
    return F.regexp_replace(low, r"[^\p{L}\p{N}]+", "")


def _is_copy(text: Column, title: Column, authors: Column, keywords: Column) -> Column:
    none = F.array().cast("array<string>")
    listed = lambda c: F.concat_ws("", F.coalesce(c, none))

    def of(other: Column) -> Column:
        most = F.greatest(F.length(other["title"]) + 25, F.length(other["authors"]), F.length(other["keywords"]))
        # a text is longer than all it could copy if its beginning is, even with a tag across the end of it; else it is read as a whole
        longer = _let(most, lambda n: F.length(_bare(text.substr(F.lit(1), (n + TAG) * 2))) - TAG > n)
        # within 25 edits of the title: a title with other markup, typing errors or without its small words
        same = lambda t: (F.levenshtein(t, _bare(other["title"]), 25) >= 0) | (t == _bare(other["authors"])) | (t == _bare(other["keywords"]))
        return ~longer & _let(_bare(text), same)

    return _let(F.struct(F.coalesce(title, F.lit("")).alias("title"), listed(authors).alias("authors"), listed(keywords).alias("keywords")), of)


def abstract_is_complete(abstract: Column, title: Column, authors: Column, keywords: Column) -> Column:
    """A text that ends like a sentence, is not cut off, no stand-in and no copy of another field of its row, whatever its length."""

    def of(text: Column) -> Column:
        ends = _let(F.rtrim(text, F.lit(CLOSERS)), lambda t: F.right(t, F.lit(1)).isin(*".!?。") & ~t.endswith(".."))
        words = text.rlike(r"\S+(\s+\S+){%d}" % (LEAST_WORDS - 1))
        # no notice lacks both of these, which are found sooner
        notice = (F.lower(text).contains("abstract") | text.rlike(r"(?i)^\W*n/?a\W*$")) & text.rlike(NOTICE)
        return F.when(ends & words & ~notice, ~_is_copy(text, title, authors, keywords))

    return F.coalesce(_let(F.trim(F.translate(abstract, "\t\r\n\u00a0", "    ")), of), F.lit(False))


def count_is_real(count: Column) -> Column:
    return F.coalesce((count >= 0) & ~count.isin(FILLER_COUNTS), F.lit(False))


def keyword_number(keywords: Column) -> Column:
    """How many different keywords there are, trimmed and without case, blanks and filler."""
    clean = F.transform(F.coalesce(keywords, F.array().cast("array<string>")), lambda k: F.lower(F.regexp_replace(F.coalesce(k, F.lit("")), r"(?U)^\s+|\s+$", "")))
    return F.size(F.array_distinct(F.filter(clean, lambda k: ~k.isin(FILLER_KEYWORDS))))


def marks(papers: DataFrame, id_column: str = "row_id", trust: DataFrame | None = None, values: bool = False) -> DataFrame:
    """(row_id, abstract, citation, keywords): for each row and field the struct by which records compete: ok, priority, better, id and,
    with ``values``, value. ``trust``: (source, priority), a larger number being trusted more; a source that is not named has 0."""
    c = F.col
    rows = papers.select(c(id_column).alias("row_id"), "title", "authors", "abstract", "keywords", "citation_count", "updated_at", keyword_number(c("keywords")).alias("_n"), *(["source"] if trust is not None else []))
    if trust is not None:
        rows = rows.join(trust.groupBy("source").agg(F.max("priority").alias("_trust")), "source", "left").withColumn("_trust", F.coalesce("_trust", F.lit(0)).cast("int"))
    else:
        rows = rows.withColumn("_trust", F.lit(0))
    length = F.length(F.regexp_replace(F.trim(F.coalesce(c("abstract"), F.lit(""))), r"\s{2,}", " "))
    date = F.coalesce(c("updated_at"), F.lit("0001-01-01").cast(papers.schema["updated_at"].dataType))

    def mark(ok: Column, better: Column, value: str) -> Column:
        return F.struct(ok.alias("ok"), c("_trust").alias("priority"), better.alias("better"), (-c("row_id")).alias("id"), *([F.when(ok, c(value)).alias("value")] if values else []))

    complete = abstract_is_complete(c("abstract"), c("title"), c("authors"), c("keywords"))
    return rows.select("row_id", mark(complete, length, "abstract").alias("abstract"), mark(count_is_real(c("citation_count")), date, "citation_count").alias("citation"), mark(c("_n") > 0, c("_n"), "keywords").alias("keywords"))


_FIELDS = ("abstract", "citation", "keywords")


def best_rows(marked: DataFrame, group: str) -> DataFrame:
    """(group, abstract_row_id, citation_row_id, keywords_row_id), one row per group, of rows that have ``marks`` and a group.

    Of usable values those of the most trusted source count. Abstract: the longest complete one. Count: the real one with the latest
    ``updated_at`` (a null date is the earliest). Keywords: the most different ones. Ties: the smallest id; no usable value: 0."""
    best = marked.groupBy(group).agg(*(F.max(c).alias(c) for c in _FIELDS))
    return best.select(group, *(F.when(F.col(f"{c}.ok"), -F.col(f"{c}.id")).otherwise(0).cast("bigint").alias(f"{c}_row_id") for c in _FIELDS))


def survivors(papers: DataFrame, id_column: str = "row_id", trust: DataFrame | None = None) -> DataFrame:
    """p3: (first_row_id, abstract_row_id, citation_row_id, keywords_row_id) of every paper with two or more rows."""
    groups = dedupe.paper_groups(papers, id_column)
    return best_rows(marks(papers, id_column, trust).join(groups, "row_id"), "first_row_id")


def surviving_records(papers: DataFrame, id_column: str = "row_id", trust: DataFrame | None = None) -> DataFrame:
    """(first_row_id, abstract, citation_count, keywords): the record built of the best values of every paper with two or more rows,
    by the same aggregation with the values in its structs; null where no row has a usable one."""
    groups = dedupe.paper_groups(papers, id_column)
    best = marks(papers, id_column, trust, True).join(groups, "row_id").groupBy("first_row_id").agg(*(F.max(c).alias(c) for c in _FIELDS))
    return best.select("first_row_id", F.col("abstract.value").alias("abstract"), F.col("citation.value").alias("citation_count"), F.col("keywords.value").alias("keywords"))
