"""Comparison of two states of a collection, and promotion of what changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

EMBED_FIELDS = ("title", "abstract")
COMPARED = ("dblp_key", "doi", "title", "abstract", "authors", "keywords", "source", "dblp_source", "year", "citation_count", "full_paper")


def classify(new: DataFrame, old: DataFrame, model: str, embed_fields=EMBED_FIELDS, compared=COMPARED, uid: str = "paper_uid") -> DataFrame:
    """(uid, change): new, embed_input_change, metadata_only_change or unchanged, for each row of ``new`` with a uid.

    The input of an embedding is compared without case and outer blanks, everything else as it is (for lists null and empty are
    the same); a row whose embedding is missing or of another model counts as changed input."""
    kinds = dict(new.dtypes)
    right = old.select(F.col(uid), F.lit(True).alias("_there"), *(F.col(c).alias(f"_{c}") for c in sorted({*embed_fields, *compared})), F.col("embedding_model").alias("_model"), F.col("has_embedding").alias("_has"))
    both = new.where(X.has_value(F.col(uid))).join(right, uid, "left")
    same_input = F.lit(True)
    for c in embed_fields:
        same_input &= X.embed_field(F.col(c)) == X.embed_field(F.col(f"_{c}"))
    same_input &= (X.embed_field(F.col("_model")) == X.embed_field(F.lit(model))) & F.col("_has").eqNullSafe(F.lit(True))
    same_rest = F.lit(True)
    for c in compared:
        same_rest &= X.same_value(F.col(c), F.col(f"_{c}"), kinds[c])
    change = F.when(F.col("_there").isNull(), "new").when(~same_input, "embed_input_change").when(same_rest, "unchanged").otherwise("metadata_only_change")
    return both.select(uid, change.alias("change"))


def counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("change").agg(F.count("*").alias("papers"))


def to_embed(rows: DataFrame, fields=EMBED_FIELDS, uid: str = "paper_uid") -> DataFrame:
    """(uid, text) of rows that lack an embedding and have all fields an embedding needs. A null flag counts as lacking."""
    ready = F.lit(True)
    for f in fields:
        ready &= X.has_value(F.col(f))
    return rows.where(ready & ~F.col("has_embedding").eqNullSafe(F.lit(True))).select(uid, X.embed_text(*(F.col(f) for f in fields)).alias("text"))


def vector_report(rows: DataFrame, dim: int, vector: str = "embedding") -> DataFrame:
    """Counts of rows by the state of their vector: missing, empty, wrong_size, not_finite, zero or sound, and by the flag."""
    v = F.col(vector)
    state = (
        F.when(v.isNull(), "missing").when(F.size(v) == 0, "empty").when(F.size(v) != dim, "wrong_size")
        .when(F.exists(v, lambda x: x.isNull() | F.isnan(x)), "not_finite").when(~F.exists(v, lambda x: x != 0), "zero").otherwise("sound")
    )
    return rows.groupBy("embedding_model", state.alias("state"), "has_embedding").agg(F.count("*").alias("papers"))


def checked_vectors(rows: DataFrame, dim: int, vector: str = "embedding") -> DataFrame:
    """Rows that have a vector; one of another size, or with a number that is not finite, ends the query. Nulls and empty ones are
    passed over."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    checked = F.when(F.size(v) != dim, F.raise_error(F.format_string("a vector of %d numbers", F.size(v)))).when(bad, F.raise_error(F.lit("a vector with a number that is not finite")))
    return rows.where(v.isNotNull() & (F.size(v) > 0)).where(F.coalesce(checked.cast("boolean"), F.lit(True)))
