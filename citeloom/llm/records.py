"""Normal forms of bibliographic records, shared by matching and deduplication."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import fingerprints as fp
from . import text

#: Limits of a believable year; others count as unknown.
YEARS = (1900, 2100)
#: Records whose known years lie further apart are never one paper.
YEARS_APART = 2
SHORT_TITLE = 4  # content words; shorter titles ("Foreword") say little
_DOI = re.compile(r"10\.\d{4,9}/[^\s?#]+")
_REC = re.compile(r"^(?:https?://[^/]+/(?:rec/)?|dblp:)")


def doi_key(doi: str | None) -> str:
    """A DOI without prefix, case, blanks and trailing punctuation; empty if there is none."""
    if not doi:
        return ""
    hit = _DOI.search(doi.lower().replace("%2f", "/").replace(" ", "").replace("․", "."))
    return hit.group(0).rstrip(".,;)]}") if hit else ""


def bibliographic_key(key: str | None) -> str:
    """A bibliography key without address, scheme, suffix and case; empty if there is none."""
    if not key:
        return ""
    out = _REC.sub("", key.strip().lower())
    out = out.removesuffix(".html").replace("conference/", "conf/", 1)
    return re.sub(r"^journal/", "journals/", out)


_FIELDS = T.StructType(
    [
        T.StructField("cid", T.LongType()),
        T.StructField("check", T.LongType()),
        T.StructField("fp", T.LongType()),
        T.StructField("title_key", T.StringType()),
        T.StructField("names", T.StringType()),
        T.StructField("year", T.ShortType()),
        T.StructField("doi_key", T.LongType()),
        T.StructField("dblp_key", T.LongType()),
    ]
)


def _schema(id_type: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("id", id_type), *_FIELDS.fields])


def _normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        col = {n: batch.column(n).to_pylist() for n in batch.schema.names}
        titles = [" ".join(text.title_tokens(t)) for t in col["title"]]
        names = [" ".join(text.surnames(a)) for a in col["authors"]]
        years = [y if y is not None and YEARS[0] <= y <= YEARS[1] else 0 for y in col["year"]]
        whole = [f"{t}|{n}|{y}" for t, n, y in zip(titles, names, years)]
        hashes = (*(fp.hash_strings(whole, seed) for seed in (0, 1)), fp.fingerprint(titles, 64))
        keys = []
        for name, of in (("doi", doi_key), ("dblp_key", bibliographic_key)):
            got = [of(x) for x in col[name]] if name in col else [""] * len(titles)
            keys.append(pa.array([None if not x else h for x, h in zip(got, fp.hash_strings(got).view(np.int64).tolist())], pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), *(pa.array(h.view(np.int64)) for h in hashes), pa.array(titles), pa.array(names), pa.array(years, pa.int16()), *keys],
            names=["id", *(f.name for f in _FIELDS)],
        )


def normal_records(df: DataFrame, id_column: str, title: str = "title", authors: str = "authors", year: str = "year", doi: str | None = None, dblp_key: str | None = None) -> DataFrame:
    """One row (id, cid, check, fp, title_key, names, year, doi_key, dblp_key) per row of ``df``: its id and the normal forms of its
    fields.

    ``cid`` and ``check`` are two hashes of title, family names and year together, ``fp`` the fingerprint of the title. Null or empty fields give empty normal forms, an
    unbelievable year gives 0. Other columns of ``df`` are not read."""
    cols = [F.col(f"`{id_column}`").alias("id"), F.col(f"`{title}`").cast("string").alias("title"), F.col(f"`{authors}`").alias("authors"), F.expr(f"try_cast(`{year}` as bigint)").alias("year")]
    if doi:
        cols.append(F.col(f"`{doi}`").alias("doi"))
    if dblp_key:
        cols.append(F.col(f"`{dblp_key}`").alias("dblp_key"))
    return df.select(*cols).mapInArrow(_normal, _schema(df.schema[id_column].dataType))


def contents(normal: DataFrame) -> DataFrame:
    """Distinct contents: rep (their hash), first (smallest id), fp, title_key, names and year. Copies are combined before the
    shuffle. Two contents of one hash end the query (at a thousand million contents one in forty runs) instead of being merged."""
    fields = ("fp", "title_key", "names", "year")
    one = normal.groupBy(F.col("cid").alias("rep")).agg(F.min("id").alias("first"), *(F.first(f).alias(f) for f in fields), F.min("check").alias("_low"), F.max("check").alias("_high"))
    sound = F.when(F.col("_low") == F.col("_high"), F.lit(True)).otherwise(F.raise_error(F.lit("two contents have one hash")).cast("boolean"))
    return one.where(sound).drop("_low", "_high")


def with_both(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs (a, b) with title_key, names and year of both, as ta, na, ya and tb, nb, yb, if their years agree."""
    of = lambda df, end, key: df.select(F.col("rep").alias(key), F.col("title_key").alias("t" + end), F.col("names").alias("n" + end), F.col("year").alias("y" + end))
    both = pairs.join(of(left, "a", "a"), "a").join(of(right, "b", "b"), "b")
    return both.where(f"ya = 0 or yb = 0 or abs(ya - yb) <= {YEARS_APART}")


def same_paper(ta: str, na: str, ya: int, tb: str, nb: str, yb: int) -> bool:
    """Whether two normal records describe one paper: the same content words up to typing errors, at least half of the
    shorter author list shared, years (if known) at most two apart. A short title also needs half of all authors and years at
    most one apart, a title that is cut off years at most one apart; without authors on a side, a whole, long title and years
    at most one apart are needed."""
    apart = abs(ya - yb) if ya and yb else 0
    if apart > YEARS_APART:
        return False
    wa, wb = ta.split(), tb.split()
    more_a, more_b, typos, cut = text.title_difference(wa, wb)
    few = min(len(wa), len(wb))
    if more_a or more_b or (cut and apart > 1) or typos > max(2, 1.2 * few):
        return False
    la, lb = na.split(), nb.split()
    if not la or not lb:
        return few >= SHORT_TITLE and apart <= 1 and not cut
    shared = text.names_shared(la, lb)
    if few < SHORT_TITLE:
        return apart <= 1 and 2 * shared >= max(len(la), len(lb))
    return shared > 0 and 2 * shared >= min(len(la), len(lb))
