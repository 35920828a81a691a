"""Problem 2: new batches against all history, by bit-difference fingerprints in rotated block tables.

A record's fingerprint has five 32-bit blocks: one for each third of its title's content words and two for family names (those
with the smallest and the largest hash). A block is a bit-majority fingerprint of the trigrams of its part, so a typing error
changes some bits of one block and leaves the others as they are. Each table of the index holds two blocks of every record as
its key (two thirds of the title, or a name and a third); two more hold every DOI and bibliography key of a record. Records that
agree in a key are compared by the Hamming distance of their title fingerprints and, if close, by their words.

``History`` keeps the index as a table bucketed by key and the accepted contents as one bucketed by content. A batch is normalised and
fingerprinted once; its keys are looked up in the index, whose buckets are read but neither shuffled nor made anew; pairs of two old
records are never compared again. Then the batch's rows are appended to both tables.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fingerprints as fp
from . import records
from .graph import components, shared_dir, stage

#: Bits (of 64) in which the title fingerprints of two records of one paper may differ.
HAMMING = 24
#: Members of one key that are compared at once; more are compared block by block.
RUN = 256
#: Batches that one run may have; each costs some jobs of its own.
MOST_BATCHES = 1_000
_BLOCKS = "key long, fp long, id long, year short"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        titles = batch.column("title_key").to_pylist()
        names = [[x.partition("|")[0] for x in n.split()] for n in batch.column("names").to_pylist()]
        ids, title, years = (np.asarray(batch.column(c)) for c in ("rep", "fp", "year"))
        words = [t.split() for t in titles]
        parts = [[" ".join(w[i] for i in range(len(w)) if 3 * i // len(w) == k) for w in words] for k in range(3)]
        flat = fp.hash_strings([n for ns in names for n in ns])
        ends, at = [[], []], 0
        for ns in names:
            h = flat[at : at + len(ns)]
            at += len(ns)
            ends[0].append(ns[int(h.argmin())] if ns else "")
            ends[1].append(ns[int(h.argmax())] if len(ns) > 1 else "")
        blocks = [fp.fingerprint(p, 32) for p in parts + ends]
        some = [np.array([bool(p) for p in part], dtype=bool) for part in parts + ends]
        long = np.array([len(w) >= records.SHORT_TITLE for w in words], dtype=bool)
        keys, rows = [], []
        for table, (i, j) in enumerate([(0, 1), (0, 2), (1, 2), (3, 0), (3, 1), (3, 2), (4, 0), (4, 1), (4, 2)]):
            ok = some[i] & some[j] & (long if i < 3 else True)
            keys.append(fp.mix(fp.mix((blocks[i][ok] << np.uint64(32)) | blocks[j][ok]) + np.uint64(table)))
            rows.append(np.nonzero(ok)[0])
        at = np.concatenate(rows)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(title[at]), pa.array(ids[at]), pa.array(years[at])], names=["key", "fp", "id", "year"])


def _identifiers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, rows = [], []
        for table, name in ((9, "doi_key"), (10, "dblp_key")):
            col = batch.column(name)
            ok = np.asarray(col.is_valid())
            keys.append(fp.mix(np.asarray(col.fill_null(0)).view(np.uint64)[ok] + np.uint64(table)).view(np.int64))
            rows.append(np.nonzero(ok)[0])
        at = np.concatenate(rows)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.asarray(batch.column("fp"))[at]), pa.array(np.asarray(batch.column("rep"))[at]), pa.array(np.asarray(batch.column("year"))[at])], names=["key", "fp", "id", "year"])


def block_tables(contents: DataFrame, normal: DataFrame | None = None) -> DataFrame:
    """The fingerprint index: (key, fp, id, year) rows, about nine for each of ``contents`` and one for each different DOI and bibliography
    key of the records ``normal`` of a content. Appending new rows extends it."""
    blocks = contents.select("rep", "fp", "title_key", "names", "year").mapInArrow(_blocks, _BLOCKS)
    return blocks if normal is None else blocks.unionAll(identifier_rows(normal))


def identifier_rows(normal: DataFrame) -> DataFrame:
    """(key, fp, id, year) of each different DOI and bibliography key of a content, from the records of ``normal``."""
    known = normal.where("doi_key is not null or dblp_key is not null").select(F.col("cid").alias("rep"), "fp", "year", "doi_key", "dblp_key")
    return known.mapInArrow(_identifiers, _BLOCKS).distinct()


def close_pairs(blocks: DataFrame, hamming: int = HAMMING, run: int = RUN) -> DataFrame:
    """Distinct pairs (a < b) of records that share a key and whose title fingerprints are close."""

    def of(batches):
        return fp.pairs_of_sorted(batches, hamming, run, False, whole=True, years_apart=records.YEARS_APART)

    return blocks.repartition("key").sortWithinPartitions("key", "fp", "id").mapInArrow(of, "a long, b long").distinct()


def fresh_pairs(known: DataFrame, new: DataFrame, hamming: int = HAMMING, run: int = RUN) -> DataFrame:
    """As ``close_pairs`` over rows of both tables, without the pairs of two known records."""

    def of(batches):
        return fp.pairs_of_sorted(batches, hamming, run, False, whole=True, one_new=True, years_apart=records.YEARS_APART)

    both = known.select("key", "fp", "id", "year", F.lit(0).cast("byte").alias("side")).unionAll(new.select("key", "fp", "id", "year", F.lit(1).cast("byte").alias("side")))
    return both.repartition("key").sortWithinPartitions("key", "fp", "id").mapInArrow(of, "a long, b long").distinct()


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols = [batch.column(n).to_pylist() for n in ("ta", "na", "ya", "tb", "nb", "yb")]
        ok = pa.array([records.same_paper(*x) for x in zip(*cols)], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(ok), batch.column("b").filter(ok)], names=["a", "b"])


def verified(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """The pairs whose texts describe one paper (``records.same_paper``)."""
    return records.with_both(pairs, left, right).mapInArrow(_verified, "a long, b long")


def paper_groups(papers: DataFrame, id_column: str = "row_id") -> DataFrame:
    """(row_id, first_row_id) of every row that describes the same paper as another row, all rows in one batch.

    ``papers`` needs title, authors, year, doi and dblp_key beside the id; other columns are not read. Rows without a usable
    title and without authors are equal only to rows with the same normal form. An empty table gives no rows."""
    rows = _resolved(*step(papers, None, None, id_column)[:2])
    counts = rows.groupBy("first").agg(F.count("*").alias("n")).where("n > 1").select("first")
    return rows.join(counts, "first").select(F.col("id").alias("row_id"), F.col("first").alias("first_row_id"))


class Step(NamedTuple):
    """placed: (id, paper) of every row of the batch, the paper named by its first row as far as it is known then; merges: (a, b) of
    papers that this batch shows to be one; index and accepted: rows to append to both tables."""

    placed: DataFrame
    merges: DataFrame
    index: DataFrame
    accepted: DataFrame


def step(batch: DataFrame, index: DataFrame | None, accepted: DataFrame | None, id_column: str = "row_id", hamming: int = HAMMING, run: int = RUN) -> Step:
    """One batch against history. ``index``: block rows (key, fp, id, year); ``accepted``: contents (rep, title_key, names, year, paper);
    both None at the start. Of the index only rows whose key occurs in the batch go on, of the contents only those such a row names."""
    normal = stage(records.normal_records(batch, id_column, doi="doi", dblp_key="dblp_key"), "normal")
    reps = stage(records.contents(normal), "contents")
    if index is None or accepted is None:
        new = fresh = reps
        blocks = stage(block_tables(reps, normal), "blocks")
        old = None
        links = verified(close_pairs(blocks, hamming, run), reps, reps)
    else:
        old = stage(accepted.join(reps.select("rep"), "rep", "left_semi").select("rep", "paper"), "old")
        fresh = reps.join(old.select("rep"), "rep", "left_anti")
        # only identifiers of known contents can be in the index already
        seen = old.select(F.col("rep").alias("id"), F.lit(True).alias("again"))
        named = identifier_rows(normal).join(seen, "id", "left").select("key", "fp", "id", "year", F.coalesce("again", F.lit(False)).alias("again"))
        asked = stage(block_tables(fresh).withColumn("again", F.lit(False)).unionAll(named), "asked")
        known = stage(index.join(asked.select("key"), "key", "left_semi"), "known")
        added = asked.where("again").join(known.select("key", "id"), ["key", "id"], "left_anti")
        blocks = asked.where("not again").select("key", "fp", "id", "year").unionAll(added.select("key", "fp", "id", "year"))
        pairs = stage(fresh_pairs(known, blocks, hamming, run), "pairs")
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
        texts = accepted.join(wanted, "rep", "left_semi")
        texts = stage(texts, "texts")
        old = old.unionByName(texts.select("rep", "paper")).distinct()
        # a content of the batch is either new or among those
        new = fresh.select("rep", "title_key", "names", "year").unionByName(texts.select("rep", "title_key", "names", "year"))
        links = verified(pairs, new, new)
    nodes = reps.select("rep", F.col("first").alias("paper"))
    if old is not None:
        nodes = old.unionByName(nodes.join(old.select("rep"), "rep", "left_anti"))
    nodes = stage(nodes, "nodes")
    of = lambda end: nodes.select(F.col("rep").alias(end), F.col("paper").alias("p" + end))
    merges = stage(links.join(of("a"), "a").join(of("b"), "b").where("pa <> pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "merges")
    placed = normal.select("id", F.col("cid").alias("rep")).join(nodes, "rep").select("id", "paper")
    # contents are named by their own first row; merges say which papers are one
    return Step(placed, merges, blocks, fresh.select("rep", "title_key", "names", "year", F.col("first").alias("paper")))


def _resolved(placed: DataFrame, merges: DataFrame) -> DataFrame:
    """(id, first) of all rows: papers that merges join are one, named by its smallest row."""
    roots = components(merges)
    rows = stage(placed.join(roots.withColumnRenamed("node", "paper"), "paper", "left").select("id", F.coalesce("root", "paper").alias("root")), "rows")
    first = rows.groupBy("root").agg(F.min("id").alias("first"))
    return rows.join(first, "root").select("id", "first")


class History:
    """Accepted records and their index as bucketed tables in the shared folder, for this session under a name of their own."""

    def __init__(self, spark: SparkSession, id_column: str = "row_id", buckets: int | None = None):
        self.spark, self.id_column = spark, id_column
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"citeloom_{uuid.uuid4().hex}"
        self.placed: list[DataFrame] = []
        self.merges: list[DataFrame] = []

    def _table(self, kind: str) -> DataFrame | None:
        return self.spark.table(f"{self.name}_{kind}") if self.spark.catalog.tableExists(f"{self.name}_{kind}") else None

    def _append(self, rows: DataFrame, kind: str, key: str) -> None:
        path = os.path.join(shared_dir(self.spark), f"{self.name}_{kind}")
        rows.repartition(self.buckets, key).write.bucketBy(self.buckets, key).sortBy(key).mode("append").format("parquet").option("path", path).saveAsTable(f"{self.name}_{kind}")

    def accept(self, batch: DataFrame) -> None:
        """Looks a batch up and appends it."""
        done = step(batch, self._table("index"), self._table("accepted"), self.id_column)
        self.placed.append(done.placed)
        self.merges.append(done.merges)
        # both come from what this step has written down, not from the tables that are added to
        self._append(done.index, "index", "key")
        self._append(done.accepted, "accepted", "rep")

    def rows(self) -> DataFrame:
        """(id, first): all rows accepted so far and the first row of the paper that each describes."""
        union = lambda parts: reduce(DataFrame.unionByName, parts)
        return _resolved(union(self.placed), union(self.merges))


def find_repeats(papers: DataFrame, id_column: str = "row_id", batch: str | None = "batch_id") -> DataFrame:
    """p2: (first_row_id, row_id) of every row that repeats an earlier one, with the earliest row of its paper.

    The batches (values of ``batch``, of bounded number; null is a batch of its own) are accepted one after the other in the order
    of their first rows; without such a column all rows are one batch."""
    history = History(papers.sparkSession, id_column)
    if batch and batch in papers.columns:
        numbers = [r[0] for r in papers.groupBy(batch).agg(F.min(id_column).alias("at")).orderBy("at").limit(MOST_BATCHES + 1).collect()]
        if len(numbers) > MOST_BATCHES:
            raise ValueError(f"more than {MOST_BATCHES} batches")
        for number in numbers:
            history.accept(papers.where(F.col(batch).eqNullSafe(F.lit(number))))
    else:
        history.accept(papers)
    if not history.placed:
        return papers.select(F.col(id_column).alias("first_row_id"), F.col(id_column).alias("row_id"))
    return history.rows().where("id <> first").select(F.col("first").alias("first_row_id"), F.col("id").alias("row_id"))


def append_batch(batch: DataFrame, index: DataFrame | None, accepted: DataFrame | None, id_column: str = "row_id", hamming: int = HAMMING, run: int = RUN) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One incremental step over tables of one's own: (repeats, index rows to append, accepted rows to append).

    ``repeats`` has (row_id, matched_row_id): the first row of the paper that the row describes, in history or in the batch."""
    done = step(batch, index, accepted, id_column, hamming, run)
    roots = components(done.merges).withColumnRenamed("node", "paper")
    rows = done.placed.join(roots, "paper", "left").select(F.col("id").alias("row_id"), F.coalesce("root", "paper").alias("matched_row_id"))
    return rows.where("row_id <> matched_row_id"), done.index, done.accepted
