"""Problem 5: the most similar vectors of every vector, by randomly rotated one-bit codes.

Vectors are put into cells of a coarse partition, whose number grows with the vectors: one level of centres, and beyond what a
bounded sample can fit, a second level of centres of residuals. The residual of a vector to its cell's centre is rotated at random
and kept as one bit a dimension, packed, with three scalars; a query's residual is kept as planes of bits. Only these codes are sent
to the cells. There the inner product of a query with each member is estimated from the codes alone, with an error bound, and a
member is kept if its bound reaches the query's k-th best estimate and the least similarity asked for. Each pair left is compared in
full in one of the groups that found it, and each such group gets a vector that it needs once. Equal vectors are searched once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import stage

DIM = 128
#: The cells are fitted on about so many vectors, chosen by a hash of the id; all vectors are indexed.
FIT_ROWS = 16_000
#: Members that a cell should have on average; the number of cells follows the number of vectors.
CELL = 500
#: Times ``CELL`` that cells may grow to before there is a second level: its cells part close vectors far more often.
GROWN = 8
#: Vectors of the sample that a centre needs.
PER_CENTRE = 8
#: Cells that each query looks into.
PROBES = 8
#: Members, and queries, of a cell that one task holds at once; larger cells are split into blocks of both.
BLOCK = 8_000
#: Width of the error bound, in standard deviations.
EPSILON = 3.0
#: Bits by which a query's numbers are told apart.
PLANES = 4
_SEED = 5


@lru_cache(maxsize=4)
def rotation(dim: int, seed: int = _SEED) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def _pack(bits: np.ndarray) -> np.ndarray:
    """(rows, words) of 64-bit numbers from (rows, dim) of bits."""
    packed = np.packbits(bits, axis=-1)
    short = -packed.shape[-1] % 8
    if short:
        packed = np.concatenate([packed, np.zeros((*packed.shape[:-1], short), np.uint8)], axis=-1)
    return np.ascontiguousarray(packed).view(np.uint64)


def codes(residuals: np.ndarray, rotate: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(packed bits, length, correction) of residuals; the correction is the inner product of the rotated direction with its code."""
    norm = np.linalg.norm(residuals, axis=1)
    turned = (residuals / np.maximum(norm, 1e-12)[:, None]) @ rotate
    correction = np.maximum(np.abs(turned).sum(axis=1) / np.sqrt(residuals.shape[1]), 1e-6)
    return _pack(turned > 0), norm.astype(np.float32), correction.astype(np.float32)


def query_planes(residuals: np.ndarray, rotate: np.ndarray, planes: int = PLANES) -> tuple[np.ndarray, np.ndarray]:
    """(planes of packed bits (rows, planes, words), scalars (rows, 4): smallest number, step, sum, length) of query residuals."""
    turned = residuals @ rotate
    low = turned.min(axis=1)
    step = np.maximum((turned.max(axis=1) - low) / (2**planes - 1), 1e-12)
    level = np.rint((turned - low[:, None]) / step[:, None]).astype(np.uint8)
    bits = np.stack([_pack((level >> j) & 1) for j in range(planes)], axis=1)
    return bits, np.stack([low, step, turned.sum(axis=1), np.linalg.norm(residuals, axis=1)], axis=1).astype(np.float32)


def estimates(bits: np.ndarray, norm: np.ndarray, correction: np.ndarray, planes: np.ndarray, scalars: np.ndarray, dim: int, epsilon: float = EPSILON) -> tuple[np.ndarray, np.ndarray]:
    """(estimate, error bound), each (queries, members), of the inner products of residuals, from codes alone.

    With u a member's direction, o its code and q a rotated query residual, <u, q> is about <o, q> / <o, u>, with an error of at
    most epsilon * sqrt((1 - <o, u>^2) / <o, u>^2) * |q| / sqrt(dim - 1) but for rare cases, and that of the query's steps."""
    low, step, total, length = (scalars[:, k : k + 1] for k in range(4))
    # small whole numbers, exact in a product of matrices, which is faster than AND and bit counts
    plain = lambda x: np.unpackbits(np.ascontiguousarray(x).view(np.uint8), axis=-1)
    level = (plain(planes) << np.arange(planes.shape[1], dtype=np.uint8)[None, :, None]).sum(axis=1)
    count = level.astype(np.float32) @ plain(bits).astype(np.float32).T
    ones = np.bitwise_count(bits).sum(axis=1).astype(np.float32)
    product = (2 * (low * ones[None, :] + step * count) - total) / np.sqrt(dim)
    scale = (norm / correction)[None, :]
    variance = (length**2) * ((1 - np.minimum(correction, 1) ** 2) / (dim - 1))[None, :] + step**2 / 6
    return scale * product, epsilon * scale * np.sqrt(variance)


def usable(vector, dim: int = DIM):
    """A column: exactly ``dim`` numbers, none null or NaN or infinite, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) == dim) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _centres(vectors: np.ndarray, cells: int, rounds: int = 8, unit: bool = True) -> np.ndarray:
    """k-means; of unit vectors with centres of length one."""
    rng = np.random.default_rng(_SEED)
    centres = vectors[rng.permutation(len(vectors))[:cells]].copy()
    for _ in range(rounds):
        half = (centres**2).sum(axis=1) / 2
        near = np.concatenate([(vectors[i : i + 4096] @ centres.T - half).argmax(axis=1) for i in range(0, len(vectors), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, near, vectors)
        size = np.linalg.norm(sums, axis=1) if unit else np.bincount(near, minlength=cells)
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1e-12)[:, None], centres)
    return centres.astype(np.float32)


def _unit(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float32)
    x = flat.reshape(-1, dim).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


class Cells:
    """A coarse partition: centres, and centres of residuals for a second level (one zero vector if there is none)."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.first, self.second = first, second
        self.half = ((first**2).sum(axis=1)[:, None] + (second**2).sum(axis=1)[None, :]) / 2 + first @ second.T

    def nearest(self, x: np.ndarray, probes: int) -> np.ndarray:
        """(rows, probes) of the nearest cells, the nearest first; fewer if there are fewer."""
        out = []
        wide = min(len(self.first), 2 * probes if len(self.second) > 1 else probes)
        most = min(probes, wide * len(self.second))
        for s in range(0, len(x), 256):
            part = x[s : s + 256]
            near = part @ self.first.T
            top = np.argpartition(-(near - self.half[:, 0]), wide - 1, axis=1)[:, :wide]
            score = np.take_along_axis(near, top, 1)[:, :, None] + (part @ self.second.T)[:, None, :] - self.half[top]
            flat = score.reshape(len(part), -1)
            best = np.argsort(-flat, axis=1, kind="stable")[:, :most]
            out.append(np.take_along_axis(top, best // len(self.second), 1) * len(self.second) + best % len(self.second))
        return np.concatenate(out)

    def centre(self, cell: np.ndarray) -> np.ndarray:
        return self.first[cell // len(self.second)] + self.second[cell % len(self.second)]


def fit_cells(vectors: DataFrame, dim: int = DIM, cell: int = CELL, fit_rows: int = FIT_ROWS) -> Cells | None:
    """Cells for ``vectors``, fitted on about ``fit_rows`` of them, of all models together; None if there are none."""
    n = vectors.count()
    if not n:
        return None
    some = vectors.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(min(1.0, fit_rows / n) * 1_000_000)).select("vector").limit(2 * fit_rows).toArrow()
    x = np.concatenate([_unit(b, dim) for b in some.to_batches()]) if some.num_rows else np.eye(1, dim, dtype=np.float32)
    wanted = max(1, round(n / cell))
    first = _centres(x, int(min(wanted, max(1, len(x) // PER_CENTRE))))
    more = int(min(-(-n // (len(first) * GROWN * cell)), max(1, len(x) // PER_CENTRE)))
    if more == 1:
        return Cells(first, np.zeros((1, dim), np.float32))
    return Cells(first, _centres(x - first[(x @ first.T).argmax(axis=1)], more, unit=False))


_CODES = "model string, cell long, member boolean, id long, bits binary, s0 float, s1 float, s2 float, s3 float, s4 float"


def _encode(cells: Cells, dim: int, probes: int):
    """Rows for the cells: each vector as member of its nearest cell and as query of its ``probes`` nearest ones, as codes."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rotate = rotation(dim)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unit(batch, dim)
            model, ids = batch.column("model"), batch.column("id")
            near = cells.nearest(x, probes)
            for k in range(-1, near.shape[1]):
                cell = near[:, max(k, 0)]
                centre = cells.centre(cell)
                if k < 0:
                    bits, norm, correction = codes(x - centre, rotate)
                    scalars = [norm, correction, (x * centre).sum(axis=1)]
                else:
                    bits, four = query_planes(x - centre, rotate)
                    scalars = [*four.T, ((x - centre) * centre).sum(axis=1)]
                scalars += [np.zeros(len(x), np.float32)] * (5 - len(scalars))
                raw = np.ascontiguousarray(bits).reshape(len(x), -1)
                held = pa.FixedSizeBinaryArray.from_buffers(pa.binary(raw.shape[1] * 8), len(x), [None, pa.py_buffer(raw.tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([model, pa.array(cell.astype(np.int64)), pa.array(np.full(len(x), k < 0)), ids, held, *(pa.array(np.ascontiguousarray(s, dtype=np.float32)) for s in scalars)], names=["model", "cell", "member", "id", "bits", "s0", "s1", "s2", "s3", "s4"])

    return of


def shortlist(ids: np.ndarray, bits: np.ndarray, member: np.ndarray, qids: np.ndarray, planes: np.ndarray, query: np.ndarray, k: int, dim: int, least: float, epsilon: float = EPSILON) -> Iterator[tuple[np.ndarray, ...]]:
    """(query ids, member ids, lower bound, upper bound) of members whose upper bound reaches ``least`` and the k-th best lower bound
    of the query in this block. ``member``: (members, 3) length, correction, <vector, centre>; ``query``: (queries, 5) the four
    scalars of ``query_planes`` and <residual, centre>."""
    for start in range(0, len(qids), 256):
        part = slice(start, start + 256)
        product, bound = estimates(bits, member[:, 0], member[:, 1], planes[part], query[part, :4], dim, epsilon)
        # <x, q> = <x, centre> + <centre, q - centre> + <x - centre, q - centre>
        product += member[None, :, 2] + query[part, 4:5]
        own = ids[None, :] == qids[part, None]
        lower = np.where(own, -np.inf, product - bound)
        kk = min(k, lower.shape[1])
        worst = -np.partition(-lower, kk - 1, axis=1)[:, kk - 1]
        i, j = np.nonzero((product + bound >= np.maximum(worst, least)[:, None]) & ~own)
        yield qids[part][i], ids[j], lower[i, j].astype(np.float32), (product + bound)[i, j].astype(np.float32)


def search_cell(ids: np.ndarray, x: np.ndarray, queries: np.ndarray, qids: np.ndarray, k: int, rotate: np.ndarray, least: float = -2.0, epsilon: float = EPSILON) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query ids, member ids, cosine) of the k most similar members of each query, itself left out, by codes and then by the full
    vectors of the shortlist: the whole search in one block (``ids`` ascending)."""
    centre = x.mean(axis=0)
    bits, norm, correction = codes(x - centre, rotate)
    planes, four = query_planes(queries - centre, rotate)
    member = np.stack([norm, correction, x @ centre], axis=1)
    query = np.concatenate([four, ((queries - centre) @ centre)[:, None]], axis=1)
    at = {q: n for n, q in enumerate(qids.tolist())}
    for a, b, _, _ in shortlist(ids, bits, member, qids, planes, query, k, x.shape[1], least, epsilon):
        i, j = np.array([at[q] for q in a.tolist()], dtype=np.int64), np.searchsorted(ids, b)
        cosine = np.einsum("ij,ij->i", queries[i].astype(np.float64), x[j].astype(np.float64))
        order = np.lexsort((b, -cosine, i))
        i, b, cosine = i[order], b[order], cosine[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        top = rank < k
        yield qids[i[top]], b[top], cosine[top]


_FOUND = pa.schema([("g", pa.int64()), ("id", pa.int64()), ("other", pa.int64()), ("low", pa.float32()), ("high", pa.float32())])
#: Pairs whose full vectors are held at once.
SLICE = 50_000


def _search(k: int, dim: int, least: float):
    words = -(-dim // 64)

    def of(table: pa.Table) -> pa.Table:
        member = table.column("member").to_numpy()
        ids = table.column("id").to_numpy()
        scalars = np.stack([table.column(f"s{n}").to_numpy() for n in range(5)], axis=1)
        raw = table.column("bits").to_pylist()
        m, q = np.nonzero(member)[0], np.nonzero(~member)[0]
        if not len(m) or not len(q):
            return _FOUND.empty_table()
        bits = np.frombuffer(b"".join(raw[i] for i in m), np.uint64).reshape(len(m), words)
        planes = np.frombuffer(b"".join(raw[i] for i in q), np.uint64).reshape(len(q), -1, words)
        g = table.column("g")[0].as_py()
        out = [pa.table([np.full(len(x[0]), g), *x], schema=_FOUND) for x in shortlist(ids[m], bits, scalars[m, :3], ids[q], planes, scalars[q], k, dim, least)]
        return pa.concat_tables(out)

    return of


def _cosines(dim: int):
    def of(pairs: pa.Table, vectors: pa.Table) -> pa.Table:
        ids = vectors.column("id").to_numpy()
        order = np.argsort(ids)
        x = vectors.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)[order]
        ids = ids[order]
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        a, b = pairs.column("a").to_numpy(), pairs.column("b").to_numpy()
        i, j = np.searchsorted(ids, a), np.searchsorted(ids, b)
        cosine = [np.einsum("ij,ij->i", x[i[s : s + SLICE]], x[j[s : s + SLICE]]) for s in range(0, len(i), SLICE)]
        return pa.table([a, b, np.concatenate(cosine) if cosine else np.zeros(0)], names=["a", "b", "cosine"])

    return of


def _crowds(cells: Cells, probes: int, dim: int):
    """How many members and queries each cell gets, a row for each model and cell of a batch."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                near = cells.nearest(_unit(batch, dim), probes)
                at = pa.table({"model": pa.chunked_array([batch.column("model")]).take(pa.array(np.repeat(np.arange(len(near)), near.shape[1]))), "cell": near.ravel().astype(np.int64), "member": (np.arange(near.size) % near.shape[1] == 0).astype(np.int64)})
                yield from at.group_by(["model", "cell"]).aggregate([("member", "sum"), ("member", "count")]).rename_columns(["model", "cell", "members", "queries"]).to_batches()

    return of


def index(vectors: DataFrame, dim: int = DIM, probes: int = PROBES, cell: int = CELL) -> tuple[DataFrame, DataFrame] | None:
    """The codes of all vectors by cell, as members and as queries, made when they are read, and (model, cell, members, queries) of the
    cells; None if there are none. The cells (at most twice ``FIT_ROWS`` / ``PER_CENTRE`` centres) are broadcast."""
    cells = fit_cells(vectors, dim, cell)
    if cells is None:
        return None
    shared = vectors.sparkSession.sparkContext.broadcast((cells.first, cells.second))

    def encode(batches):
        return _encode(Cells(*shared.value), dim, probes)(batches)

    def count(batches):
        return _crowds(Cells(*shared.value), probes, dim)(batches)

    held = vectors.select("id", "model", "vector")
    sizes = held.mapInArrow(count, "model string, cell long, members long, queries long").groupBy("model", "cell").agg(F.sum("members").alias("members"), F.sum("queries").alias("queries"))
    return held.mapInArrow(encode, _CODES), sizes


def neighbours(vectors: DataFrame, k: int = 5, dim: int = DIM, probes: int = PROBES, least: float = -2.0, cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """(id, other, cosine): the k most similar other vectors of the same model of every vector, ties to the smaller id.

    ``vectors`` has id (bigint, unique), model and vector (usable, length ``dim``). Pairs below ``least`` are left out (after
    the k best are chosen). The result is approximate: a neighbour is missed if its cell is not among the query's."""
    held = vectors.select("id", F.coalesce("model", F.lit("")).alias("model"), "vector")
    made = index(held, dim, probes, cell)
    if made is None:
        return held.sparkSession.createDataFrame([], "id long, other long, cosine double")
    # a crowded cell is cut into blocks of members and of queries, and every block meets every other
    rows, sizes = made
    crowd = stage(sizes.select("model", "cell", *(F.ceil(F.col(c) / F.lit(block)).cast("int").alias(n) for n, c in (("ms", "members"), ("qs", "queries")))).where("ms > 1 or qs > 1"), "crowd")
    keys = ["model", "cell"]
    if not crowd.isEmpty():
        wide = rows.join(crowd, keys, "left").withColumn("ms", F.greatest(F.coalesce("ms", F.lit(1)), F.lit(1))).withColumn("qs", F.greatest(F.coalesce("qs", F.lit(1)), F.lit(1)))
        own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
        every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
        wide = wide.withColumn("mb", F.explode(F.when(F.col("member"), F.array(own("ms"))).otherwise(every("ms"))))
        rows = wide.withColumn("qb", F.explode(F.when(F.col("member"), every("qs")).otherwise(F.array(own("qs"))))).drop("ms", "qs")
        keys = ["model", "cell", "mb", "qb"]
    found = rows.withColumn("g", F.xxhash64(*keys)).groupBy(*keys).applyInArrow(_search(k, dim, least), "g long, id long, other long, low float, high float")
    ordered = Window.partitionBy("id").orderBy(F.desc("low")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    kept = found.withColumn("kth", F.nth_value("low", k).over(ordered)).where("kth is null or high >= kth")
    pairs = kept.groupBy(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).agg(F.min("high").alias("high"), F.min("g").alias("g"))
    pairs = stage(pairs.where(F.col("high") >= least).select("g", "a", "b"), "pairs")
    needed = pairs.select(F.col("g").alias("at"), F.explode(F.array("a", "b")).alias("id")).distinct().join(held.select("id", "vector"), "id")
    exact = pairs.groupBy("g").cogroup(needed.groupBy("at")).applyInArrow(_cosines(dim), "a long, b long, cosine double").where(F.col("cosine") >= least)
    exact = stage(exact, "cosines")
    both = exact.select(F.col("a").alias("id"), F.col("b").alias("other"), "cosine").unionAll(exact.select(F.col("b").alias("id"), F.col("a").alias("other"), "cosine"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("cosine"), "other"))
    return both.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")


def close_pairs(papers: DataFrame, k: int = 5, least: float = 0.80, uid: str = "paper_uid", vector: str = "embedding", model: str = "embedding_model") -> DataFrame:
    """p5: (uid_a, uid_b), smaller uid first: rows of one model with cosine of at least ``least``, at least one of which is among
    the k most similar rows of the other. Rows with unusable vectors or a null uid take no part; a null model is a model of its own.

    Equal vectors of a model are searched once: each of them has its copies with the smallest uids as its nearest rows, and then
    the nearest other vectors' rows."""
    rows = papers.where(usable(F.col(vector)) & F.col(uid).isNotNull())
    rows = rows.select(F.col(uid).alias("uid"), F.coalesce(F.col(model), F.lit("")).alias("model"), F.col(vector).cast("array<float>").alias("vector"))
    rows = rows.withColumn("h1", F.xxhash64("vector")).withColumn("h2", F.xxhash64(F.lit(1), "vector"))
    same = ["model", "h1", "h2"]
    copied = rows.groupBy(*same).agg(F.count("*").alias("n"), F.min("uid").alias("rep")).where("n > 1")
    copies = stage(rows.select("uid", *same).join(copied, same).select("uid", "rep", "n"), "copies")
    single = rows.join(copies.where("uid <> rep").select("uid"), "uid", "left_anti").withColumn("id", F.monotonically_increasing_id()).select("id", "uid", "model", "vector")
    single = stage(single, "vectors")
    found = neighbours(single, k, least=least)
    name = lambda key, to: single.select(F.col("id").alias(key), F.col("uid").alias(to))
    found = found.join(name("id", "one"), "id").join(name("other", "two"), "other").select("one", "two", "cosine")
    first = copies.withColumn("at", F.row_number().over(Window.partitionBy("rep").orderBy("uid"))).where(F.col("at") <= k + 1)
    # the rows of the vectors found, in order, as far as a row's own copies leave room
    sizes = copies.where("uid = rep").select(F.col("rep").alias("one"), "n")
    wide = found.join(first.select(F.col("rep").alias("two"), F.col("uid").alias("row")), "two", "left").withColumn("row", F.coalesce("row", "two")).join(sizes, "one", "left").withColumn("n", F.coalesce("n", F.lit(1)))
    place = F.row_number().over(Window.partitionBy("one").orderBy(F.desc("cosine"), "row"))
    wide = wide.where(F.col("n") <= k).withColumn("place", place).where(F.col("place") <= k + 1 - F.col("n"))
    own = copies.where(F.col("n") <= k).select(F.col("rep").alias("one"), F.col("uid").alias("mine"))
    others = wide.join(own, "one", "left").select(F.coalesce("mine", "one").alias("x"), F.col("row").alias("y"))
    among = copies.select("rep", F.col("uid").alias("x")).join(first.select("rep", F.col("uid").alias("y"), "at"), "rep").where("x <> y")
    among = among.withColumn("place", F.row_number().over(Window.partitionBy("x").orderBy("at"))).where(F.col("place") <= k).select("x", "y")
    return others.unionAll(among).select(F.least("x", "y").alias("uid_a"), F.greatest("x", "y").alias("uid_b")).where("uid_a < uid_b").distinct()
