"""Full-text ranking and vector search over a collection, and the cascade that looks papers up by DOI, title and text."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import stage

K1, B = 1.2, 0.75


def postings(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(term, key, tf) and (key, length) of the tokens of a text column."""
    words = docs.select(F.col(key), X.tokens(F.col(text)).alias("w"))
    terms = words.select(key, F.explode("w").alias("term")).groupBy("term", key).agg(F.count("*").alias("tf"))
    return terms, words.select(key, F.size("w").alias("length"))


def weights(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(term, key, weight, df): every posting with its part of a document's BM25 score; a table that can be kept."""
    terms, lengths = postings(docs, key, text)
    sizes = lengths.agg(F.count("*").alias("n"), F.avg("length").alias("average"))
    df = terms.groupBy("term").agg(F.count("*").alias("df"))
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.col("average")))
    return terms.join(lengths, key).join(df, "term").join(F.broadcast(sizes)).select("term", key, weight.alias("weight"), "df", "n")


#: Documents, and queries, that one task scores against each other at once; more are cut into blocks of both.
DOCUMENTS, ASKED = 200_000, 100_000
#: Blocks of queries that are made only for the sake of more tasks; each of them gets all documents.
COPIES = 8
#: Sums that are nearer to the best than this can be equal to it once they are rounded.
NEAR = 2e-6
#: Groups in which a query looks for a sum to begin with.
FIRST = 10


class _Postings:
    """The postings of a block of documents by term, and the highest weight of each term; documents in the order of their keys."""

    def __init__(self, docs: pa.Table, average: float):
        docs = docs.sort_by("key")
        self.keys = docs.column("key")
        terms = docs.column("terms").combine_chunks()
        words = terms.flatten().dictionary_encode()
        counts = terms.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        self.many = len(counts)
        doc, term = np.repeat(np.arange(len(counts)), counts), words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.code = {w: k for k, w in enumerate(words.dictionary.to_pylist())}
        if docs.column("weights").null_count:
            both, tf = np.unique(term * len(counts) + doc, return_counts=True)
            term, doc = both // len(counts), both % len(counts)
            part = tf * (K1 + 1) / (tf + K1 * (1 - B + B * counts[doc] / average))
        else:
            order = np.argsort(term * len(counts) + doc)
            term, doc, part = term[order], doc[order], docs.column("weights").combine_chunks().flatten().to_numpy(zero_copy_only=False)[order]
        self.doc, self.part = doc, part
        self.start = np.searchsorted(term, np.arange(len(self.code) + 1)).tolist()
        self.most = np.maximum.reduceat(part, self.start[:-1]).tolist() if self.code else []

    def best(self, asked: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
        """(documents, sums) that can have the highest rounded sum; of equal sums only the smallest key. ``asked``: the factor of each
        term. Terms add to all their documents until what is left together gives less than the best sum so far; from then on only
        to the documents that can still reach it."""
        known = sorted(((f * self.most[c], c, f) for t, f in asked.items() if (c := self.code.get(t)) is not None), reverse=True)
        if not known:
            return np.zeros(0, np.int64), np.zeros(0)
        rest = sum(k[0] for k in known)
        full, best, held = rest, 0.0, np.zeros(self.many)
        for n, (most, c, f) in enumerate(known):
            a, b = self.start[c], self.start[c + 1]
            held[self.doc[a:b]] += f * self.part[a:b]
            rest -= most
            if rest < full - rest and rest < (best := held.max()) - NEAR:
                break
        docs = np.nonzero(held >= max(best - NEAR - max(rest, 0.0), 1e-300))[0]
        sums = held[docs]
        for most, c, f in known[n + 1 :]:
            a, b = self.start[c], self.start[c + 1]
            there = self.doc[a:b]
            where = np.minimum(np.searchsorted(there, docs), b - a - 1)
            sums += np.where(there[where] == docs, f * self.part[a:b][where], 0.0)
            rest -= most
            kept = sums >= max(best, sums.max()) - NEAR - max(rest, 0.0)
            docs, sums = docs[kept], sums[kept]
        kept = sums >= sums.max() - NEAR
        sums, one = np.unique(sums[kept], return_index=True)
        return docs[kept][one], sums


def bm25_top(queries: DataFrame, docs: DataFrame, query_key: str, query_text: str, key: str, text: str, index: DataFrame | None = None) -> DataFrame:
    """(query_key, key, score): the document with the highest BM25 score for each query, ties to the smaller key; exact.

    Every block of queries meets every block of documents in one task, and only the best documents of each block leave it. There a
    document is left out only where a query's other terms cannot lift it to the best one found. Documents travel as their tokens, queries as their terms with the factors. ``index`` is a kept table of
    ``weights``, which is read instead of the texts of ``docs``."""
    spark, words = docs.sparkSession, F.array_distinct(X.tokens(F.col(query_text)))
    if index is None:
        held = docs.select(F.col(key).alias("key"), X.tokens(F.col(text)).alias("terms"))
        n, average = held.agg(F.count("*"), F.avg(F.size("terms"))).first()
        df = held.select(F.explode(F.array_distinct("terms")).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
        factors = df.select("term", F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("factor"))
        held = held.where(F.size("terms") > 0).withColumn("weights", F.lit(None).cast("array<double>"))
    else:
        factors = index.select("term").distinct().withColumn("factor", F.lit(1.0))
        held = index.groupBy(F.col(key).alias("key")).agg(F.collect_list(F.struct("term", "weight")).alias("p")).select("key", F.col("p.term").alias("terms"), F.col("p.weight").alias("weights"))
        n, average = index.select(F.first("n")).first()[0] or 0, 1.0
    asked = queries.select(F.col(query_key).alias("q"), F.explode(words).alias("term")).join(factors, "term")
    asked = stage(asked.groupBy("q").agg(F.collect_list(F.struct("term", "factor")).alias("p")).select("q", F.col("p.term").alias("terms"), F.col("p.factor").alias("factors")), "asked")
    many = asked.count()
    tasks = 2 * spark.sparkContext.defaultParallelism
    rows = max(-(-many // ASKED), min(COPIES, tasks, -(-many // 500)), 1)
    cols = max(-(-n // DOCUMENTS), min(-(-tasks // rows), -(-n // 5_000)), 1)
    spread = lambda df, c, own, other, cells: df.withColumn("own", F.pmod(F.xxhash64(c), F.lit(own)).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(other - 1)))).withColumn("cell", cells).drop("own", "other")
    left = spread(asked, "q", rows, cols, F.col("own") * cols + F.col("other"))
    right = spread(held, "key", cols, rows, F.col("other") * cols + F.col("own"))

    def score(one: pa.Table, other: pa.Table) -> pa.Table:
        found, docs, sums = [], [np.zeros(0, np.int64)], [np.zeros(0)]
        keys = other.column("key")
        if one.num_rows and other.num_rows:
            block = _Postings(other, average)
            keys = block.keys
            for k, (t, f) in enumerate(zip(one.column("terms").to_pylist(), one.column("factors").to_pylist())):
                d, s = block.best(dict(zip(t, f)))
                found += [k] * len(d)
                docs.append(d)
                sums.append(s)
        return pa.table([one.column("q").take(pa.array(found, pa.int64())), keys.take(pa.array(np.concatenate(docs))), pa.array(np.concatenate(sums))], names=["q", "key", "score"])

    kind = lambda df, c: df.schema[c].dataType.simpleString()
    found = left.groupBy("cell").cogroup(right.groupBy("cell")).applyInArrow(score, f"q {kind(asked, 'q')}, key {kind(held, 'key')}, score double")
    best = found.groupBy("q").agg(F.min(F.struct((-F.round("score", 6)).alias("minus"), F.col("key").alias("k"))).alias("b"))
    return best.select(F.col("q").alias(query_key), F.col("b.k").alias(key), F.round(-F.col("b.minus"), 4).alias("score"))


def cosine_top(queries: DataFrame, docs: DataFrame, key: str, vector: str, k: int = 5, block: int = 20_000, dim: int = 64) -> DataFrame:
    """(query, key, cosine): the k most similar other rows of every query row, exactly, in blocks of queries and of rows.

    Every block of rows meets every block of queries as one matrix product; each task keeps k rows a query, and one aggregation
    takes the k best of these. A block holds about ``block`` rows, however many there are; each row is sent to the blocks of the other
    side once. Rows without a vector of ``dim`` numbers or with a zero one take no part."""
    unit = lambda df: df.select(F.col(key).cast("bigint").alias("id"), X.unit_vector(F.col(vector)).alias("v")).where((F.size("v") == dim))
    q, d = unit(queries), unit(docs)
    many = [max(1, -(-df.count() // block)) for df in (q, d)]
    spread = lambda df, side, own, other, cols: df.withColumn("own", F.pmod(F.xxhash64("id"), F.lit(own))).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(other - 1)))).select("id", "v", F.lit(side).alias("side"), *cols)
    left = spread(q, 0, many[0], many[1], (F.col("own").alias("i"), F.col("other").cast("bigint").alias("j")))
    right = spread(d, 1, many[1], many[0], (F.col("other").cast("bigint").alias("i"), F.col("own").alias("j")))

    def product(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        ids = table.column("id").to_numpy()
        x = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        a, b = side == 0, side == 1
        out: list[tuple] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        xa, xb, ia, ib = x[a], x[b], ids[a], ids[b]
        for s in range(0, len(xa) if len(xb) else 0, 1024):
            c = xa[s : s + 1024] @ xb.T
            c[ia[s : s + 1024, None] == ib[None, :]] = -np.inf
            top = np.argsort(-c, axis=1, kind="stable")[:, :k] if len(ib) <= k else np.argpartition(-c, k - 1, axis=1)[:, :k]
            got = np.take_along_axis(c, top, 1).ravel()
            ok = np.isfinite(got)
            out.append((np.repeat(ia[s : s + 1024], top.shape[1])[ok], ib[top.ravel()][ok], got[ok]))
        return pa.table([pa.array(np.concatenate([o[n] for o in out])) for n in range(3)], names=["query", "key", "cosine"])

    found = left.unionAll(right).groupBy("i", "j").applyInArrow(product, "query long, key long, cosine double")
    best = found.groupBy("query").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.round("cosine", 6)).alias("c"), F.col("key").alias("k")))), 1, k).alias("t"))
    return best.select("query", F.explode("t").alias("t")).select("query", F.col("t.k").alias("key"), F.round(-F.col("t.c"), 4).alias("cosine"))


def embed(rows: DataFrame, embedder, dim: int, key: str = "paper_uid", text: str = "text", batch: int = 64) -> DataFrame:
    """(key, embedding) by an embedder (a callable from a list of texts to a list of vectors or None), called in batches inside
    the tasks. A batch that fails gives null vectors, so that it can be repeated."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            texts = part.column(text).to_pylist()
            out: list = []
            for s in range(0, len(texts), batch):
                try:
                    out += [v if v is not None and len(v) == dim else None for v in embedder(texts[s : s + batch])]
                except Exception:  # noqa: BLE001  the provider's errors are its own
                    out += [None] * len(texts[s : s + batch])
            yield pa.RecordBatch.from_arrays([part.column(key), pa.array(out, pa.list_(pa.float32()))], names=[key, "embedding"])

    return rows.select(key, text).mapInArrow(of, f"`{key}` string, embedding array<float>")


def project(rows: DataFrame, key: str, vector: str, components: int = 2, model_path: str | None = None) -> DataFrame:
    """(key, x, y): principal components of the vectors, from a model that is fitted on them and, with ``model_path``, kept. It is a
    linear projection, unlike neighbour-graph embeddings."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector

    ready = rows.where(F.col(vector).isNotNull()).select(key, array_to_vector(F.col(vector).cast("array<double>")).alias("v"))
    model = PCA(k=components, inputCol="v", outputCol="p").fit(ready)
    if model_path:
        model.write().overwrite().save(model_path)
    return _placed(model, ready, key)


def project_more(rows: DataFrame, key: str, vector: str, model_path: str, saved: DataFrame | None = None) -> DataFrame:
    """(key, x, y) of rows by a kept model; of ``saved`` coordinates those of other rows are kept and those of these rows replaced."""
    from pyspark.ml.feature import PCAModel
    from pyspark.ml.functions import array_to_vector

    ready = rows.where(F.col(vector).isNotNull()).select(key, array_to_vector(F.col(vector).cast("array<double>")).alias("v"))
    fresh = _placed(PCAModel.load(model_path), ready, key)
    return fresh if saved is None else saved.join(fresh.select(key), key, "left_anti").select(*fresh.columns).unionByName(fresh)


def _placed(model, ready: DataFrame, key: str) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    p = vector_to_array(F.col("p"))
    return model.transform(ready).select(key, F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))


def lookup(inputs: DataFrame, papers: DataFrame, key: str = "input_id", uid: str = "paper_uid", index: DataFrame | None = None) -> DataFrame:
    """(key, uid, status) of each input row: its paper by DOI (as written, normal, and as an address), then by exact title, then the
    first by BM25 of the titles, which counts as the same if only case, accents and signs differ, else as a candidate.

    Status: matched_doi, matched_title, candidate or missing. Each stage sees only what the stages before left over. Of several papers
    with one DOI or title the smallest uid is taken."""
    by = lambda name, c: papers.select(c.alias(name), F.col(uid)).where(F.col(name) != "").groupBy(name).agg(F.min(uid).alias(f"_{name}"))
    stored = F.coalesce(F.col("doi"), F.lit(""))
    trimmed = lambda c: X.trim_all(X.as_text(F.col(c)))
    rows = inputs.select(key, trimmed("doi").alias("raw"), X.typed_doi(F.col("doi")).alias("norm"), trimmed("title").alias("title")).withColumn("url", F.when(F.col("norm") != "", F.concat(F.lit("https://doi.org/"), "norm")).otherwise(""))
    done, rest = None, rows
    for name, c in (("raw", stored), ("norm", stored), ("url", stored), ("title", F.coalesce(F.col("title"), F.lit("")))):
        joined = rest.join(by(name, c), name, "left")
        hit = joined.where(F.col(f"_{name}").isNotNull()).select(key, F.col(f"_{name}").alias(uid), F.lit("matched_title" if name == "title" else "matched_doi").alias("status"))
        done = hit if done is None else done.unionAll(hit)
        rest = joined.where(F.col(f"_{name}").isNull()).select(key, "raw", "norm", "url", "title")
    found = bm25_top(rest.where("title <> ''"), papers, key, "title", uid, "title", index=index).join(papers.groupBy(uid).agg(F.min("title").alias("_their")), uid)
    last = rest.select(key, "title").join(found, key, "left")
    same = X.plain_title(F.col("title")) == X.plain_title(F.col("_their"))
    return done.unionAll(last.select(key, uid, F.when(F.col(uid).isNull(), "missing").when(same, "matched_title").otherwise("candidate").alias("status")))


def similarity(inputs: DataFrame, papers: DataFrame, found: DataFrame, key: str = "input_id", uid: str = "paper_uid") -> DataFrame:
    """Found rows with the mean of the scores that can be told (title and author token sets, DOI, year, source; 0 if none can) and
    whether the sources differ. Typed cells are trimmed first."""
    left = inputs.select(key, *(X.trim_all(X.as_text(F.col(c))).alias(f"i_{c}") for c in ("title", "doi", "year", "source", "authors")))
    right = papers.select(uid, *(F.col(c).alias(f"p_{c}") for c in ("title", "doi", "year", "source", "authors"))).dropDuplicates([uid])
    both = found.where(F.col(uid).isNotNull()).join(left, key).join(right, uid)
    i, p = (lambda c: F.col(f"i_{c}")), (lambda c: F.col(f"p_{c}"))
    there = lambda c: F.coalesce(c, F.lit("")) != ""
    known = lambda a, b, score: F.when(there(a) & there(b), score)
    equal = lambda a, b: F.when(a == b, 1.0).otherwise(0.0)
    place = lambda c: F.lower(X.trim_all(X.as_text(c)))
    names = F.array_join(F.filter(F.coalesce(p("authors"), F.array().cast("array<string>")), there), ", ")
    score = X.mean_of_known(
        known(i("title"), p("title"), X.jaccard(X.plain_tokens(i("title")), X.plain_tokens(p("title")))), known(i("doi"), p("doi"), equal(X.typed_doi(i("doi")), X.typed_doi(p("doi")))),
        known(i("year"), p("year").cast("string"), equal(i("year"), p("year").cast("string"))), known(i("source"), p("source"), equal(place(i("source")), place(p("source")))),
        known(i("authors"), names, X.jaccard(X.plain_tokens(i("authors")), X.plain_tokens(names))),
    )
    differs = there(i("source")) & there(p("source")) & (place(i("source")) != place(p("source")))
    return both.select(key, uid, "status", F.round(F.coalesce(score, F.lit(0.0)), 4).alias("similarity"), differs.alias("source_mismatch"))


#: The order of statuses in a list of results.
STATUS_RANK = {"matched_doi": 0, "matched_title": 1, "candidate": 2, "missing": 3}


def results_in_order(scored: DataFrame, key: str = "input_id") -> DataFrame:
    """Results to look at first: other sources, then by status, then by similarity."""
    rank = F.coalesce(*(F.when(F.col("status") == s, n) for s, n in STATUS_RANK.items()), F.lit(9))
    return scored.orderBy(F.desc("source_mismatch"), rank, F.desc("similarity"), key)


def lookup_counts(found: DataFrame, scored: DataFrame) -> DataFrame:
    """One row: inputs, matched, candidate, missing and source_mismatch."""
    status = F.col("status")
    one = found.agg(F.count("*").alias("inputs"), F.count_if(status.isin("matched_doi", "matched_title")).alias("matched"), F.count_if(status == "candidate").alias("candidate"), F.count_if(status == "missing").alias("missing"))
    return one.join(F.broadcast(scored.agg(F.count_if("source_mismatch").alias("source_mismatch"))))


def export(inputs: DataFrame, papers: DataFrame, found: DataFrame, scored: DataFrame, key: str = "input_id", uid: str = "paper_uid") -> DataFrame:
    """The table of results as it is exported: status, source_mismatch, similarity, five fields of either side, and the uid."""
    text = lambda c: X.trim_all(X.as_text(c))
    left = inputs.select(key, *(text(F.col(c)).alias(f"csv_{c}") for c in ("title", "doi", "source", "year", "authors")))
    right = papers.dropDuplicates([uid]).select(uid, *((F.array_join(F.filter(F.coalesce("authors", F.array().cast("array<string>")), lambda a: a != ""), ", ") if c == "authors" else X.as_text(F.col(c))).alias(f"match_{c}") for c in ("title", "doi", "source", "year", "authors")))
    wide = found.join(scored.select(key, "similarity", "source_mismatch"), key, "left").join(left, key).join(right, uid, "left")
    sides = [f"{s}_{c}" for s in ("csv", "match") for c in ("title", "doi", "source", "year", "authors")]
    return wide.select(key, "status", F.coalesce("source_mismatch", F.lit(False)).alias("source_mismatch"), F.coalesce("similarity", F.lit(0.0)).alias("similarity"), *(F.coalesce(c, F.lit("")).alias(c) for c in sides), F.coalesce(uid, F.lit("")).alias(uid))
