"""Problem 1: records of two tables that describe the same papers, without a common key.

Candidates come from MinHash bands across attributes: two MinHash values of the title's trigrams with one of the family names,
or five of the title's alone. Each candidate pair gets similarity features of title, year and authors. What they mean is learned: a
bounded sample of pairs is labelled weakly by another view, the words of the abstracts, where both records have one and these agree or
differ clearly; all other pairs stay unlabelled. Gradient-boosted trees are fitted on one half of the labelled pairs, and Platt scaling
on the other half turns their scores into probabilities. The one rule before the classifier: records that both name authors, but none
in common, even with typing errors, are no pair. No rule stands behind it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import fingerprints as fp
from . import records, text
from .graph import stage

TITLE_HASHES, NAME_BANDS, TITLE_BANDS, TITLE_ROWS = 25, 8, 5, 5
HAMMING = 26
RUN = 256
#: Names whose codes a task keeps at hand.
KNOWN = 100_000
#: At most about so many labelled pairs are used to fit the classifier and its calibration.
TRAINING_PAIRS = 10_000
FEATURES = ("missing_a", "missing_b", "typos", "names_min", "names_max", "no_names", "apart", "no_year", "short", "cut", "follows", "named")
#: Abstracts are compared if both have so many different words; from the first share of the fewer words in common on they tell one
#: paper, up to the second two papers, and between them nothing.
LEAST_WORDS, ALIKE, UNLIKE = 15, 0.8, 0.45
#: Trees of the classifier, their depth, and how much of each is taken.
ROUNDS, DEPTH, RATE = 60, 3, 0.2
_LONG = re.compile(r"[^\W\d_]{4,}")


def _minhash(hashes: np.ndarray, counts: np.ndarray, functions: int, seed: int) -> np.ndarray:
    """(functions, texts): the smallest value of each hash function over each text's hashes; the largest number where none."""
    out = np.full((functions, len(counts)), np.iinfo(np.uint64).max, dtype=np.uint64)
    some = counts > 0
    if some.any():
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])[some]
        for k in range(functions):
            out[k, some] = np.minimum.reduceat(fp.mix(hashes + np.uint64((seed * 1000 + k) * 7919 + 1)), starts)
    return out


def _bands(side: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[int]] = {}
        for batch in batches:
            titles = batch.column("title_key").to_pylist()
            names = [[x.partition("|")[0] for x in n.split()] for n in batch.column("names").to_pylist()]
            ids = np.asarray(batch.column("rep"))
            t = _minhash(*fp.grams(titles), TITLE_HASHES, 1)
            n = _minhash(fp.hash_strings([x for ns in names for x in ns]), np.array([len(ns) for ns in names], dtype=np.int64), NAME_BANDS, 2)
            named = np.array([bool(ns) and bool(x) for ns, x in zip(names, titles)])
            long = np.array([x.count(" ") + 1 >= records.SHORT_TITLE for x in titles])
            title, years = np.asarray(batch.column("fp")), np.asarray(batch.column("year"))
            codes = [fp.name_codes(n, known) for n in batch.column("names").to_pylist()]
            keys, rows = [], []
            for k in range(NAME_BANDS):
                keys.append(fp.mix(t[2 * k] ^ fp.mix(t[2 * k + 1] ^ fp.mix(n[k] + np.uint64(k))))[named])
                rows.append(np.nonzero(named)[0])
            for k in range(TITLE_BANDS):
                key = np.full(len(titles), 1000 + k, dtype=np.uint64)
                for r in range(TITLE_ROWS):
                    key = fp.mix(key ^ t[k * TITLE_ROWS + r])
                keys.append(key[long])
                rows.append(np.nonzero(long)[0])
            at = np.concatenate(rows)
            # rows of a band of names have one in common; only those of the title's bands have to tell whose they are
            who = pa.array(codes, pa.list_(pa.int64())).take(pa.array(np.concatenate(rows[NAME_BANDS:])))
            who = pa.concat_arrays([pa.array([[]] * (len(at) - len(who)), who.type), who])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), pa.array(title[at]), pa.array(ids[at]), pa.array(np.full(len(at), side, dtype=np.int8)), pa.array(years[at]), who], names=["key", "fp", "id", "side", "year", "who"]
            )
            if len(known) > KNOWN:
                known.clear()

    return of


def candidates(left: DataFrame, right: DataFrame, hamming: int = HAMMING, run: int = RUN) -> DataFrame:
    """Distinct pairs (a, b) of contents of ``left`` and ``right`` that share a band and have close title fingerprints, without those
    whose names, known on both sides, have none in common for sure: their number grows with the square of the contents."""
    schema = "key long, fp long, id long, side byte, year short, who array<long>"
    one = left.select("rep", "fp", "title_key", "names", "year").mapInArrow(_bands(0), schema)
    two = right.select("rep", "fp", "title_key", "names", "year").mapInArrow(_bands(1), schema)

    def of(batches):
        return fp.pairs_of_sorted(batches, hamming, run, True, whole=True, years_apart=records.YEARS_APART)

    return one.unionAll(two).repartition("key").sortWithinPartitions("key", "fp", "id").mapInArrow(of, "a long, b long").distinct()


def compare(ta: str, na: str, ya: int, tb: str, nb: str, yb: int) -> tuple[float, ...] | None:
    """The ``FEATURES`` of a pair of normal records. None if both have names and none in common: another paper, whatever its title."""
    wa, wb, la, lb = ta.split(), tb.split(), na.split(), nb.split()
    shared = text.names_shared(la, lb) if la and lb else 0
    if la and lb and not shared:
        return None
    more_a, more_b, typos, cut = text.title_difference(wa, wb)
    few, many = min(len(la), len(lb)), max(len(la), len(lb))
    return (
        float(min(more_a, 4)),
        float(min(more_b, 4)),
        typos / max(1, min(len(wa), len(wb))),
        shared / few if few else 0.5,
        shared / many if few else 0.5,
        float(not few),
        float(min(abs(ya - yb), 4)) if ya and yb else 0.5,
        float(not (ya and yb)),
        float(min(len(wa), len(wb)) < records.SHORT_TITLE),
        float(cut),
        float(text.follows(wa, wb)),
        float(min(few, 4)),
    )


def weak_label(a: str | None, b: str | None) -> int:
    """1 or 0 where the words of two abstracts clearly agree or differ, -1 where they tell nothing."""
    x, y = set(_LONG.findall(text.fold(a or ""))), set(_LONG.findall(text.fold(b or "")))
    if min(len(x), len(y)) < LEAST_WORDS:
        return -1
    share = len(x & y) / min(len(x), len(y))
    return 1 if share >= ALIKE else 0 if share <= UNLIKE else -1


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols = [batch.column(n).to_pylist() for n in ("ta", "na", "ya", "tb", "nb", "yb")]
        rows = [compare(*x) for x in zip(*cols)]
        some = pa.array([r is not None for r in rows], pa.bool_())
        rows = [r for r in rows if r is not None]
        arrays = [pa.array([r[k] for r in rows], pa.float32()) for k in range(len(FEATURES))]
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(some), batch.column("b").filter(some), *arrays], names=["a", "b", *FEATURES])


def pair_features(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """(a, b, the FEATURES) of candidate pairs, without those whose names have none in common."""
    schema = "a long, b long, " + ", ".join(f"{f} float" for f in FEATURES)
    return records.with_both(pairs, left, right).mapInArrow(_features, schema)


class Boosted:
    """Gradient-boosted trees of a fixed depth for yes and no, over numbers with few different values."""

    def __init__(self, start: float, trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        """trees: (feature of each inner node, threshold, value of each leaf); a row goes right if its number is larger."""
        self.start, self.trees = start, trees

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for feature, threshold, leaf in self.trees:
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > threshold[node])
            out += leaf[node - len(feature)]
        return out

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, ridge: float = 2.0, least: float = 1.0) -> Boosted:
        cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, 33)[:-1])) for k in range(x.shape[1])]
        tests = [(k, c, x[:, k] > c) for k in range(x.shape[1]) for c in cuts[k] if (x[:, k] > c).any()]
        right = np.array([t[2] for t in tests], dtype=np.float64) if tests else np.zeros((0, len(x)))
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        model = Boosted(float(np.log(share / (1 - share))), [])
        score = np.full(len(y), model.start)
        inner = 2**DEPTH - 1
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p)
            feature, threshold, leaf = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf), np.zeros(inner + 1)
            node = np.zeros(len(y), dtype=np.int64)
            for level in range(DEPTH):
                for n in range(2**level - 1, 2 ** (level + 1) - 1):
                    at = node == n
                    if len(tests) and at.sum() > 1:
                        gr, hr = right[:, at] @ g[at], right[:, at] @ h[at]
                        gl, hl = g[at].sum() - gr, h[at].sum() - hr
                        gain = gr**2 / (hr + ridge) + gl**2 / (hl + ridge) - g[at].sum() ** 2 / (h[at].sum() + ridge)
                        gain[(hr < least) | (hl < least)] = 0
                        best = int(gain.argmax())
                        if gain[best] > 1e-6:
                            feature[n], threshold[n] = tests[best][0], tests[best][1]
                node = 2 * node + 1 + (x[np.arange(len(x)), feature[node]] > threshold[node])
            for n in range(inner + 1):
                at = node - inner == n
                leaf[n] = RATE * g[at].sum() / (h[at].sum() + ridge)
            model.trees.append((feature, threshold, leaf))
            score += leaf[node - inner]
        return model


#: Without enough labelled pairs (records without abstracts), weights in the order of ``FEATURES`` and a constant.
DEFAULT = np.array([-4.0, -4.0, -2.0, 3.0, 1.0, 0.0, -1.5, 0.0, 0.0, 0.0, -1.0, 0.0, 0.5])


def platt(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of the probabilities that scores stand for; Platt's targets keep them away from 0 and 1."""
    n1, n0 = y.sum(), (1 - y).sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, c = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * score + c, -30, 30)))
        h = p * (1 - p) + 1e-9
        g = np.array([((t - p) * score).sum() - 1e-3 * (a - 1), (t - p).sum() - 1e-3 * c])
        m = np.array([[(h * score * score).sum() + 1e-3, (h * score).sum()], [(h * score).sum(), h.sum() + 1e-3]])
        d = np.linalg.solve(m, g)
        a, c = a + d[0], c + d[1]
        if np.abs(d).max() < 1e-6:
            break
    return float(a), float(c)


def labelled(features: DataFrame, left: DataFrame, right: DataFrame, papers: tuple[DataFrame, DataFrame], keys: tuple[str, str], abstract: str = "abstract", most: int = TRAINING_PAIRS) -> DataFrame:
    """(FEATURES, label, half) of about ``most`` pairs, chosen by a hash of the pair, that the abstracts of their first records
    label. ``left`` and ``right``: contents with rep and first (id of a record)."""
    total = features.count()
    share = int(min(1.0, most / max(1, total)) * 1_000_000)
    some = features.where(F.pmod(F.xxhash64("a", "b"), F.lit(1_000_000)) < share).limit(2 * most).withColumn("half", F.pmod(F.xxhash64("b", "a"), F.lit(2)))
    for side, (contents, rows, key, of) in enumerate(zip((left, right), papers, keys, ("a", "b"))):
        # the sample has a proven bound, so that the texts are not shuffled
        ids = contents.select(F.col("rep").alias(of), F.col("first").alias(f"_{of}"))
        some = ids.join(F.broadcast(some), of)
        texts = rows.select(F.col(f"`{key}`").alias(f"_{of}"), F.col(f"`{abstract}`").cast("string").alias(f"t{of}")).where(f"t{of} is not null")
        some = texts.join(F.broadcast(some), f"_{of}").dropDuplicates(["a", "b"]).drop(f"_{of}")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = pa.array([weak_label(x, y) for x, y in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist())], pa.int8())
            yield pa.RecordBatch.from_arrays([*(batch.column(f) for f in FEATURES), label, batch.column("half").cast(pa.int8())], names=[*FEATURES, "label", "half"])

    return some.select("ta", "tb", "half", *FEATURES).mapInArrow(of, ", ".join(f"{f} float" for f in FEATURES) + ", label byte, half byte").where("label >= 0")


def fit(sample: DataFrame | None) -> tuple[Boosted | np.ndarray, tuple[float, float]]:
    """(classifier, (slope, offset)) from ``labelled`` pairs, or the default weights if there are too few of a kind."""
    if sample is not None:
        rows = sample.toPandas()
        x, y, half = rows[list(FEATURES)].to_numpy(float), rows["label"].to_numpy(float), rows["half"].to_numpy()
        if all(min((y[half == k] == v).sum() for v in (0, 1)) >= 10 for k in (0, 1)):
            order = np.lexsort((*x.T, y))  # the same model whatever the order of rows
            x, y, half = x[order], y[order], half[order]
            model = Boosted.fit(x[half == 0], y[half == 0])
            return model, platt(model.score(x[half == 1]), y[half == 1])
    return DEFAULT, (1.0, 0.0)


def _score(model: Boosted | np.ndarray, x: np.ndarray) -> np.ndarray:
    return model.score(x) if isinstance(model, Boosted) else x @ model[:-1] + model[-1]


def match(left: DataFrame, right: DataFrame, left_id: str = "row_id", right_id: str = "id", least: float = 0.5, abstract: str = "abstract") -> DataFrame:
    """(left id, right id, confidence) of every pair of records that describes one paper with at least ``least`` confidence.

    Both tables need title, authors and year, which alone decide; ``abstract``, if both have it, labels the sample that the
    classifier is fitted on. Other columns are not read. Copies are compared once and expanded at the end. A record without a
    usable title matches nothing; nulls in other fields count as unknown. Empty tables give no rows."""
    normal = [stage(records.normal_records(df, key), "normal") for df, key in ((left, left_id), (right, right_id))]
    reps = [stage(records.contents(n), "contents") for n in normal]
    features = stage(pair_features(candidates(*reps), *reps), "features")
    sample = labelled(features, *reps, (left, right), (left_id, right_id), abstract) if abstract in left.columns and abstract in right.columns else None
    shared = left.sparkSession.sparkContext.broadcast(fit(sample))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, (slope, offset) = shared.value
        for batch in batches:
            x = np.stack([np.asarray(batch.column(f), dtype=np.float64) for f in FEATURES], axis=1)
            p = 1 / (1 + np.exp(-np.clip(slope * _score(model, x) + offset, -30, 30)))
            kept = pa.array(p >= least)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(kept), batch.column("b").filter(kept), pa.array(p).filter(kept)], names=["a", "b", "confidence"])

    scored = features.mapInArrow(of, "a long, b long, confidence double")
    rows = [n.select(F.col("id").alias(name), F.col("cid").alias(key)).distinct() for n, name, key in ((normal[0], "_left", "a"), (normal[1], "_right", "b"))]
    found = scored.join(rows[0], "a").join(rows[1], "b").groupBy("_left", "_right").agg(F.max("confidence").alias("confidence"))
    return found.select(F.col("_left").alias(left_id), F.col("_right").alias(right_id), "confidence")
