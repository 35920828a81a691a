"""Problem 6: values typed freely mapped to a canonical list, by a symmetric-delete dictionary of the list's words.

The dictionary holds every word of the list and of its long names under each string that is left after deleting up to three letters,
under each of its beginnings, and under its first and last letter for contractions. A typed word finds its words by its own deletions,
as a beginning, or as a contraction; they are ranked by a weighted Damerau-Levenshtein distance, and of equally near ones the more
frequent in the list comes first. Only entries that have such a word are looked at. A value is mapped to the entry whose words, weighted
by how rare they are in the list, it covers best in both directions, ties to the more frequent one; values that cover no entry well
enough are reported as misses.
"""

from __future__ import annotations

import html
import itertools
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import fold

#: Rows that a reference list may have.
MOST_ENTRIES = 50_000
#: Least score (0..1) of a mapping.
LEAST = 0.69
# Words of a venue that name a track of it, and what they are called in the list.
TRACKS = {"short": "short", "shorts": "short", "poster": "posters", "posters": "posters", "companion": "companion", "compan": "companion", "workshop": "workshops", "workshops": "workshops", "wkshp": "workshops", "wkshps": "workshops", "wksp": "workshops"}
# Words that say nothing about which venue is meant.
NOISE = frozenset("proceedings proceeding proc procs in the of on and for a an to at with vol volume no nr issue pp accepted press track paper papers session abstract abstracts annual edition st nd rd th ed eds".split())
# Rows of a keyboard.
_KEYS = ["qwertyuiop", "asdfghjkl", "zxcvbnm"]
_NEAR = {(a, b) for r, row in enumerate(_KEYS) for i, a in enumerate(row) for s in range(-1, 2) if 0 <= r + s < 3 for b in _KEYS[r + s][max(0, i - 1) : i + 2] if a != b}


def deletions(word: str, most: int) -> set[str]:
    """The word and all strings left after deleting up to ``most`` letters."""
    out = {word}
    for n in range(1, min(most, len(word) - 1) + 1):
        out.update("".join(c) for c in itertools.combinations(word, len(word) - n))
    return out


def allowed(length: int) -> int:
    """Edits allowed in a word of a length."""
    return 0 if length < 4 else 1 if length < 6 else 2 if length < 10 else 3


def weighted_distance(a: str, b: str) -> float:
    """Damerau-Levenshtein distance in which swapped letters (0.7), a letter doubled or dropped beside its equal (0.6) and a
    neighbouring key (0.7) cost less than other edits (1)."""
    la, lb = len(a), len(b)
    rows = [[0.0] * (lb + 1) for _ in range(la + 1)]
    for i in range(1, la + 1):
        rows[i][0] = rows[i - 1][0] + 1
    for j in range(1, lb + 1):
        rows[0][j] = rows[0][j - 1] + 1
    for i in range(1, la + 1):
        for j in range(1, lb + 1):
            x, y = a[i - 1], b[j - 1]
            best = rows[i - 1][j - 1] + (0 if x == y else 0.7 if (x, y) in _NEAR else 1)
            best = min(best, rows[i - 1][j] + (0.6 if i > 1 and a[i - 2] == x else 1), rows[i][j - 1] + (0.6 if j > 1 and b[j - 2] == y else 1))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y and x != y:
                best = min(best, rows[i - 2][j - 2] + 0.7)
            rows[i][j] = best
    return rows[la][lb]


def words_of(text: str) -> list[tuple[str, bool]]:
    """(folded word, whether it may be an abbreviation) of a typed value, without numbers, ordinals, years and noise."""
    text = html.unescape(html.unescape(text))
    text = re.sub(r"[’'`](?=[a-zA-Z])", "", fold(text))
    text = re.sub(r"\b\d+\s*(?:st|nd|rd|th)\b", " ", text)
    out = []
    for word, dot in re.findall(r"([^\W_]+)(\.?)", text):
        word = re.sub(r"^\d+|\d+$", "", word) if not word.isdigit() else ""
        if word and word not in NOISE:
            out.append((word, bool(dot)))
    return out


class Dictionary:
    """The canonical entries, ready for look-ups; built from the small reference tables and sent to the tasks once."""

    def __init__(self, entries: list[tuple[str, str]], long_names: list[tuple[str, str]]):
        """entries: (source, dblp_source); long_names: (source, full name)."""
        self.variants: list[tuple[str, tuple[str, ...]]] = []
        self.tracks: dict[str, dict[str, str]] = defaultdict(dict)
        self.own_workshop = set()
        for source, name in entries:
            words = [w for w, _ in words_of(name)]
            track = next((TRACKS[w] for w in words if w in TRACKS and w != fold(source)), "")
            self.tracks[source].setdefault(track, name)
            if not track:
                self.variants.append((source, tuple(words)))
        for source in {s for s, _ in entries}:
            self.variants.append((source, (fold(source),)))
        for source, name in long_names:
            words = tuple(w for w, _ in words_of(name))
            if source in self.tracks:
                self.variants.append((source, words))
                if "workshop" in words:
                    self.own_workshop.add(source)
        self.variants = sorted(set(self.variants))
        # how many sources use a word, and from it the weight of the word
        use = Counter(w for w, _ in {(w, s) for s, ws in self.variants for w in ws})
        n = max(1, len(self.tracks))
        self.weight = {w: max(0.15, math.log((n + 1) / c) / math.log(n + 1)) for w, c in use.items()}
        self.use = use
        self.acronyms = {fold(s) for s in self.tracks}
        self.frequency = Counter(s for s, _ in entries)
        self.index: dict[str, set[str]] = defaultdict(set)
        self.beginnings: dict[str, set[str]] = defaultdict(set)
        self.ends: dict[str, set[str]] = defaultdict(set)
        self.longest = max([*map(len, use), *map(len, TRACKS)])
        for w in [*use, *TRACKS]:
            for d in deletions(w, allowed(len(w))):
                self.index[d].add(w)
        for w in use:
            if w not in self.acronyms:
                for k in range(1, len(w) + 1):
                    self.beginnings[w[:k]].add(w)
                self.ends[w[0] + w[-1]].add(w)
        # which variants have a word
        self.having: dict[str, list[int]] = defaultdict(list)
        for n, (_, words) in enumerate(self.variants):
            for w in set(words):
                self.having[w].append(n)
        self.memo: dict[tuple[str, bool], dict[str, float]] = {}

    def near(self, word: str, dotted: bool) -> dict[str, float]:
        """List words that a typed word may stand for, with a similarity, the best first."""
        key = (word, dotted)
        if key in self.memo:
            return self.memo[key]
        out: dict[str, float] = {}
        # a word longer than the longest one by more than the edits allowed is near to none
        if len(word) <= self.longest + 3:
            for w in set().union(*(self.index.get(d, ()) for d in deletions(word, min(allowed(len(word) + 1), 3)))):
                distance = weighted_distance(word, w)
                if distance <= allowed(max(len(w), len(word))) and (len(w) > 3 or distance == 0):
                    out[w] = 1 - 0.8 * distance / max(len(w), len(word))
        found: dict[str, float] = {}
        if len(word) <= self.longest:
            if len(word) >= 3 or dotted or len(word) == 1:
                found.update(dict.fromkeys(self.beginnings.get(word, ()), 0.9 if len(word) > 1 else 0.7))
            if len(word) >= 3:
                for w in self.ends.get(word[0] + word[-1], ()):
                    if len(w) > len(word) and w not in found and _inside(word, w):
                        found[w] = 0.8
        for k in range(4, min(len(word), self.longest + 1)):
            if word[:k] in self.use and word[:k] not in self.acronyms:
                found[word[:k]] = 0.9
        for w, s in found.items():
            if w != word:
                out[w] = max(out.get(w, 0), s)
        out = dict(sorted(out.items(), key=lambda x: (-x[1], -self.use.get(x[0], 0), x[0])))
        if len(self.memo) < 100_000:
            self.memo[key] = out
        return out

    def find(self, typed: str) -> tuple[str, str, float]:
        """(source, dblp_source, score); empty strings for a miss."""
        words = words_of(typed)
        near = [self.near(w, d) for w, d in words]
        best = (0.0, 0, "", frozenset())
        for n in sorted({n for ws in near for w in ws for n in self.having.get(w, ())}):
            source, variant = self.variants[n]
            score, used = self._cover(words, near, variant)
            if score > best[0] + 1e-9 or (score > best[0] - 1e-9 and self.frequency[source] > best[1]):
                best = (score, self.frequency[source], source, used)
        score, _, source, used = best
        if score < LEAST:
            return "", "", score
        tracks = [TRACKS[w] for i in range(len(words)) if i not in used and (w := self._track(words[i][0], near[i]))]
        tracks = [t for t in tracks if not (t == "workshops" and source in self.own_workshop and t not in self.tracks[source])]
        known = self.tracks[source]
        track = next((t for t in tracks if t in known), None)
        if track is None:
            track = "" if not tracks else None
        if track is None or track not in known:
            return "", "", score
        return source, known[track], score

    @staticmethod
    def _track(word: str, near: dict[str, float]) -> str:
        if word in TRACKS:
            return word
        hits = [(s, w) for w, s in near.items() if w in TRACKS]
        return max(hits)[1] if hits and max(hits)[0] >= 0.7 else ""

    def _cover(self, words, near, variant) -> tuple[float, frozenset]:
        """How well the typed words and the variant's words cover each other, and which typed words take part."""
        acronym = len(variant) == 1 and variant[0] in self.acronyms
        whole = sum(self.weight.get(w, 1) for w in variant)
        got, used = 0.0, set()
        for w in variant:
            at = max(((near[i].get(w, 0), -i) for i in range(len(words)) if i not in used), default=(0, 0))
            if at[0] > 0:
                got += at[0] * self.weight.get(w, 1)
                used.add(-at[1])
        if not got or not whole:
            return 0.0, frozenset()
        here = got / whole
        if acronym:
            # other words do not count against an acronym unless they are another venue's
            return (here * 0.99 if here >= 0.8 else here * 0.7), frozenset(used)
        rest = 0.0
        for i, (w, _) in enumerate(words):
            if i not in used and not self._track(w, near[i]) and w not in self.acronyms:
                known = max((self.weight.get(x, 1) * s for x, s in near[i].items()), default=0.0)
                rest += known if known else (1.0 if len(w) > 2 else 0.3)
        there = got / (got + rest)
        return 2 * here * there / (here + there), frozenset(used)


def _inside(short: str, long: str) -> bool:
    rest = iter(long)
    return all(c in rest for c in short)


def _bounded(table: DataFrame, *columns: str) -> list[tuple[str, str]]:
    got = table.select(*columns).dropna().distinct().limit(MOST_ENTRIES + 1).collect()
    if len(got) > MOST_ENTRIES:
        raise ValueError(f"a reference list has more than {MOST_ENTRIES} rows")
    return [tuple(r) for r in got]


def map_values(values: DataFrame, column: str, entries: DataFrame, long_names: DataFrame) -> DataFrame:
    """(value, source, dblp_source, score) of each distinct value of ``column`` that is not null or blank.

    ``entries`` (source, dblp_source) and ``long_names`` (abrv, full_name) are reference lists of at most ``MOST_ENTRIES`` rows each,
    which is checked; they are sent to the tasks. A longer list ends the query: cut it into lists and keep each value's best score. A
    miss has empty strings. Of entries that fit alike, the most frequent and then the first by source is taken."""
    rows = _bounded(entries, "source", "dblp_source")
    names = _bounded(long_names, "abrv", "full_name")
    shared = values.sparkSession.sparkContext.broadcast((sorted(rows), sorted(names)))

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        dictionary = Dictionary(*shared.value)
        for batch in batches:
            found = [dictionary.find(v) for v in batch["value"]]
            yield pd.DataFrame({"value": batch["value"], "source": [f[0] for f in found], "dblp_source": [f[1] for f in found], "score": [f[2] for f in found]})

    distinct = values.select(F.col(f"`{column}`").alias("value")).where(F.col("value").rlike(r"(?U)\S")).distinct()
    # looking values up is costly, so they are spread over all tasks however few bytes they have
    spread = distinct.repartition(int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return spread.mapInPandas(of, "value string, source string, dblp_source string, score double")


def map_column(rows: DataFrame, id_column: str, column: str, entries: DataFrame, long_names: DataFrame) -> DataFrame:
    """p6: (id, source, dblp_source) of every row whose ``column`` is not null or blank. Each distinct value is looked up once."""
    found = map_values(rows, column, entries, long_names)
    return rows.select(F.col(id_column), F.col(f"`{column}`").alias("value")).join(found, "value").select(id_column, "source", "dblp_source")


def misses(rows: DataFrame, column: str, entries: DataFrame, long_names: DataFrame) -> DataFrame:
    """(value, n, score): the values without an entry, how many rows have them and how near the best entry was."""
    found = map_values(rows, column, entries, long_names).where("source = ''")
    counts = rows.groupBy(F.col(f"`{column}`").alias("value")).agg(F.count("*").alias("n"))
    return counts.join(found, "value").select("value", "n", "score")
