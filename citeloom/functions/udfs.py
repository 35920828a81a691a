"""The few functions that Spark lacks, as Arrow-batched UDFs."""

from __future__ import annotations

import difflib
import html
import unicodedata
import zlib
from functools import lru_cache

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Similarity of two texts by their longest matching blocks; 1.0 for equal texts, 0.0 if one is null."""
    return pd.Series([1.0 if x == y and x is not None else 0.0 if x is None or y is None else difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)])


@F.pandas_udf(T.StringType())
def resolve_entities(c: pd.Series) -> pd.Series:
    """Named and numbered HTML entities resolved."""
    return c.map(lambda x: html.unescape(x) if x is not None else None)


@F.pandas_udf(T.StringType())
def plain_ascii(c: pd.Series) -> pd.Series:
    """Lower case, accents off, all but a-z and 0-9 as single blanks."""

    def one(x):
        if x is None:
            return None
        x = "".join(ch for ch in unicodedata.normalize("NFKD", x.lower()) if not unicodedata.combining(ch))
        return " ".join("".join(ch if ch.isascii() and ch.isalnum() else " " for ch in x).split())

    return c.map(one)


# Titles longer than LONG signs have pieces of PIECE signs at any place, so that their keys stay proportional to their length.
LONG, PIECE = 400, 24


def _edits(total: int) -> int:
    """Signs that may be left out or put in between two texts of ``total`` signs together whose sequence_ratio is 0.985 or more."""
    return int(0.015 * total + 1e-9)


@lru_cache(maxsize=4096)
def _pieces(m: int) -> list[tuple[int, int]]:
    """One disjoint piece more of a text of m signs than edits that any partner allows: one piece is whole in each partner."""
    n = m
    while n + 1 - m <= _edits(n + 1 + m):
        n += 1
    k = _edits(n + m) + 1
    return [(i * m // k, (i + 1) * m // k) for i in range(k)] if m <= LONG else [(i * PIECE, (i + 1) * PIECE) for i in range(k)]


@lru_cache(maxsize=4096)
def _windows(n: int) -> tuple[list[tuple[int, int, int, int]], bool]:
    """(length of the partner, number of its piece, start, end) where its pieces can lie in a text of n signs; if partners can be long."""
    out, low = [], n
    while low > 1 and n - (low - 1) <= _edits(n + low - 1):
        low -= 1
    m = low
    while m <= n or m - n <= _edits(n + m):
        if m > LONG:
            return out, True
        more, most = n - m, _edits(n + m)
        for s, (p, q) in enumerate(_pieces(m)):
            out += [(m, s, p + d, q + d) for d in range(-most, most + 1) if abs(d) + abs(more - d) <= most and p + d >= 0 and q + d <= n]
        m += 1
    return out, False


def _key(m: int, s: int, piece: bytes) -> int:
    return m << 44 | s << 32 | zlib.crc32(piece)


@F.pandas_udf(T.ArrayType(T.LongType()))
def piece_keys(c: pd.Series) -> pd.Series:
    """Keys of a text's pieces; see ``window_keys``."""
    raw = (x.encode() for x in c)
    return pd.Series([[_key(*((len(x), s) if len(x) <= LONG else (LONG + 1, 0)), x[p:q]) for s, (p, q) in enumerate(_pieces(len(x)))] for x in raw])


@F.pandas_udf(T.ArrayType(T.LongType()))
def window_keys(c: pd.Series) -> pd.Series:
    """Keys of all places where a partner's pieces can lie: two ASCII texts with a sequence_ratio of 0.985 or more share one of
    these of the one with one of the ``piece_keys`` of the other."""

    def one(x):
        places, long = _windows(len(x))
        keys = {_key(m, s, x[p:q]) for m, s, p, q in places}
        if long:
            keys |= {_key(LONG + 1, 0, x[p : p + PIECE]) for p in range(len(x) - PIECE + 1)}
        return list(keys)

    return pd.Series([one(x.encode()) for x in c])
