"""Problem 7: encoding of a corpus with a public byte-level BPE tokenizer; long texts in parallel, by tree concatenation.

Texts are cut into leaves before blanks that follow something else: there the splitting pattern always has a boundary, so leaves
on both sides can be encoded alone. A stretch without any such place that is longer than a leaf is cut anywhere, its halves are
encoded in parallel and joined pairwise: the pieces of the pattern at the join are split anew, and where one long piece was
cut, a window of tokens around the join is re-encoded and grown until it begins with the left side's token and ends with the
right side's. Two neighbouring tokens that encode together as themselves are compatible, and a sequence whose neighbours are
all compatible is the encoding of its text; so the result is exact.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of a leaf.
LEAF = 16_384
# Fixed value: the splitting pattern of the public byte-level BPE vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_PIECES = regex.compile(PATTERN)


def vocabulary(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Path of an installed public vocabulary."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def encoder(path: str):
    """The encoder of a vocabulary file of ranks, once per Python worker."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def leaves(text: str, leaf: int = LEAF) -> list[tuple[str, bool]]:
    """(part, whether the cut before it is free) of a text. A free cut lies where a blank followed by a non-blank follows a
    non-blank: the pattern has a boundary there whatever stands around it."""
    out: list[tuple[str, bool]] = []
    at, free, n = 0, True, len(text)
    while n - at > leaf:
        end = at + leaf
        cut = None
        back = text.rfind(" ", at + 1, end)
        while back > at:
            if not text[back - 1].isspace() and not text[back + 1].isspace():
                cut = back
                break
            back = text.rfind(" ", at + 1, back)
        if cut is None:
            hard = end
            out.append((text[at:hard], free))
            at, free = hard, False
        else:
            out.append((text[at:cut], free))
            at, free = cut, True
    out.append((text[at:], free))
    return out


def _pieces(enc, text: str) -> list[tuple[str, list[int]]]:
    return [(p, enc.encode_ordinary(p)) for p in _PIECES.findall(text)]


def _compatible(enc, a: list[int], b: list[int]) -> list[int]:
    """The encoding of the concatenation of two encoded halves of one piece."""
    k = 1
    while True:
        left, right = a[max(0, len(a) - k) :], b[:k]
        window = enc._encode_single_piece(b"".join(enc.decode_tokens_bytes(left + right)))
        ok_left = k >= len(a) or window[0] == left[0]
        ok_right = k >= len(b) or window[-1] == right[-1]
        if ok_left and ok_right:
            return a[: max(0, len(a) - k)] + list(window) + b[k:]
        k *= 2


def join(enc, left: list[tuple[str, list[int]]], right: list[tuple[str, list[int]]]) -> list[tuple[str, list[int]]]:
    """Pieces of the concatenation of two texts from the pieces of both, where the cut between them was not free."""
    if not left or not right:
        return left + right
    left, right = list(left), list(right)
    # pieces that reach back over blanks may change with what follows: split anew from the last piece that begins with no blank
    start = len(left) - 1
    while start > 0 and left[start][0].isspace():
        start -= 1
    # an apostrophe of its own and one letter may be the first two signs of 're, 've or 'll
    if start > 0 and left[start - 1][0] == "'":
        start -= 1
    head, n = left[start:], 1
    while True:
        joined = "".join(p for p, _ in head) + "".join(p for p, _ in right[:n])
        # what follows stays in sight; from a boundary that both splittings share, they agree
        split, at = [], 0
        for p in _PIECES.findall(joined + "".join(p for p, _ in right[n : n + 2])):
            if at >= len(joined):
                break
            split.append(p)
            at += len(p)
        if at == len(joined) or n >= len(right):
            break
        n += 1
    middle = right[:n]
    known = {p: t for p, t in head + middle}
    out = []
    for p in split:
        if p in known:
            out.append((p, known[p]))
        elif p == head[-1][0] + middle[0][0]:
            out.append((p, _compatible(enc, head[-1][1], middle[0][1])))
        else:
            out.append((p, enc.encode_ordinary(p)))
    return left[:start] + out + right[n:]


def encode_parts(enc, parts: list[tuple[str, bool]]) -> list[int]:
    """The ids of a text from its leaves; leaves after a cut that was not free are joined as a tree."""
    return concatenate(enc, [(_pieces(enc, t) if not free or (i + 1 < len(parts) and not parts[i + 1][1]) else [("", enc.encode_ordinary(t))], free) for i, (t, free) in enumerate(parts)])


def concatenate(enc, encoded: list[tuple[list[tuple[str, list[int]]], bool]]) -> list[int]:
    """Joins encoded leaves: free cuts by mere concatenation, the others pairwise in a tree."""
    ids: list[int] = []
    run: list[list[tuple[str, list[int]]]] = []

    def flush():
        level = run
        while len(level) > 1:
            level = [join(enc, level[i], level[i + 1]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
        for piece in level[0] if level else []:
            ids.extend(piece[1])

    for pieces, free in encoded:
        if free and run:
            flush()
            run = []
        run.append(pieces)
    flush()
    return ids


def _leaf_rows(leaf: int):
    """Leaves of long texts, one row each."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                parts = leaves(text, leaf)
                n = len(parts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i] * n, pa.int64()),
                        pa.array(range(n), pa.int32()),
                        pa.array([p for p, _ in parts]),
                        pa.array([f for _, f in parts]),
                        pa.array([not f or (k + 1 < n and not parts[k + 1][1]) for k, (_, f) in enumerate(parts)]),
                    ],
                    names=["id", "n", "part", "free", "joined"],
                )

    return of


def _encode_leaves(path: str):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            ends, ids = [], []
            for part, joined in zip(batch.column("part").to_pylist(), batch.column("joined").to_pylist()):
                if joined:
                    pieces = _pieces(enc, part)
                    ids.append([t for _, ts in pieces for t in ts])
                    ends.append([v for p, ts in pieces for v in (len(p), len(ts))])
                else:
                    ids.append(enc.encode_ordinary(part))
                    ends.append([])
            keep = [p if j else None for p, j in zip(batch.column("part").to_pylist(), batch.column("joined").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n"), pa.array(keep, pa.string()), batch.column("free"), pa.array(ids, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32()))], names=["id", "n", "part", "free", "ids", "ends"]
            )

    return of


def _assemble(path: str):
    def of(table: pa.Table) -> pa.Table:
        enc = encoder(path)
        encoded = []
        for row in sorted(table.to_pylist(), key=lambda r: r["n"]):
            if row["part"] is None:
                encoded.append(([("", row["ids"])], row["free"]))
                continue
            pieces, c, t = [], 0, 0
            for chars, count in zip(row["ends"][::2], row["ends"][1::2]):
                pieces.append((row["part"][c : c + chars], row["ids"][t : t + count]))
                c, t = c + chars, t + count
            encoded.append((pieces, row["free"]))
        ids = concatenate(enc, encoded)
        return pa.table([pa.array([table.column("id")[0].as_py()], pa.int64()), pa.array([ids], pa.list_(pa.int32()))], names=["id", "ids"])

    return of


def _encode_short(path: str):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            ids = [enc.encode_ordinary(t) if t else [] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(ids, pa.list_(pa.int32()))], names=["id", "ids"])

    return of


def encode(documents: DataFrame, id_column: str = "doc_id", text: str = "text", path: str | None = None, leaf: int = LEAF) -> DataFrame:
    """(id, ids): the token ids of each text, without special tokens; an empty list for an empty or null text.

    Ids are unique. Only texts longer than a leaf are shuffled; other columns are not read."""
    path = path or vocabulary()
    rows = documents.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    long = F.coalesce(F.length("text") > leaf, F.lit(False))
    short = rows.where(~long).mapInArrow(_encode_short(path), "id long, ids array<int>")
    parts = rows.where(long).mapInArrow(_leaf_rows(leaf), "id long, n int, part string, free boolean, joined boolean").repartition("id", "n")
    done = parts.mapInArrow(_encode_leaves(path), "id long, n int, part string, free boolean, ids array<int>, ends array<int>")
    whole = done.groupBy("id").applyInArrow(_assemble(path), "id long, ids array<int>")
    return short.unionAll(whole).select(F.col("id").alias(id_column), "ids")


def token_counts(documents: DataFrame, id_column: str = "doc_id", text: str = "text", path: str | None = None, leaf: int = LEAF) -> DataFrame:
    """(id, tokens): how many tokens each text has."""
    return encode(documents, id_column, text, path, leaf).select(id_column, F.size("ids").alias("tokens"))
