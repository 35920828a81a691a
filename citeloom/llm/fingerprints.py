"""Bit-difference fingerprints of short strings and their block tables, computed with numpy over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_MIX1, _MIX2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)

#: Comparisons of a crowded run that are held at once.
SLICE = 2_000_000


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64: a well-spread 64-bit hash of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + _STEP
        x = (x ^ (x >> np.uint64(30))) * _MIX1
        x = (x ^ (x >> np.uint64(27))) * _MIX2
        return x ^ (x >> np.uint64(31))


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the character trigrams of each text (its ends marked), and the number of trigrams of each text."""
    raw = [t.encode() for t in texts]
    counts = np.array([len(r) for r in raw], dtype=np.int64)
    buf = np.frombuffer(b"".join(b"\x01" + r + b"\x02" for r in raw) + b"\x00\x00", dtype=np.uint8).astype(np.uint32)
    codes = (buf[:-2] << 16) | (buf[1:-1] << 8) | buf[2:]
    starts = np.concatenate([[0], np.cumsum(counts + 2)[:-1]]) if len(raw) else np.zeros(0, np.int64)
    at = np.repeat(starts - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    return mix(codes[at]), counts


def fingerprint(texts: list[str], bits: int = 64) -> np.ndarray:
    """Similarity-preserving fingerprint: each bit is the majority of that bit over the text's trigrams. 0 for an empty text."""
    hashes, counts = grams(texts)
    out = np.zeros(len(texts), dtype=np.uint64)
    some = counts > 0
    if not some.any():
        return out
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])[some]
    fp = np.zeros(int(some.sum()), dtype=np.uint64)
    for bit in range(bits):
        ones = np.add.reduceat(((hashes >> np.uint64(bit)) & np.uint64(1)).astype(np.int32), starts)
        fp |= (2 * ones > counts[some]).astype(np.uint64) << np.uint64(bit)
    out[some] = fp
    return out


def hash_strings(texts: list[str], seed: int = 0) -> np.ndarray:
    """64-bit hash of each string."""
    from xxhash import xxh3_64_intdigest

    return np.array([xxh3_64_intdigest(t, seed) for t in texts], dtype=np.uint64)


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


_LETTERS = np.uint64((1 << 52) - 1)


def word_code(word: str) -> int:
    """Of a word: which letters it has (26 bits) and has twice (26), its length up to 15 (4), its first and its last letter (4 each).
    A word that is not there has a code of its own, which agrees with no other."""
    at = [ord(c) % 26 for c in word or "jqvwxzjqvwxz"]
    out = min(len(word), 15) << 52 | (at[0] & 15) << 56 | (at[-1] & 15) << 60
    for c in at:
        out |= 1 << (c + 26 if out >> c & 1 else c)
    return out - (out >> 63 << 64)


def name_codes(names: str, known: dict[str, list[int]]) -> list[int]:
    """The codes of family name and other word of each name of a normal record ("family|other", by blanks), and those of the first
    parts of double names with no other word; ``known`` keeps what was made before."""
    out: list[int] = []
    for name in names.split():
        codes = known.get(name)
        if codes is None:
            family, _, other = name.partition("|")
            codes = known[name] = [word_code(family), word_code(other), *(c for part in family.split("-")[:-1] if part for c in (word_code(part), word_code("")))]
        out += codes
    return out


def _agree(a: np.ndarray, b: np.ndarray, families: bool) -> np.ndarray:
    """Whether words of these codes can agree by ``text.words_agree`` or, both being family names, one can be the end of the other."""
    la, lb = ((x >> np.uint64(52)) & np.uint64(15) for x in (a, b))
    short, differ = np.minimum(la, lb), a ^ b
    first, last = ((differ >> np.uint64(k)) & np.uint64(15) == 0 for k in (56, 60))
    more_a, more_b = popcount(a & ~b & _LETTERS), popcount(b & ~a & _LETTERS)
    limit = np.where(short >= 7, 2, 1)
    # an edit takes at most one letter away and puts at most one in
    typo = (first | last) & (more_a <= limit) & (more_b <= limit) & (np.maximum(la, lb) - short <= limit)
    return typo if not families else typo | (last & (short >= 5) & (((la <= lb) & (more_a == 0)) | ((lb <= la) & (more_b == 0))))


def may_share(words: tuple[np.ndarray, np.ndarray, np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of pairs of rows: False only where ``text.names_shared`` of their names is 0 for sure. words: where the codes of each row
    begin, how many they are, and the codes; a row without any can be anybody's."""
    begin, count, codes = words
    out = (count[i] == 0) | (count[j] == 0)
    rest = np.nonzero(~out)[0]
    if not len(rest):
        return out
    n, m = count[i[rest]] // 2, count[j[rest]] // 2
    shape = n.astype(np.int64) << 32 | m
    order = np.argsort(shape, kind="stable")
    cuts = np.nonzero(np.diff(shape[order], prepend=-1))[0]
    for group in np.split(rest[order], cuts[1:]):
        x, y = int(count[i[group[0]]]), int(count[j[group[0]]])
        step = max(1, SLICE // (x * y))
        for s in range(0, len(group), step):
            part = group[s : s + step]
            a, b = codes[begin[i[part]][:, None] + np.arange(x)], codes[begin[j[part]][:, None] + np.arange(y)]
            for u, v, families in ((a[:, ::2], b[:, ::2], True), (a[:, ::2], b[:, 1::2], False), (a[:, 1::2], b[:, ::2], False)):
                mine, other = (u & _LETTERS)[:, :, None], (v & _LETTERS)[:, None, :]
                can = popcount(mine ^ other) <= 4
                if families:
                    both = mine & other
                    can |= (both == mine) | (both == other)
                at, k, h = np.nonzero(can)
                out[part[at[_agree(u[at, k], v[at, h], families)]]] = True
    return out


def pairs_of_sorted(batches: Iterator[pa.RecordBatch], limit: int, most: int, two_sides: bool, whole: bool = False, one_new: bool = False, years_apart: int = 2) -> Iterator[pa.RecordBatch]:
    """Pairs of ids within runs of one key, out of a stream sorted by (key, fp).

    Columns in: key, fp, id and, if ``two_sides`` or ``one_new``, side. Out: a, b (a < b, or with two sides: a of side 0 and b of side
    1) whose fingerprints differ in at most ``limit`` bits; with ``one_new`` at least one of them is of side 1. If there is a column
    year, known ones (not 0) are at most ``years_apart`` apart; if there is a column who (``name_codes``), pairs that share no name
    for sure are left out (``may_share``). With ``whole`` these
    are all pairs of a run: one of more than ``most`` members
    is compared block by block as it arrives, and time grows with the square of its members. Else such a run is not held as a
    whole: each further member, in the order of fingerprints, is compared with the ``most`` members before it and with the run's
    leaders (members that were close to no earlier leader), so that time stays linear, near copies stay linked and pairs that
    are close only to each other can be missed."""
    sided = True  # side and year travel in one number
    keep: list[np.ndarray] | None = None
    who: pa.ListArray | None = None
    words: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None
    run_seen, leaders = 0, None

    def out(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def emit(ids, sides, i, j, base=0):
        year, other = sides[i] >> 1, sides[j] >> 1
        ok = (year == 0) | (other == 0) | (np.abs(year - other) <= years_apart)
        if two_sides:
            ok &= (sides[i] & 1) != (sides[j] & 1)
            i, j = i[ok], j[ok]
            if words is not None and len(i):
                ok = may_share(words, i + base, j + base)
                i, j = i[ok], j[ok]
            swap = (sides[i] & 1) == 1
        else:
            ok &= ids[i] != ids[j]
            if one_new:
                ok &= ((sides[i] | sides[j]) & 1) == 1
            i, j = i[ok], j[ok]
            swap = ids[i] > ids[j]
        return np.where(swap, ids[j], ids[i]), np.where(swap, ids[i], ids[j])

    def within(start, length, ids, fps, sides):
        """All close pairs of the runs given by start and length; runs of one length at a time."""
        res, held, size = [], [], 0
        for n in np.unique(length):
            if n < 2:
                continue
            base = start[length == n]
            x, y = np.triu_indices(int(n), 1)
            step = max(1, 2_000_000 // len(x))
            for s in range(0, len(base), step):
                i = (base[s : s + step, None] + x[None, :]).ravel()
                j = (base[s : s + step, None] + y[None, :]).ravel()
                ok = popcount(fps[i] ^ fps[j]) <= limit
                held.append((i[ok], j[ok]))
                size += len(held[-1][0])
                if size > SLICE:
                    res.append(emit(ids, sides, *(np.concatenate(x) for x in zip(*held))))
                    held, size = [], 0
        if held:
            res.append(emit(ids, sides, *(np.concatenate(x) for x in zip(*held))))
        return res

    def hot(ids, fps, sides, fresh):
        """Members from ``fresh`` on against the members before them, at most ``most`` back."""
        res = []
        for k in range(fresh, len(ids)):
            lo = max(0, k - most)
            near = np.nonzero(popcount(fps[lo:k] ^ fps[k]) <= limit)[0] + lo
            if len(near):
                res.append(emit(ids, sides, near, np.full(len(near), k)))
        return res

    def every(ids, fps, sides, fresh, base):
        """Members from ``fresh`` on against all members before them, a batch of pairs for each slice of comparisons."""
        for lo in range(fresh, len(ids), most):
            new = np.arange(lo, min(lo + most, len(ids)))
            for start in range(0, new[-1], max(1, SLICE // most)):
                old = np.arange(start, min(start + max(1, SLICE // most), new[-1]))
                j, i = np.nonzero((popcount(fps[old][None, :] ^ fps[new][:, None]) <= limit) & (old[None, :] < new[:, None]))
                if len(i):
                    yield out(*emit(ids, sides, old[i], new[j], base))

    for batch in batches:
        cols = [np.asarray(batch.column(n)) for n in ("key", "fp", "id")] + [sum((np.asarray(batch.column(n)).astype(np.int32) << k for k, n in enumerate(("side", "year")) if n in batch.schema.names), np.zeros(batch.num_rows, np.int32))]
        cols[1] = cols[1].view(np.uint64) if cols[1].dtype == np.int64 else cols[1].astype(np.uint64)
        if not len(cols[0]):
            continue
        res = []
        if "who" in batch.schema.names:
            who = batch.column("who") if who is None or keep is None else pa.concat_arrays([who, batch.column("who")])
            ends = np.asarray(who.offsets)
            words = ends[:-1], np.diff(ends), np.asarray(who.values).view(np.uint64)
        if keep is not None:
            cols = [np.concatenate([k, c]) for k, c in zip(keep, cols)]
        old = 0 if keep is None else len(keep[0])
        key = cols[0]
        cut = np.nonzero(np.concatenate([[True], key[1:] != key[:-1]]))[0]
        length = np.diff(np.concatenate([cut, [len(key)]]))
        ids, fps, sides = cols[2], cols[1], cols[3] if sided else None
        # the first run may go on from before, the last one may go on after
        for r in {0, len(cut) - 1}:
            lo, n = cut[r], length[r]
            first, last = r == 0 and run_seen > 0, r == len(cut) - 1
            if whole and n > most:
                yield from every(ids[lo : lo + n], fps[lo : lo + n], sides[lo : lo + n] if sided else None, old - lo if first and run_seen > most else 0, lo)
                length[r] = 0
                if last:
                    run_seen = n
                    keep = [c[lo:] for c in cols]
            elif not whole and (first and run_seen > most or n > most):
                fresh = old - lo if first and run_seen > most else 0
                a, f, s = ids[lo : lo + n], fps[lo : lo + n], sides[lo : lo + n] if sided else None
                res += hot(a, f, s, max(1, fresh))
                leaders, more = _lead(leaders if first else None, a, f, s, max(0, fresh), limit, most)
                for x, y, sx, sy in more:
                    if two_sides:
                        if sx != sy:
                            res.append((np.array([x if sx == 0 else y]), np.array([y if sx == 0 else x])))
                    else:
                        res.append((np.array([min(x, y)]), np.array([max(x, y)])))
                length[r] = 0
                if last:
                    run_seen = most + 1
                    keep = [c[max(lo, len(key) - most) :] for c in cols]
            elif last:
                run_seen = n
                keep = [c[lo:] for c in cols]
                length[r] = 0
                leaders = None
        big = np.nonzero(length > most)[0]
        for r in big:
            a, f, s = ids[cut[r] : cut[r] + length[r]], fps[cut[r] : cut[r] + length[r]], sides[cut[r] : cut[r] + length[r]] if sided else None
            if whole:
                yield from every(a, f, s, 0, cut[r])
                length[r] = 0
                continue
            res += hot(a, f, s, 1)
            _, more = _lead(None, a, f, s, 0, limit, most)
            for x, y, sx, sy in more:
                if not two_sides:
                    res.append((np.array([min(x, y)]), np.array([max(x, y)])))
                elif sx != sy:
                    res.append((np.array([x if sx == 0 else y]), np.array([y if sx == 0 else x])))
            length[r] = 0
        res += within(cut, length, ids, fps, sides)
        if res:
            yield out(np.concatenate([r[0] for r in res]), np.concatenate([r[1] for r in res]))
        if who is not None:
            who = who.slice(len(who) - len(keep[0]))
    if keep is not None and 1 < run_seen <= most:
        if who is not None:
            words = tuple(x[-len(keep[0]) :] for x in words[:2]) + words[2:]
        res = within(np.array([0]), np.array([len(keep[0])]), keep[2], keep[1], keep[3] if sided else None)
        if res:
            yield out(np.concatenate([r[0] for r in res]), np.concatenate([r[1] for r in res]))


def _lead(leaders, ids, fps, sides, fresh, limit, most):
    """Links of members to the leaders they are close to; leaders: (ids, fps, sides) so far."""
    lid, lfp, lside = leaders or ([], [], [])
    links = []
    for k in range(fresh, len(ids)):
        side = sides[k] if sides is not None else 0
        near = np.nonzero(popcount(np.array(lfp, dtype=np.uint64) ^ fps[k]) <= limit)[0] if lfp else []
        for n in near[:1] if sides is None else near:
            links.append((int(lid[n]), int(ids[k]), lside[n], side))
        if not len(near) and len(lid) < most:
            lid.append(int(ids[k]))
            lfp.append(fps[k])
            lside.append(side)
    return (lid, lfp, lside), links
