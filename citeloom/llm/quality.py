"""Problem 9: text statistics per document, and documents that are not prose, by a hidden Markov model over lines.

Each line (long ones in sentence-like parts) is described by binned statistics. Simple rules label the lines of a bounded sample
where they are sure; from their counts, gathered by Spark, come the emission and transition tables of a model with the states
prose, list, table and junk. Every document's lines are then decoded with it, and the shares of its characters in each state
are its label shares. Characters are counted and lines decoded with numpy for many documents at once; words are looked up in a table
of words met before.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import fold

STATES = ("prose", "list", "table", "junk")
#: The model is fitted on the lines of at most about so many documents, chosen by a hash of the id.
FIT_DOCUMENTS = 3_000
#: Statistics of a line depend on each other; their joint weight is lowered by this power.
TEMPER = 0.55
#: Parts into which long lines are cut have at least so many characters.
PART = 160
# Words that hold sentences together (pronouns, auxiliaries, conjunctions) in English, German, French and Spanish.
BINDING = frozenset(
    "is are was were be been has have had do does did can could will would should may might must we they it he she you this that these those which who what when while if because although "
    "but not than so our their its there how after before where into "
    "ist sind war waren wird werden wurde wurden hat haben kann konnen muss nicht dass sich wir sie es diese dieser dieses eine ein einem einen wie ob weil wenn auch oder aber fur mit "
    "est sont etait ete avons ont nous ils elle qui que ne pas cette ces car mais plus dont leur leurs sans pour dans "
    "es son fue fueron ha han se los las una que no puede pueden esta este estos como pero sin sobre para muchos".split()
)
# Other common small words; titles and lists have them too.
SMALL = frozenset("the of and in on for with a an to by from as at or der die das und den dem des zu im von bei auf le la les et de du des un une en au aux el del y por con al".split())
# Chinese characters and pairs that hold sentences together.
_HAN_BINDING = re.compile(r"[的了是在于与对以能而也但被把]|我们|通过|由于|然而|结果|本文")
_HAN = re.compile(r"[\u3400-\u9fff]")
_TAG = re.compile(r"</?[a-zA-Z][^<>]{0,200}>")
_HIDDEN = re.compile(r"[\u200b-\u200f\ufeff\u00ad\u2060]")
_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")
_BULLET = re.compile(r"^\s*(?:[-–—•*·▪◦‣o+]\s|\(?\d{1,3}[.)\]]\s|\[\d{1,4}\]|\(?[a-z][.)]\s|\d+(?:\.\d+)*\s{2,})")
_FORMAL = re.compile(r"[{}\\]|\w=[\"\w]|==|https?:|\w@\w|<[a-z]+\s+\w+=|::|\bkey=|\"\w+\":|</(?:author|title|year|td|tr|li|article)>|Tel\.|&[a-z]+;.*&[a-z]+;")
_COLUMNS = re.compile(r"\||\t|;|\s{3,}|,(?=\S)|\s[/·•>]\s")
_REFERENCE = re.compile(r"\b(?:1[89]|20)\d\d\b.{0,80}\d+\s*[-–]\s*\d+|\(\d{4}\)\.|\bpp?\.\s*\d|\bdoi\b|\bvol\.|et al\.,|\bIn Proc", re.I)
_DOTS = re.compile(r"(?:\.\s?){4,}|…{2,}|…\s*…")
_END = re.compile(r"[.!?。！？:][\"'”’»)\]]*$")
_ENDS = frozenset(".!?。！？:")
_INNER_END = re.compile(r"[^\W\d_]{3}[.?!] [^\W\d_]")
_LINES = re.compile(r"\r\n|[\n\r\u2028\u2029\x0b\x0c]")
_DIGIT = re.compile(r"\d")
_SIGN = re.compile(r"[^\w\s.,'’()\"?!-]|_")
_SYMBOL = re.compile(r"[^\w\s]|_")
_VOWEL = re.compile(r"[aeiouyàâäáãåæèéêëìíîïòóôöõøùúûüýœ]", re.I)
_STOP = re.compile(r"[.!?]\s+(?=[\"“¿¡(]?[^\W\d_])|[。！？]")
_CELLS = re.compile(r"[|\t;,/·•>]|\s{3}")


def _letters(text: str) -> bool:
    return len(text) == 3 and text.isalnum() and not any(map(str.isdecimal, text))


def sentences(line: str) -> list[str]:
    """A line cut after a full stop between a word and a letter, without the blanks there, and after Chinese ones."""
    out, at = [], 0
    for hit in _STOP.finditer(line):
        k = hit.start()
        if line[k] in "。！？":
            out.append(line[at : k + 1])
        elif _letters(line[max(0, k - 3) : k]):
            out.append(line[at : k + 1])
        else:
            continue
        at = hit.end()
    out.append(line[at:])
    return out


def _in_columns(line: str) -> bool:
    return _CELLS.search(line) is not None and len(_COLUMNS.findall(line)) > 1


def _goes_on(before: str, line: str) -> bool:
    """Whether a line is the rest of a sentence that was wrapped (neither is in columns)."""
    if _BULLET.match(line):
        return False
    first = line.lstrip()[:1]
    last = before.rstrip()[-1:]
    if last in "-\u00ad" and first.isalpha() and len(before.strip()) > 20:
        return True
    if first.isalpha() and last.isalnum():
        words = _WORD.findall(before)
        if len(words) > 2 and (_known[words[-1]] & 0x10001 or _INNER_END.search(before)):
            return True
    return first.islower() and (last.isalnum() or last in ",)'’\"”") and len(before.strip()) > 15


def units(text: str) -> list[str]:
    """The non-blank lines of a text, wrapped ones put together; long ones in sentence-like parts."""
    joined: list[list[str]] = []
    before, columns = "", False
    for line in _LINES.split(text):
        if line.strip():
            here = _in_columns(line)
            if joined and not columns and not here and before.strip() and _goes_on(before, line):
                joined[-1].append(line)
            else:
                joined.append([line])
            columns = here
        before = line
    out = []
    for line in map(" ".join, joined):
        if len(line) <= 2 * PART:
            out.append(line)
            continue
        part = ""
        for piece in sentences(line):
            part = f"{part} {piece}" if part else piece
            if len(part) >= PART:
                out.append(part)
                part = ""
        if part.strip():
            out.append(part)
    return out


# classes of characters, as bits of a table over the code points below 65,536
_CLASSES = {"digit": _DIGIT, "sign": _SIGN, "han": _HAN, "symbol": _SYMBOL, "space": re.compile(r"\s"), "formal": re.compile(r"[{}\\=@:<&]"), "cell": re.compile(r"[|;]"), "comma": re.compile(","), "slash": re.compile(r"[/·•>]"), "tab": re.compile("\t")}
_BIT = {name: np.uint16(1 << k) for k, name in enumerate(_CLASSES)}


@lru_cache(maxsize=1)
def _table() -> np.ndarray:
    out = np.zeros(65_536, dtype=np.uint16)
    for name, pattern in _CLASSES.items():
        for c in range(65_536):
            if not 0xD800 <= c < 0xE000 and pattern.match(chr(c)):
                out[c] |= _BIT[name]
    return out


# what is counted of a word, 16 bits each: binding, small, begins with a capital, long without a vowel
class _Words(dict):
    MOST = 200_000

    def __missing__(self, word: str) -> int:
        low = fold(word)
        if len(self) >= self.MOST:
            self.clear()
        self[word] = out = (low in BINDING) | (low in SMALL) << 16 | word[0].isupper() << 32 | (len(word) > 3 and not _VOWEL.search(word)) << 48
        return out


_known = _Words()


def _over(values: np.ndarray, *edges: float) -> np.ndarray:
    return sum((values > e).astype(np.int8) for e in edges)


def _plain(line: str) -> str:
    if "<" in line:
        line = _TAG.sub(" ", line)
    return line if line.isascii() else _HIDDEN.sub("", line).replace("\xa0", " ")


def _begin(stripped: str) -> int:
    first, second = stripped[:1], stripped[1:2]
    if (first in "-–—•*·▪◦‣o+([" or first.isdigit() or second in (".", ")")) and _BULLET.match(stripped):
        return 0
    return 1 if first.islower() else 2 if first.isalpha() else 3


def _refers(plain: str, digits: int) -> bool:
    if not digits:
        low = plain.lower()
        if "doi" not in low and "vol." not in low and "et al.," not in low and "in proc" not in low:
            return False
    return bool(_REFERENCE.search(plain))


def describe(texts: list[str]) -> dict[str, np.ndarray]:
    """Of all lines (``units``) of the texts: document number, visible size, words, letters of words, binding or small words, and
    the binned statistics ``stats`` (lines, 14)."""
    doc, lines, again = [], [], []
    for n, text in enumerate(texts):
        own = units(text)
        seen = Counter(x.strip() for x in own)
        lines += own
        doc += [n] * len(own)
        again += [seen[x.strip()] > 2 for x in own]
    plain = [_plain(x) for x in lines]
    found = [_WORD.findall(x) for x in plain]
    packed = np.array([sum(map(_known.__getitem__, ws)) for ws in found], dtype=np.uint64)
    field = lambda k: (packed >> np.uint64(16 * k) & np.uint64(0xFFFF)).astype(np.float64)
    words = np.array([len(ws) for ws in found], dtype=np.float64)
    letters = np.array([sum(map(len, ws)) for ws in found], dtype=np.int64)
    # characters of all lines, one after the other, each line closed by a blank
    flat = np.frombuffer((" ".join(plain) + " ").encode("utf-32-le", "replace"), dtype=np.uint32)
    kinds = _table()[np.minimum(flat, 65_535)]
    length = np.array([len(x) + 1 for x in plain], dtype=np.int64)
    start = np.cumsum(length) - length
    count = lambda hits: np.add.reduceat(hits, start, dtype=np.int64) if len(start) else np.zeros(0, np.int64)
    of = lambda name: (kinds & _BIT[name]) != 0
    space = of("space")
    inner = space.copy()
    inner[start + length - 1] = False  # the closing blank is none of the line's own
    at_end = np.zeros(len(flat), dtype=bool)
    at_end[start + length - 1] = True
    after, before = np.append(inner[1:], False), np.append(False, inner[:-1])
    digits, signs, han, tabs = count(of("digit")), count(of("sign")), count(of("han")), count(of("tab"))
    slashes = count(of("slash") & after & before)
    columns = count(of("cell")) + count(of("comma") & ~after & ~np.append(at_end[1:], False)) + slashes
    mixed = (count(inner & after & before) > 0) | (slashes > 1) | (tabs > 0)
    formal = count(of("formal")) > 0
    size = np.array([max(1, len(x.strip())) for x in plain], dtype=np.float64)
    for k in np.nonzero(mixed)[0]:
        columns[k] = len(_COLUMNS.findall(plain[k]))
    n = np.maximum(1, words)
    binding, small, capital, odd = field(0) / n, field(1) / n, np.zeros(len(n)), field(3) / n
    first = np.array([bool(ws) and ws[0][0].isupper() for ws in found], dtype=np.float64)
    shout = np.array([x.isupper() for x in plain], dtype=bool)
    capital = np.where(shout, 0.0, (field(2) - first) / np.maximum(1, words - 1))
    chinese = han * 3 > size
    for k in np.nonzero(chinese)[0]:
        binding[k] = len(_HAN_BINDING.findall(plain[k])) / max(1, han[k]) * 2.2
        small[k], capital[k], odd[k] = 0.15, 0.0, 0.0
        words[k] = max(words[k], han[k] // 2)
    n = np.maximum(1, words)
    bare = [x.strip() for x in plain]
    end = [0 if x.rstrip("\"'”’»)]")[-1:] in _ENDS and x else 1 if x[-1:] in (",", ";") else 2 for x in bare]
    stats = np.stack(
        [
            _over(binding, 0, 0.07, 0.14), _over(small, 0, 0.12, 0.3), _over(digits / size, 0.01, 0.06, 0.2), _over(signs / size, 0.005, 0.03, 0.1, 0.25), np.array(end, dtype=np.int8), _over(words, 2, 5, 9, 16),
            np.array([_begin(x.lstrip()) for x in plain], dtype=np.int8), _over(capital, 0.05, 0.25, 0.6), _over(odd, 0.1, 0.4),
            np.array([bool((f or "<" in x or "Tel." in x) and _FORMAL.search(x)) for f, x in zip(formal, lines)], dtype=np.int8), _over(columns / n, 0.02, 0.15, 0.4),
            np.array([_refers(x, d) for x, d in zip(plain, digits)], dtype=np.int8), np.array([(".." in x or ". ." in x or "…" in x) and bool(_DOTS.search(x)) for x in plain], dtype=np.int8), np.array(again, dtype=np.int8),
        ],
        axis=1,
    ) if lines else np.zeros((0, len(BINS)), np.int8)
    return {
        "doc": np.array(doc, dtype=np.int64), "size": np.array([len("".join(x.split())) for x in lines], dtype=np.int64), "words": np.array([len(ws) for ws in found], dtype=np.int64), "letters": letters,
        "common": np.array([sum(1 for w in ws if _known[w] & 0x10001) for ws in found], dtype=np.int64), "symbols": count(of("symbol")), "stats": stats,
    }


def sure_state(s: tuple[int, ...]) -> int:
    """State of a line by simple rules, or -1."""
    binding, small, digits, symbols, end, n, begin, capital, odd, formal, columns, reference, dots, repeated = s
    if symbols == 4 and columns <= 1 or odd == 2 or formal and binding <= 1 or repeated and n <= 1 and binding == 0:
        return 3
    if columns >= 2 and binding == 0 and (digits >= 2 or symbols >= 2):
        return 2
    if reference and binding <= 1 or dots or begin == 0 and binding == 0 or columns >= 2 and binding == 0 and n >= 2 or capital == 3 and n >= 2 and binding == 0:
        return 1
    if binding >= 2 and n >= 2 and digits <= 1 and columns <= 1 and not formal and begin != 0 and not reference:
        return 0
    if n >= 3 and binding == 0 and small <= 1:
        return 3 if end == 0 and columns == 0 and small == 0 else 1
    if n >= 2 and binding == 0 and end == 2 and begin == 2:
        return 1
    return -1


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts for the model: of each statistic's bins by sure state, and of sure states that follow each other."""
    for batch in batches:
        counts: Counter = Counter()
        for texts in _portions(batch.column("text").to_pylist()):
            got = describe(texts)
            states = [sure_state(tuple(x)) for x in got["stats"].tolist()]
            before, last = -1, -1
            for d, state, s in zip(got["doc"].tolist(), states, got["stats"].tolist()):
                before = before if d == last else -1
                if state >= 0:
                    for k, b in enumerate(s):
                        counts[(k, state, b)] += 1
                    if before >= 0:
                        counts[(-1, before, state)] += 1
                before, last = state, d
        rows = list(counts.items())
        yield pa.RecordBatch.from_arrays([pa.array([k[j] for k, _ in rows], pa.int32()) for j in range(3)] + [pa.array([c for _, c in rows], pa.int64())], names=["what", "state", "bin", "n"])


#: Characters of the texts that are described at once (a longer text is described alone).
PORTION = 2_000_000


def _portions(texts: list[str]) -> Iterator[list[str]]:
    out, size = [], 0
    for t in texts:
        if out and size + len(t) > PORTION:
            yield out
            out, size = [], 0
        out.append(t)
        size += len(t)
    if out:
        yield out


BINS = (4, 4, 4, 5, 3, 5, 4, 4, 3, 2, 4, 2, 2, 2)


def fit(documents: DataFrame, most: int = FIT_DOCUMENTS) -> tuple[list[np.ndarray], np.ndarray]:
    """(emission log tables by statistic, transition log table), from about ``most`` documents with text."""
    total = documents.count()
    share = min(1.0, most / max(1, total))
    some = documents.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000)).select("text")
    rows = some.mapInArrow(_sample, "what int, state int, bin int, n long").groupBy("what", "state", "bin").agg(F.sum("n").alias("n")).collect()
    emission = [np.full((len(STATES), b), 1.0) for b in BINS]
    transition = np.full((len(STATES), len(STATES)), 2.0) + 20 * np.eye(len(STATES))
    for what, state, b, n in rows:
        if what < 0:
            transition[state, b] += n
        else:
            emission[what][state, b] += n
    return [np.log(e / e.sum(axis=1, keepdims=True)) for e in emission], np.log(transition / transition.sum(axis=1, keepdims=True))


def decode(doc: np.ndarray, stats: np.ndarray, emission: list[np.ndarray], transition: np.ndarray) -> np.ndarray:
    """The most likely states of all lines; ``doc`` (ascending) tells whose lines they are. All documents go forward together, line
    by line, the longest ones first, so that those with lines left are always the first rows."""
    if not len(doc):
        return np.zeros(0, np.int8)
    score = TEMPER * sum(emission[k].T[stats[:, k]] for k in range(stats.shape[1]))
    _, begin, length = np.unique(doc, return_index=True, return_counts=True)
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    back = np.zeros((len(doc), len(STATES)), dtype=np.int8)
    best = score[begin].copy()
    left = np.searchsorted(-length, -np.arange(1, length[0] + 1), side="right")  # documents with so many lines
    for i in range(1, length[0]):
        m = left[i]
        step = best[:m, :, None] + transition
        at = begin[:m] + i
        back[at] = step.argmax(axis=1)
        best[:m] = step.max(axis=1) + score[at]
    out = np.zeros(len(doc), dtype=np.int8)
    now = best.argmax(axis=1).astype(np.int8)
    for i in range(length[0] - 1, -1, -1):
        m = left[i]
        at = begin[:m] + i
        out[at] = now[:m]
        if i:
            now[:m] = back[at, now[:m]]
    return out


def _statistics(texts: list[str], emission, transition) -> list[np.ndarray]:
    """The ``COLUMNS`` of the texts."""
    got = describe(texts)
    doc, n = got["doc"], len(texts)
    states = decode(doc, got["stats"], emission, transition)
    total = lambda values: np.bincount(doc, weights=values, minlength=n)
    lines, words, size = total(np.ones(len(doc))), total(got["words"]), total(got["size"])
    over = lambda a, b: a / np.maximum(1, b)
    return [
        words.astype(np.int64), over(total(got["letters"]), words), over(total(got["symbols"]), size), over(total(got["stats"][:, 4] == 0), lines), over(total(got["common"]), words), lines.astype(np.int64),
        *(over(total(np.where(states == k, got["size"], 0)), size) for k in range(len(STATES))),
    ]


COLUMNS = ("words", "mean_word_length", "symbol_ratio", "ended_lines", "common_words", "lines", "prose", "list", "table", "junk")


def text_statistics(documents: DataFrame, id_column: str = "doc_id", text: str = "text", most: int = FIT_DOCUMENTS) -> DataFrame:
    """One row per document: its id, words (without those of markup), mean_word_length, symbol_ratio (of visible characters, without
    markup), ended_lines (share of lines that end in punctuation), common_words (share), lines, and the shares of visible characters in prose, list, table and junk.

    Null, empty and blank texts have zeros throughout. Whole texts are read; other columns are not."""
    rows = documents.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    model = fit(rows.where("text rlike '\\\\S'"), most)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emission, transition = shared.value
        for batch in batches:
            at = 0
            for texts in _portions(batch.column("text").to_pylist()):
                got = _statistics(texts, emission, transition)
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, len(texts)), *map(pa.array, got)], names=[id_column, *COLUMNS])
                at += len(texts)

    schema = f"`{id_column}` long, " + ", ".join(f"{c} {'long' if c in ('words', 'lines') else 'double'}" for c in COLUMNS)
    return rows.mapInArrow(of, schema)


def not_prose(statistics: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """p9: ids of documents more than half of whose visible characters are not prose; documents without any are none."""
    return statistics.where("lines > 0 and prose < 0.5").select(id_column)
