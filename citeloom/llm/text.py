"""Normal forms and small comparisons of titles and personal names (plain Python, used inside Arrow batches)."""

from __future__ import annotations

import html
import re
import unicodedata

# Words that carry no identity in a title.
STOP_WORDS = frozenset(
    "a an and as at by for from in into of on or the to via with".split()
)
# Letters that NFKD leaves whole.
_FOLD = str.maketrans({"ø": "o", "ł": "l", "đ": "d", "ð": "d", "þ": "th", "æ": "ae", "œ": "oe", "ß": "ss", "ı": "i"})
_TAG = re.compile(r"</?[a-zA-Z][^<>]{0,60}>")
_LABEL = re.compile(r"^[\s\"'“„]*(?:\s*(?:[\[(]\s*(?:full\s+)?(?:paper|article|research)\s*[\])]|(?:full\s+paper|paper|article|title)\s*:))+\s*")
_WORD = re.compile(r"[^\W_]+(?:\+)?")
_ROMAN = re.compile(r"^[ivx]+$")
_LETTERS = re.compile(r"[^\W\d_]+")
_NUMBER = re.compile(r"\s*\b\d{4}$")
# Name particles, honorifics and suffixes.
PARTICLES = frozenset("van von der den de del della di da la le du dos das ter ten zu zur el al".split())
HONORIFICS = frozenset("dr prof professor mr mrs ms sir dipl ing phd md jr sr".split())


def fold(text: str) -> str:
    """Lower case, compatibility forms, no accents."""
    text = text.lower()
    if text.isascii():
        return text
    text = unicodedata.normalize("NFKD", text)
    return "".join(c for c in text if not unicodedata.combining(c)).lower().translate(_FOLD)


def title_tokens(title: str | None) -> list[str]:
    """Content words of a title: entities, inline markup, a leading record label, case, accents and stop words removed."""
    if not title:
        return []
    if "&" in title:
        title = html.unescape(html.unescape(title))
    if "<" in title:
        title = _TAG.sub("", title)
    text = _LABEL.sub("", fold(title))
    words = _WORD.findall(text)
    return [w for w in words if w not in STOP_WORDS] or words


def _raw_name(name: str) -> str:
    """A name with mojibake, letters read as digits, remarks in brackets and footnote marks mended."""
    if "Ã" in name or "Å" in name:
        try:
            name = name.encode("cp1252").decode("utf-8")
        except UnicodeError:
            pass
    name = re.sub(r"\([^()]*\)|\[[^\[\]]*\]", " ", name)
    name = re.sub(r"(?<=[^\W\d_])[01](?=[^\W\d_])", lambda m: "lo"[m.group() == "0"], name)
    return re.sub(r"[\d\s*†‡§,;]+$", "", name).strip()


def surname(name: str | None) -> tuple[str, str]:
    """(family name, other long word) of a personal name, folded; empty strings if there is none.

    Without a comma the last word counts as the family name, unless initials follow it ("Surname FM"). The other word (mostly
    the given name) lets "Surname Given" be recognised when it is compared with "Given Surname"."""
    if not name:
        return "", ""
    raw = _raw_name(name)
    head, _, tail = raw.partition(",")
    clean = lambda t: [w.strip("'-") for w in re.sub(r"[^\w\s'-]", " ", fold(t).replace(".", " ")).split()]
    long = lambda ws: [w for w in ws if len(w) > 1 and w not in PARTICLES and w not in HONORIFICS]
    if tail:
        words, given = long(clean(head)), long(clean(tail))
        if words:
            return words[-1], given[0] if given and len(given[0]) > 2 else ""
        words = given
    else:
        parts = raw.split()
        if len(parts) > 1 and len(last := re.sub(r"[.-]", "", parts[-1])) <= 3 and last.isupper() and not raw.isupper():
            parts = parts[:-1]
        elif len(parts) > 1 and len(last) == 1:
            parts = parts[:-1]
        words = long(clean(" ".join(parts)))
    if not words:
        return "", ""
    other = words[0] if len(words) > 1 and len(words[0]) > 2 else ""
    return words[-1], other


# Author entries that name nobody.
NOBODY = frozenset(["", "et al", "et al.", "and others", "others", "anonymous", "anon", "anon.", "unknown", "n/a", "na", "none", "null", "-", "no author", "no authors", "author unknown", "various", "various authors", "editors", "the editors", "staff"])


def surnames(authors) -> list[str]:
    """Distinct names of an author list as "family|other" (``surname``), sorted."""
    if authors is None:
        return []
    out = set()
    for name in authors:
        if name and fold(name).strip(" .;,") not in NOBODY:
            key, other = surname(name)
            if len(key) > 1:
                out.add(f"{key}|{other}")
    return sorted(out)


def osa(a: str, b: str, limit: int) -> int:
    """Optimal string alignment distance, or limit + 1 if it is larger."""
    if a == b:
        return 0
    la, lb = len(a), len(b)
    if abs(la - lb) > limit:
        return limit + 1
    # an edit changes at most one letter of each word's set of letters
    if len(set(a) - set(b)) > limit or len(set(b) - set(a)) > limit:
        return limit + 1
    start = 0
    while start < la and start < lb and a[start] == b[start]:
        start += 1
    while la > start and lb > start and a[la - 1] == b[lb - 1]:
        la -= 1
        lb -= 1
    a, b = a[start:la], b[start:lb]
    la, lb = len(a), len(b)
    if not la or not lb:
        return la + lb
    before, row = [], list(range(lb + 1))
    for i in range(1, la + 1):
        older, before, row = before, row, [i] + [0] * lb
        for j in range(1, lb + 1):
            cost = a[i - 1] != b[j - 1]
            best = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + cost)
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                best = min(best, older[j - 2] + 1)
            row[j] = best
        if min(row) > limit:
            return limit + 1
    return min(row[lb], limit + 1)


def words_agree(a: str, b: str) -> bool:
    """The same word up to a typing error: one edit, or two from 7 letters on. Digits and signs must be equal, the
    first or the last letter too, and words of two or three letters must begin alike and not be numerals."""
    if a == b:
        return True
    if not a or not b or (a[0] != b[0] and a[-1] != b[-1]):
        return False
    if not (a.isalpha() and b.isalpha()):
        sign_a, sign_b = _LETTERS.sub("", a), _LETTERS.sub("", b)
        if sign_a != sign_b:
            return False
    short = min(len(a), len(b))
    if short < 4 and (short < 2 or a[0] != b[0] or _ROMAN.match(a) or _ROMAN.match(b)):
        return False
    limit = 2 if short >= 7 else 1
    return osa(a, b, limit) <= limit


def _slight(word: str) -> bool:
    """A mistyped stop word."""
    if len(word) > 5 or not word.isalpha() or _ROMAN.match(word):
        return False
    return any(len(s) > 1 and osa(word, s, 1) <= 1 for s in STOP_WORDS)


# Words by which a title announces a later paper of its own.
FOLLOW_UPS = frozenset("part ii iii iv v revisited beyond lessons second look ten years later extended extension update again mobile readers follow followup".split())


def _near(a: str, b: str) -> bool:
    """Words that agree even with several errors in one word."""
    if words_agree(a, b):
        return True
    limit = int(0.4 * max(len(a), len(b)))
    return limit > 0 and (a[0] == b[0] or a[-1] == b[-1]) and a.isalpha() and b.isalpha() and not _ROMAN.match(a) and not _ROMAN.match(b) and osa(a, b, limit) <= limit


def _follows(words: list[str]) -> bool:
    return any(w in FOLLOW_UPS or (len(w) > 5 and any(len(f) > 5 and words_agree(w, f) for f in FOLLOW_UPS)) for w in words)


def _is_cut(short: list[str], long: list[str]) -> bool:
    """Whether ``short`` is ``long`` cut off at its end, within or between words, or without a name of one or two words at its
    beginning. Words that announce a follow-up are never what is cut off."""
    n = len(short)
    if n < 3 or n > len(long) or len("".join(short)) * 5 < len("".join(long)) * 2:
        return False
    tail, at = short[-1], long[n - 1]
    if (at.startswith(tail) or _near(at[: len(tail)], tail) or _near(at, tail)) and not _follows(long[n:]) and (at == tail or not _follows([at])):
        if all(_near(x, y) for x, y in zip(short[:-1], long)):
            return True
    k = len(long) - n
    return 1 <= k <= 2 and not _follows(long[:k]) and all(_near(x, y) for x, y in zip(short, long[k:]))


def title_difference(a: list[str], b: list[str]) -> tuple[int, int, int, bool]:
    """(words of a without partner in b, words of b without partner in a, partners that differ by typing errors, cut off).

    Words split or joined by a space or hyphen count as partners; so do mistyped stop words without any partner. If one title
    is the other one cut off (``_is_cut``), the missing words do not count. Titles with less than a third of their words in
    common are not looked at further."""
    if a == b:
        return 0, 0, 0, False
    rest_b = list(b)
    rest_a = []
    for w in a:
        if w in rest_b:
            rest_b.remove(w)
        else:
            rest_a.append(w)
    if len(rest_a) + len(rest_b) > 5 and 3 * (len(a) - len(rest_a)) < min(len(a), len(b)):
        return len(rest_a), len(rest_b), 0, False
    typos = 0
    left_a = []
    for w in rest_a:
        hit = next((x for x in rest_b if words_agree(w, x)), None)
        if hit is None:
            left_a.append(w)
        else:
            rest_b.remove(hit)
            typos += 1
    if not left_a and not rest_b:
        return 0, 0, typos, False
    if _is_cut(a, b) or _is_cut(b, a):
        return 0, 0, typos, True
    if left_a and rest_b and len(left_a) + len(rest_b) > 2:
        for one, many in ((left_a, rest_b), (rest_b, left_a)):
            for w in list(one):
                for i in range(len(many) - 1):
                    if words_agree(w, many[i] + many[i + 1]):
                        one.remove(w)
                        del many[i : i + 2]
                        typos += 1
                        break
    # several errors in one word
    for w in list(left_a):
        hit = next((x for x in rest_b if _near(w, x)), None)
        if hit is not None:
            left_a.remove(w)
            rest_b.remove(hit)
            typos += 2
    left_a, left_b = [w for w in left_a if not _slight(w)], [w for w in rest_b if not _slight(w)]
    return len(left_a), len(left_b), typos, False


def follows(a: list[str], b: list[str]) -> bool:
    """Whether one title has a word that the other lacks and that announces a follow-up."""
    x, y = set(a), set(b)
    return _follows([*(x - y), *(y - x)])


def names_shared(a: list[str], b: list[str]) -> int:
    """Names of a ("family|other") that have a partner in b: family names equal up to a typing error, or swapped words."""
    if a == b:
        return len(a)
    rest = [x.partition("|") for x in b]
    n = 0
    later = []
    for name in a:
        w, _, o = name.partition("|")
        hit = next((x for x in rest if x[0] == w), None)
        if hit is None:
            later.append((w, o))
        else:
            rest.remove(hit)
            n += 1
    for w, o in later:
        hit = next((x for x in rest if _names_agree(w, x[0]) or (x[2] and words_agree(w, x[2]) and (not o or words_agree(o, x[0]))) or (o and words_agree(o, x[0]) and (not x[2] or words_agree(w, x[2])))), None)
        if hit is not None:
            rest.remove(hit)
            n += 1
    return n


def _names_agree(a: str, b: str) -> bool:
    if words_agree(a, b):
        return True
    # one part of a double name, or a part left behind by a space that was put in or taken out
    return len(a) >= 5 and len(b) >= 5 and (a in b.split("-") or b in a.split("-") or a.endswith(b) or b.endswith(a))
