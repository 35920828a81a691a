"""Problems 1 to 3 on a small table with every kind of dirt."""

import datetime as dt
import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from citeloom.llm import dedupe, fingerprints, matching, records, survivorship, text
from citeloom.llm.graph import components

COLUMNS = "row_id bigint, title string, authors array<string>, year bigint, doi string, dblp_key string, abstract string, keywords array<string>, citation_count bigint, updated_at timestamp, name string, id string"
T1 = "Mining sparse glyphs with layered dashboards"


def row(n, title, authors, year, doi=None, key=None, abstract=None, keywords=None, count=None, day=1):
    return (n, title, authors, year, doi, key, abstract, keywords, count, dt.datetime(2024, 1, day), "clash", "clash")


ROWS = [
    row(1, T1, ["Ann Bofisk", "Carl Dremont"], 2001, "10.1234/a", None, "A first sentence that is cut...", ["a", "A ", "n/a"], 5, 1),
    row(2, "mining sparse glyps layered dashboards.", ["A. Bofisk", "Carl Dremont"], 2002, None, "conf/x/1", "No abstract available.", ["a", "b"], 99999999, 9),
    row(3, T1, ["Ann Bofisk", "Carl Dremont"], 2001, None, None, "A first sentence that is whole. And a second one.", None, 7, 3),
    row(4, T1 + ", Part II", ["Ann Bofisk", "Carl Dremont"], 2003),
    row(5, T1, ["Someone Else"], 2001),
    row(6, "Foreword", ["Ann Bofisk"], 2001),
    row(7, "Foreword", ["Carl Dremont"], 2001),
    row(8, None, None, None),
    row(9, "", [], 0),
    row(10, "Tracing contextual field notes through provenance archives", ["Eve Falkner"], 2010, "10.1234/a"),
]


def test_repeats_and_survivors(spark):
    df = spark.createDataFrame(ROWS, COLUMNS)
    assert {(1, 2), (1, 3)} <= {tuple(r) for r in dedupe.find_repeats(df).collect()}
    assert {tuple(r) for r in dedupe.find_repeats(df).where("first_row_id < 8").collect()} == {(1, 2), (1, 3)}
    best = {r.first_row_id: tuple(r)[1:] for r in survivorship.survivors(df).collect()}
    assert best[1] == (3, 3, 2)
    empty = df.where("1 = 0")
    assert dedupe.find_repeats(empty).count() == 0 and survivorship.survivors(empty).count() == 0


def test_incremental_batches_agree(spark):
    df = spark.createDataFrame(ROWS, COLUMNS)
    _, index, accepted = dedupe.append_batch(df.where("row_id = 1 or row_id > 3"), None, None)
    repeats, more, _ = dedupe.append_batch(df.where("row_id in (2, 3)"), index, accepted)
    assert {tuple(r) for r in repeats.collect()} == {(2, 1), (3, 1)} and more.count() > 0


def test_long_and_repeated_rows(spark):
    long = " ".join(f"word{n}" for n in range(3000))
    rows = [row(n, long, [f"Name{k} Surname{k}" for k in range(300)], 2000) for n in range(3)] + [row(9, "x", ["y"], 5)]
    assert {tuple(r) for r in dedupe.find_repeats(spark.createDataFrame(rows, COLUMNS)).collect()} == {(0, 1), (0, 2)}


def test_matches_across_tables(spark):
    left = spark.createDataFrame(ROWS, COLUMNS)
    right = spark.createDataFrame(
        [("L1", "Minning sparse glyphs with layerd dashboards", ["Bofisk, A.", "Dremont Carl"], 2001, 1), ("L1", "Minning sparse glyphs with layerd dashboards", ["Bofisk, A.", "Dremont Carl"], 2001, 2), ("L2", T1 + ", Part II", ["Ann Bofisk"], 2003, 3), ("L3", None, None, None, 4), ("L4", "Foreword", ["Ann Bofisk"], 2001, 5)],
        "id string, title string, authors array<string>, year bigint, row_id int",
    )
    got = matching.match(left, right)
    assert {(r.row_id, r.id) for r in got.collect()} == {(1, "L1"), (2, "L1"), (3, "L1"), (4, "L2"), (6, "L4")}
    assert all(0.5 <= r.confidence <= 1 for r in got.collect())
    assert matching.match(left.where("1 = 0"), right).count() == 0


def test_pairs_of_sorted_against_brute_force():
    rng = np.random.default_rng(1)
    n = 600
    key = np.sort(rng.integers(0, 60, n))
    fps = rng.integers(0, 2**63, 40)[rng.integers(0, 40, n)]
    order = np.lexsort((fps, key))
    key, fps, ids = key[order], fps[order], np.arange(n)
    want = {(int(min(i, j)), int(max(i, j))) for i, j in itertools.combinations(range(n), 2) if key[i] == key[j] and bin(int(fps[i]) ^ int(fps[j])).count("1") <= 10}
    for size in (7, 100, n):
        batches = [pa.RecordBatch.from_arrays([pa.array(key[s : s + size]), pa.array(fps[s : s + size]), pa.array(ids[s : s + size])], names=["key", "fp", "id"]) for s in range(0, n, size)]
        got = {(a, b) for out in fingerprints.pairs_of_sorted(iter(batches), 10, 50, False) for a, b in zip(out.column("a").to_pylist(), out.column("b").to_pylist())}
        assert got == want


def test_crowded_runs_stay_linked():
    n = 1000
    fps = np.sort(np.array([(1 << (i % 8)) for i in range(n)]))
    batches = [pa.RecordBatch.from_arrays([pa.array(np.zeros(len(fps[s : s + 90]), np.int64)), pa.array(fps[s : s + 90]), pa.array(np.arange(s, s + len(fps[s : s + 90])))], names=["key", "fp", "id"]) for s in range(0, n, 90)]
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    pairs = 0
    for out in fingerprints.pairs_of_sorted(iter(batches), 2, 20, False):
        for a, b in zip(out.column("a").to_pylist(), out.column("b").to_pylist()):
            pairs += 1
            root[max(find(a), find(b))] = min(find(a), find(b))
    assert len({find(i) for i in range(n)}) == 1 and pairs < n * 25


def test_fingerprints_tell_how_texts_differ():
    a, b, c = (int(x) for x in fingerprints.fingerprint(["mining sparse glyphs layered dashboards", "mining sparse glyps layered dashboards", "tracing contextual field notes archives"]))
    assert bin(a ^ b).count("1") < bin(a ^ c).count("1") and int(fingerprints.fingerprint([""])[0]) == 0


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 4), (4, 4), (3, 1), (7, 8), (8, 9), (9, 10), (10, 11)], "a bigint, b bigint")
    assert {(r.node, r.root) for r in components(edges).collect()} == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (7, 7), (8, 7), (9, 7), (10, 7), (11, 7)}
    assert components(edges.where("1 = 0")).count() == 0


def test_same_paper_rules():
    base = ("mining sparse glyphs layered dashboards", "bofisk|ann dremont|carl", 2001)
    assert records.same_paper(*base, *base) and not records.same_paper(*base, base[0], base[1], 2004)
    assert not records.same_paper(*base, base[0], "else|some", 2001)
    assert records.same_paper(*base, base[0], "", 2001) and not records.same_paper("foreword", "", 2001, "foreword", "", 2001)
    assert records.doi_key("DOI: 10.1234/A.)") == "10.1234/a" and records.doi_key(None) == ""
    assert records.bibliographic_key("https://d.example/rec/conf/X/1.html") == records.bibliographic_key("DBLP:conf/x/1") == "conf/x/1"


@pytest.mark.parametrize("two_sides", [False, True])
def test_pairs_of_a_crowded_key_are_all_found(two_sides):
    """A pair close only to each other, far apart in order, after more strangers than a run holds at once; cut into batches."""
    rng = np.random.default_rng(5)
    fps = rng.integers(0, 1 << 63, 900, dtype=np.uint64)
    fps[:40] = fps[40:80] ^ np.uint64(1 << 63)
    fps.sort()
    ids, sides = np.arange(900, dtype=np.int64), rng.integers(0, 2, 900).astype(np.int8)
    keys = np.full(900, 7, dtype=np.int64)
    cols = [keys, fps.view(np.int64), ids] + ([sides] if two_sides else [])
    names = ["key", "fp", "id"] + (["side"] if two_sides else [])
    for size in (900, 130):
        batches = [pa.RecordBatch.from_arrays([pa.array(c[i : i + size]) for c in cols], names=names) for i in range(0, 900, size)]
        got = []

        class Rows:  # stands for the sorted blocks of a table; runs what the operator maps over them
            def mapInArrow(self, of, schema):
                rows = iter(batches) if schema.startswith("a ") else iter(())
                got.extend((a, b) for out in of(rows) for a, b in zip(out.column("a").to_pylist(), out.column("b").to_pylist()))
                return self

            def __getattr__(self, name):
                return lambda *args: self

        if two_sides:
            matching.candidates(Rows(), Rows(), 4, 64)
        else:
            dedupe.close_pairs(Rows(), 4, 64)
        near = [(int(i), int(j)) for i, j in np.argwhere(np.triu(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 4, 1))]
        want = [(i, j) if not two_sides or sides[i] == 0 else (j, i) for i, j in near if not two_sides or sides[i] != sides[j]]
        assert want and sorted(got) == sorted(want)


def test_classifier_learns_what_no_single_feature_tells():
    rng = np.random.default_rng(7)
    x = rng.integers(0, 3, (4000, len(matching.FEATURES))).astype(float)
    y = ((x[:, 0] == 0) | ((x[:, 0] == 1) & (x[:, 6] == 0))).astype(float)
    noisy = np.where(rng.random(len(y)) < 0.03, 1 - y, y)
    model = matching.Boosted.fit(x[:2000], noisy[:2000])
    slope, offset = matching.platt(model.score(x[2000:3000]), noisy[2000:3000])
    p = 1 / (1 + np.exp(-(slope * model.score(x[3000:]) + offset)))
    assert ((p > 0.5) == y[3000:]).mean() > 0.99
    # probabilities mean what they say on rows that were not used: about three in a hundred are wrong
    assert abs(p.mean() - noisy[3000:].mean()) < 0.03 and 0.9 < p[p > 0.5].mean() < 0.995


def test_abstracts_label_pairs_that_the_features_leave_open():
    words = " ".join(f"{a}{b}word" for a in "abcdefgh" for b in "klmn")
    assert matching.weak_label(words, words.upper() + " more.") == 1 and matching.weak_label(words, words.replace("word", "else")) == 0
    assert matching.weak_label(words, None) == -1 and matching.weak_label("too few words", words) == -1
    half = " ".join(w if i % 5 < 3 else w[::-1] for i, w in enumerate(words.split()))
    assert matching.weak_label(words, half) == -1


def test_matching_learns_from_abstracts_in_the_tables(spark):
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnoprstuvwz"), 8))
    texts = {k: " ".join(word() for _ in range(40)) for k in [*range(150), *range(5000, 5150)]}
    say = texts.get
    left, right = [], []
    for k in range(150):
        title, names = " ".join(f"{'bcdfghklmn'[(k + j) % 10]}{'aeiou'[(k // 10 + j) % 5]}{'rstvwxzpqy'[(k // 50 + 3 * j) % 10]}item{'aeioubcdfg'[(k * j) % 10]}" for j in range(6)), [f"Ann Fam{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}{'uvwxyz'[k // 100]}er"]
        left.append((k, title, names, 2000, say(k)))
        right.append((f"R{k}", title, names, 2000, say(k)))
        if k % 2:  # a later paper of the same people with nearly the same title
            right.append((f"S{k}", title + " revisited", names, 2002, say(k + 5000)))
    a = spark.createDataFrame(left, "row_id bigint, title string, authors array<string>, year bigint, abstract string")
    b = spark.createDataFrame(right, "id string, title string, authors array<string>, year bigint, abstract string")
    got = {(r.row_id, r.id) for r in matching.match(a, b).collect()}
    assert got == {(k, f"R{k}") for k in range(150)}


def test_batches_give_what_one_batch_gives(spark):
    """A later record links two papers of history, a known content comes with a new DOI, and a DOI of a copy is looked up."""
    rows = [
        (1, 1, "Mining sparse glyphs with layered dashboards for archives", ["Ann Bofisk"], 2001, None, "k/1"),
        (2, 1, "Tracing contextual field notes through provenance", ["Eve Falkner"], 2010, None, None),
        (3, 1, "Mining sparse glyphs with layered", ["Ann Bofisk"], 2001, None, "k/9"),
        (4, 2, "Tracing contextual field notes through provenance", ["Eve Falkner"], 2010, "10.1234/b", None),
        (5, 3, "Tracing contextual fieldnotes through provenence", ["Eve Falkner"], 2010, "10.1234/b", None),
        (6, 4, "Mining sparse glyphs with layered dashboards", ["Ann Bofisk"], 2001, None, "k/1"),
        (7, None, "Mining sparse glyphs with layered dashboards", ["Ann Bofisk"], 2001, None, None),
    ]
    df = spark.createDataFrame(rows, "row_id bigint, batch_id int, title string, authors array<string>, year bigint, doi string, dblp_key string")
    got = {tuple(r) for r in dedupe.find_repeats(df).collect()}
    assert got == {tuple(r) for r in dedupe.find_repeats(df, batch=None).collect()}
    assert {(2, 4), (2, 5), (1, 6), (1, 7)} <= got


def test_whole_abstracts_are_judged(spark):
    long = "Glyphs " + " ".join(f"number{i}" for i in range(60)) + " end."
    sound = "We study how people read. " + "It works well in most cases that we saw. " * 12
    cases = {
        "copy of a long title": (long, long[:-1], False), "sound": (sound, "Title", True), "cut": (sound[:-3] + "...", "Title", False), "notice first": ("There is no abstract available for this paper. " + sound, "T", False),
        "notice word later": (sound + "This does not need an abstract model.", "T", True), "abstract not available": ("Abstract not available.", "T", False), "few words": ("Too short here.", "T", False), "blank": ("  ", "T", False), "null": (None, "T", False),
        "with spaces": ("One" + " " * 300 + "other readers found the longer passages harder.", "T", True),
    }
    df = spark.createDataFrame([(k, a, t, ["x"], ["y"]) for k, (a, t, _) in cases.items()], "k string, a string, t string, au array<string>, kw array<string>")
    ok = survivorship.abstract_is_complete(*(df[c] for c in ("a", "t", "au", "kw")))
    assert {r.k: r.ok for r in df.select("k", ok.alias("ok")).collect()} == {k: v[2] for k, v in cases.items()}


def test_records_of_trusted_sources_survive(spark):
    whole = "A first sentence that is whole. And a second one"
    rows = [row(1, T1, ["Ann Bofisk"], 2001, abstract=whole + ".", keywords=["a"], count=5, day=9), row(2, T1, ["Ann Bofisk"], 2001, abstract=whole + ", which is longer.", keywords=["a", "b"], count=7, day=2), row(3, T1, ["Ann Bofisk"], 2001, abstract="cut...", count=-1)]
    df = spark.createDataFrame(rows, COLUMNS).withColumn("source", F.when(F.col("row_id") == 2, "B").otherwise("A"))
    trust = spark.createDataFrame([("A", 2), ("B", 1)], "source string, priority int")
    assert survivorship.surviving_records(df).collect()[0][1:] == (whole + ", which is longer.", 5, ["a", "b"])
    assert survivorship.surviving_records(df, trust=trust).collect()[0][1:] == (whole + ".", 5, ["a"])
    assert survivorship.survivors(df, trust=trust).collect()[0][1:] == (1, 1, 1)


def test_candidates_of_one_title_need_a_name_in_common(spark):
    """Many papers of nearly one title: as candidates only what has a name in common up to typing errors, or no names on a side."""
    letters = ["bkm", "dlp", "fgs", "hnt", "jrv", "cwz"]
    name = lambda k: "".join(x[k // 3**i % 3] + "aeiou"[(k + i) % 5] for i, x in enumerate(letters))
    title = "Can sparse search interfaces support mining field notes in archives"
    left = [(k, title, [f"Ann {name(k)}ski", f"Bea {name(k + 40)}berg"], 2000) for k in range(40)] + [(40, title, ["Omar Qwxyqu", "Eve Falkner-Zuqi"], 2000), (41, title, [], 2000)]
    right = [(f"R{k}", title, [f"Cleo {name(k + 400)}holm"], 2001) for k in range(40)]
    right += [("typo", title, ["Omar Qwyxqu"], 2001), ("double", title, ["E. Falkner"], 2001), ("swapped", title, ["Qwxyqu Omar Xu"], 2001), ("nobody", title, None, None)]
    frames = [spark.createDataFrame(rows, f"{key} {kind}, title string, authors array<string>, year bigint") for rows, key, kind in ((left, "row_id", "bigint"), (right, "id", "string"))]
    normal = [records.normal_records(df, key) for df, key in zip(frames, ("row_id", "id"))]
    a, b = (records.contents(n) for n in normal)
    pairs = matching.candidates(a, b).join(a.select(F.col("rep").alias("a"), F.col("first").alias("x")), "a").join(b.select(F.col("rep").alias("b"), F.col("first").alias("y")), "b")
    got = {(r.x, r.y) for r in pairs.select("x", "y").collect()}
    assert {(40, "typo"), (40, "double"), *((k, "nobody") for k in range(42)), *((41, r[0]) for r in right)} <= got
    assert len(got) < 42 + len(right) + 40


def test_pairs_that_share_a_name_are_never_left_out():
    rng = np.random.default_rng(11)
    word = lambda: "".join(rng.choice(list("abcdefgø-"), rng.integers(2, 13))).strip("-") or "ab"

    def mistyped(w):
        for _ in range(rng.integers(0, 3)):
            k = int(rng.integers(0, len(w)))
            w = [w[:k] + w[k + 1 :], w[:k] + "x" + w[k:], w[:k] + "y" + w[k + 1 :], w[:k] + w[k : k + 2][::-1] + w[k + 2 :]][rng.integers(0, 4)] or "ab"
        return w

    lists = []
    for _ in range(150):
        names = [(word(), word() if rng.random() < 0.7 else "") for _ in range(rng.integers(0, 4))]
        other = [(mistyped(f), mistyped(o) if o else "") for f, o in names]
        other = [(o, f) if o and rng.random() < 0.3 else (f[int(rng.integers(0, 3)) :] or f, o) for f, o in other]
        lists += [[f"{f}|{o}" for f, o in names], [f"{f}|{o}" for f, o in other]]
    codes = [fingerprints.name_codes(" ".join(x), {}) for x in lists]
    count = np.array([len(c) for c in codes])
    words = np.cumsum(count) - count, count, np.array([x for c in codes for x in c], dtype=np.int64).view(np.uint64)
    i, j = (x.ravel() for x in np.indices((len(lists), len(lists))))
    may = fingerprints.may_share(words, i, j)
    does = np.array([not lists[x] or not lists[y] or text.names_shared(lists[x], lists[y]) > 0 for x, y in zip(i, j)])
    assert does.sum() > 300 and may[does].all() and (~may).sum() > 1000


def test_texts_are_read_once_and_copies_found_with_markup(spark):
    title, authors, keywords = "Glyphs that people read in the archives", ["Ann Bofisk", "Carl Dremont"], ["sparse data", "field notes", "more words"]
    tag = f"<b style='{'a' * 50}'> "
    cases = {
        "title in tags": (tag * 12 + title + ".", False), "title and a tail": (f"<i>{title}</i>, in the big town.", False), "title among signs": (title + " . " + ". - & " * 100 + ".", False), "authors": (", ".join(authors) + " ; - .", False),
        "keywords": ("; ".join(keywords) + '!")', False), "title twice": (title + " " + title + ".", True), "tags and a text": (tag * 12 + "Quite another text of some words. " * 4, True), "title first": (title + ". " + "They do so more and more. " * 30, True),
        "closed": ("We say at length what people have read there in all those years (and “why.”)", True), "open": ("We say at length what people have read there in all those years (and “why..”)", False), "left out": ("We say at length what people have read there in all those years. [...]", False), "not there": ("- - - - n/a .", False),
    }
    df = spark.createDataFrame([(k, a, title, authors, keywords) for k, (a, _) in cases.items()], "k string, a string, t string, au array<string>, kw array<string>")
    got = df.select("k", survivorship.abstract_is_complete(*(df[c] for c in ("a", "t", "au", "kw"))).alias("ok"))
    assert {r.k: r.ok for r in got.collect()} == {k: v[1] for k, v in cases.items()}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("translate(") == 1 and plan.count("levenshtein(") == 1
