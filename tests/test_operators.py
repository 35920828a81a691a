from pyspark.sql import functions as F

from citeloom.operators import changes, enrich, filters, merge, retrieval, stats
from citeloom.streaming import incremental

P = "paper_uid string, dblp_key string, doi string, title string, abstract string, authors array<string>, keywords array<string>, source string, dblp_source string, year bigint, citation_count bigint, full_paper boolean"


def papers(spark, *rows):
    names = [c.split()[0] for c in P.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], P)


def test_grouping_sets_keep_null_years_apart(spark):
    rows = papers(spark, {"source": "A", "dblp_source": "a", "year": 2000, "doi": "10.1/x", "abstract": "t"}, {"source": "A", "dblp_source": "a", "year": None}, {"source": " "})
    got = {(r.stat_type, r.source, r.year): (r.paper_count, r.complete_count) for r in stats.grouping_sets(rows).collect() if r.stat_type != "source_dblp_completeness"}
    assert got == {("source_year", "A", 2000): (1, 1), ("source_year", "A", None): (1, 0), ("source_year", "Unknown", None): (1, 0), ("source_summary", "A", None): (2, 1), ("source_summary", "Unknown", None): (1, 0)}
    assert stats.grouping_sets(rows.where("1 = 0")).count() == 0


def test_new_record_reasons_in_order(spark):
    old = papers(spark, {"dblp_key": "k1", "doi": "10.1/A"})
    batch = papers(spark, {"paper_uid": "1", "dblp_key": "k1"}, {"paper_uid": "2", "dblp_key": "k2", "doi": "https://doi.org/10.1/a"}, {"paper_uid": "3"}, {"paper_uid": "4", "dblp_key": "k9"}, {"paper_uid": "5", "dblp_key": "bad", "doi": "10.1/a"}, {"paper_uid": "6", "dblp_key": "k8", "title": " Fore  WORD "})
    bad, titles = papers(spark, {"dblp_key": "bad"}), papers(spark, {"title": "foreword"}, {"title": "fore word"})
    got = {r.paper_uid: r.reason for r in filters.classify_new(batch, old, bad, titles).collect()}
    assert got == {"1": "existing_key", "2": "existing_doi", "3": "missing_key", "4": "new", "5": "excluded", "6": "excluded_title"}


def test_first_by_key_keeps_blank_keys(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("", 3), ("", 4), (None, 5)], "k string, n int")
    assert sorted(r.n for r in filters.first_by_key(df, F.col("k"), F.col("n")).collect()) == [1, 3, 4, 5]


def test_merges(spark):
    t = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, n int, s string")
    s = spark.createDataFrame([("b", 9, None), ("c", 3, "z")], "k string, n int, s string")
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    assert rows(merge.upsert(t, s, "k")) == [("a", 1, "x"), ("b", 9, None), ("c", 3, "z")]
    assert rows(merge.upsert_columns(t, s, "k", ["n", "s"])) == [("a", 1, "x"), ("b", 9, "y"), ("c", 3, "z")]
    assert rows(merge.delete(t, s, "k")) == [("a", 1, "x")]
    again = merge.upsert(merge.upsert(t, s, "k"), s, "k")
    assert rows(again) == rows(merge.upsert(t, s, "k"))


def test_versioned_table(spark, tmp_path):
    table = merge.VersionedTable(spark, str(tmp_path / "t"))
    assert not table.exists()
    table.append(spark.createDataFrame([(1, "a")], "k int, v string"), "k")
    before = table.read()
    table.append(spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string"), "k")
    assert sorted(map(tuple, table.read().collect())) == [(1, "a"), (2, "c")]
    assert before.count() == 1
    table.delete(spark.createDataFrame([(1,)], "k int"), "k")
    table.add_column("w", "double")
    assert [tuple(r) for r in table.read().collect()] == [(2, "c", None)]


def test_first_found_and_slices(spark):
    keys = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    one, two = spark.createDataFrame([("a", 1)], "k string, n int"), spark.createDataFrame([("a", 9), ("b", 2), ("b", 3)], "k string, n int")
    assert {tuple(r) for r in merge.first_found(keys, [one, two], "k", ["n"]).collect()} == {("a", 1), ("b", 2), ("c", None)}
    rows = spark.range(10)
    assert filters.numbered_slice(rows, "id", 2, 5).count() == 3
    assert sorted(r.id for r in filters.skip(rows, "id", n=7).collect()) == [7, 8, 9]


def test_change_classes(spark):
    base = {"title": "T", "abstract": "A", "source": "s", "keywords": None, "authors": ["x"]}
    new = papers(spark, *({"paper_uid": str(n), **base, **d} for n, d in enumerate([{}, {"title": " t "}, {"title": "U"}, {"keywords": []}, {"authors": ["y"]}, {}, {}])), {"paper_uid": " "})
    old = papers(spark, *({"paper_uid": str(n), **base} for n in range(6))).withColumn("embedding_model", F.when(F.col("paper_uid") == "5", "m0").otherwise("m")).withColumn("has_embedding", F.lit(True))
    got = {r.paper_uid: r.change for r in changes.classify(new, old, "m").collect()}
    assert got == {"0": "unchanged", "1": "metadata_only_change", "2": "embed_input_change", "3": "unchanged", "4": "metadata_only_change", "5": "embed_input_change", "6": "new"}


def test_enrichment_rules(spark):
    rows = papers(spark, {"paper_uid": "1", "doi": "10.1/a", "abstract": "mine", "keywords": ["k"]}, {"paper_uid": "2", "doi": "10.1/b"}, {"paper_uid": "3"})
    cache = spark.createDataFrame([("10.1/A", "", ["x"], 5), ("10.1/b", "found", None, None)], "doi string, abstract string, keywords array<string>, citation_count bigint")
    got = lambda rule: {r.paper_uid: (r.abstract, r.keywords, r.citation_count) for r in enrich.by_doi(rows, cache, rule).collect()}
    assert got("overwrite") == {"1": ("", ["x"], 5), "2": ("found", None, None), "3": (None, None, None)}
    assert got("prefer")["1"] == ("mine", ["k"], 5) and got("fill")["2"][0] == "found"


def test_best_match_and_ambiguity(spark):
    a = papers(spark, {"paper_uid": "p", "title": "A study of many things", "authors": ["Ann Bo"], "year": 2000}, {"paper_uid": "q", "title": "Quite another study of all", "authors": ["Cy"], "year": 2001})
    b = spark.createDataFrame([("1", "A study of many things", ["Ann Bo"], 2000), ("2", "quite another study of all", ["Cy"], 2001), ("3", "Quite another study of all.", ["Cy"], 2001), ("4", "A study of many things", ["Ann Bo"], 2010)], "id string, title string, authors array<string>, year bigint")
    got = {r.paper_uid: r.reason for r in enrich.best_matches(a, b).collect()}
    assert got == {"p": "near_exact_title", "q": "ambiguous"}


def test_lookup_cascade(spark):
    docs = papers(spark, {"paper_uid": "a", "doi": "10.1234/x", "title": "One"}, {"paper_uid": "b", "title": "Two"})
    docs = docs.unionAll(papers(spark, {"paper_uid": "c", "doi": "https://doi.org/10.9999/z", "title": "Three blind mice"}))
    typed = [(1, "10.1234/x", None), (2, "https://doi.org/10.1234/X", None), (3, None, "Two "), (4, "", "four"), (5, None, None), (6, "doi: 10.9999/Z", None), (7, None, "Thrée: blind mice!"), (8, "10.5/none", "blind men")]
    got = {r.input_id: (r.paper_uid, r.status) for r in retrieval.lookup(spark.createDataFrame(typed, "input_id bigint, doi string, title string"), docs).collect()}
    assert got == {1: ("a", "matched_doi"), 2: ("a", "matched_doi"), 3: ("b", "matched_title"), 4: (None, "missing"), 5: (None, "missing"), 6: ("c", "matched_doi"), 7: ("c", "matched_title"), 8: ("c", "candidate")}


def test_embedder_failures_give_nulls(spark):
    def embedder(texts):
        if "bad" in texts:
            raise ValueError
        return [[float(len(t)), 1.0] for t in texts]

    rows = spark.createDataFrame([("1", "abc"), ("2", "bad")], "paper_uid string, text string")
    got = {r.paper_uid: r.embedding for r in retrieval.embed(rows, embedder, 2, batch=1).collect()}
    assert got == {"1": [3.0, 1.0], "2": None}


def test_streams_agree_with_batch(spark, tmp_path):
    rows = spark.createDataFrame([(1, "k1", "10.1/a"), (2, "k2", None), (3, "k1", None)], "row_id int, dblp_key string, doi string")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    table = merge.VersionedTable(spark, str(tmp_path / "table"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    incremental.accept_stream(stream, table, "dblp_key", str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.dblp_key for r in table.read().collect()) == ["k1", "k2"]
    rows.where("row_id = 2").withColumn("row_id", F.lit(9)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    incremental.accept_stream(stream, table, "dblp_key", str(tmp_path / "cp")).awaitTermination()
    assert table.read().count() == 2


def test_event_windows_stream(spark, tmp_path):
    events = spark.sql("select cast(id as bigint) as event_id, timestamp '2024-01-01' + make_interval(0,0,0,0,0,cast(id * 20 as int),0) as ts, id % 3 as user_id, 'x' as event_type, cast(id as double) as value from range(12)")
    events.coalesce(1).write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "e"))
    got = incremental.run_to_end(incremental.windows(stream, "ts", "event_type", "value"), spark, "win", str(tmp_path / "c"), "complete")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, incremental.windows(events, "ts", "event_type", "value").collect()))
    firsts = incremental.run_to_end(incremental.first_seen_stream(stream, "user_id", "ts"), spark, "firsts", str(tmp_path / "c2"))
    assert firsts.count() == incremental.first_seen(events, "user_id", "ts", "event_id").count() == 3


def test_best_match_finds_all_that_the_rule_accepts(spark):
    """Against every pair: typing errors in every place, unknown years, generic and long titles, with and without shared names."""
    import difflib
    import random
    import re

    rng = random.Random(3)
    words = "query graph visual aligning progressive topic models museum curation rendering scatter network study of for the".split()
    old, new = [], []
    for i in range(60):
        title = " ".join(rng.choices(words, k=rng.choice([1, 2, 4, 6, 9, 70])))
        old.append((f"o{i}", title, rng.sample(["Ann Bo", "Cy Do", "Ed Fu", "Gi Ho"], rng.randint(0, 3)), rng.choice([None, 2000, 2001, 2002, 2003])))
    for i in range(240):
        _, title, authors, year = rng.choice(old)
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(title))
            title = title[:at] + rng.choice(["", "q", title[at] + "x"]) + title[at + 1 :]
        new.append((f"n{i}", title, rng.choice([authors, authors[:1], []]), rng.choice([year, year, None, 2001])))
    a = spark.createDataFrame(new, "paper_uid string, title string, authors array<string>, year bigint")
    b = spark.createDataFrame(old, "id string, title string, authors array<string>, year bigint")
    want = {}
    for u, t, p, y in new:
        for i, s, q, z in old:
            m, n = (re.sub(" +", " ", x).strip() for x in (t, s))
            if not m or not n or (y and z and abs(y - z) > 1):
                continue
            overlap = len({*p} & {*q}) / max(len(p), len(q)) if p and q else 0.0
            r = 1.0 if m == n else difflib.SequenceMatcher(None, m, n).ratio()
            near = bool(y and z)
            if len(m.split()) <= 2 and not overlap:
                continue
            if r >= 0.985 and (near or overlap > 0) or r >= 0.94 and near and overlap >= 0.25 or r >= 0.90 and near and overlap >= 0.5:
                want[u] = max(want.get(u, (0, 0)), (round(r, 4), round(overlap, 4)))
    got = {r.paper_uid: (r.title_similarity, r.overlap) for r in enrich.best_matches(a, b).collect()}
    assert len(want) > 80 and got == want


def test_records_without_a_key_are_never_merged(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("", 2, "y"), (None, 3, "z")], "k string, n int, v string")
    new = spark.createDataFrame([("a", 1, "new"), ("", 2, "p"), ("", 3, "q"), (None, 4, "r"), ("b", 5, "s")], "k string, n int, v string")
    got = sorted((r.n, r.k, r.v) for r in merge.replace_in_place(old, new, "k", "n").collect())
    assert got == [(1, "a", "new"), (2, "", "y"), (3, None, "z"), (5, "", "p"), (6, "", "q"), (7, None, "r"), (8, "b", "s")]


def test_a_found_row_beats_a_known_excluded_one(spark):
    tables = [spark.createDataFrame([("k1", "d2", "second", 2), ("k1", "d1", "first", 1), ("k9", "d9", "stays", 3)], "dblp_key string, doi string, title string, row_id bigint"), spark.createDataFrame([("k1", "d0", "later table"), ("k2", "d3", None)], "dblp_key string, doi string, title string")]
    known = spark.createDataFrame([("k1", "k1", "old", "old"), ("k3", "k3", "kept", "known"), ("k7", "k7", "x", "other")], "key string, dblp_key string, doi string, title string")
    kept, after = merge.move_to_excluded(tables, known, spark.createDataFrame([("k1",), (" k2 ",), ("k3",), ("k4",), (None,), ("",)], "dblp_key string"), ["row_id", None])
    assert {(r.key, r.doi, r.title) for r in after.collect()} == {("k1", "d1", "first"), ("k2", "d3", ""), ("k3", "kept", "known"), ("k4", "", ""), ("k7", "x", "other")}
    assert [r.dblp_key for r in kept[0].collect()] == ["k9"] and kept[1].count() == 0


def test_there_is_always_a_version_and_old_ones_stay(spark, tmp_path):
    table = merge.VersionedTable(spark, str(tmp_path / "t"))
    one = lambda *ks: spark.createDataFrame([(k,) for k in ks], "k int")
    table.append(one(1), "k")
    first = table._parts()
    table.append(one(1, 2), "k")
    # the second version lists the first one's part and one with the new row alone
    assert table._parts()[:1] == first and len(table._parts()) == 2 and table.read().count() == 2 and table.read(1).count() == 1
    stale = merge.VersionedTable(spark, str(tmp_path / "t"))
    stale._versions = lambda: [1]
    try:
        stale.commit(one(7))
        raise AssertionError("a version was overwritten")
    except OSError:
        assert table.read().count() == 2
    table.MOST_PARTS = 2
    table.append(one(3), "k")
    assert len(table._parts()) == 1 and table.read().count() == 3


def test_bm25_finds_what_an_exhaustive_search_finds(spark):
    import math
    import random

    rng = random.Random(5)
    common, rare = ["of", "the", "data", "for"], [f"w{i}" for i in range(40)]
    docs = [(f"d{i:03d}", " ".join(rng.choices(common, k=rng.randint(1, 6)) + rng.choices(rare, k=rng.randint(0, 3)))) for i in range(120)]
    asked = [(i, " ".join(rng.choices(common, k=rng.randint(0, 4)) + rng.choices(rare, k=rng.randint(0, 2)))) for i in range(60)] + [(98, "nothing else"), (99, None)]
    words = {d: t.split() for d, t in docs}
    average, n = sum(map(len, words.values())) / len(words), len(words)
    df = {t: sum(t in w for w in words.values()) for t in common + rare}
    want = {}
    for q, text in asked:
        best = None
        for d, w in words.items():
            terms = [t for t in set((text or "").split()) if t in w]
            if terms:
                s = round(sum(math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * w.count(t) * 2.2 / (w.count(t) + 1.2 * (0.25 + 0.75 * len(w) / average)) for t in terms), 6)
                best = min(best or (0.0, ""), (-s, d))
        if best:
            want[q] = best[1]
    got = {r.q: r.uid for r in retrieval.bm25_top(spark.createDataFrame(asked, "q int, text string"), spark.createDataFrame(docs, "uid string, title string"), "q", "text", "uid", "title").collect()}
    assert got == want


def test_bm25_writes_less_than_its_texts_and_blocks_agree(spark, monkeypatch):
    import math
    import random
    from pathlib import Path

    from citeloom.session import shared_dir

    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(60)]
    text = lambda: " ".join(rng.choices(vocabulary, weights=[1 / (k + 1) for k in range(60)], k=rng.randint(3, 12)))
    docs = [(f"d{i:04d}", text()) for i in range(1500)]
    docs += [(f"e{i:04d}", docs[i][1]) for i in range(200)]
    asked = [(i, docs[7 * i][1]) for i in range(100)] + [(100 + i, text()) for i in range(100)]
    words = {d: t.split() for d, t in docs}
    average, n = sum(map(len, words.values())) / len(words), len(words)
    df = {t: sum(t in w for w in words.values()) for t in vocabulary}
    weight = lambda t, w: math.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * w.count(t) * 2.2 / (w.count(t) + 1.2 * (0.25 + 0.75 * len(w) / average))
    want = {q: min((-round(sum(weight(t, w) for t in set(x.split()) if t in w), 6), d) for d, w in words.items())[1] for q, x in asked}
    queries, table = spark.createDataFrame(asked, "q int, text string"), spark.createDataFrame(docs, "uid string, title string")
    size = lambda: sum(p.stat().st_size for p in Path(shared_dir(spark).removeprefix("file:")).rglob("*.parquet"))
    find = lambda **more: {r.q: r.uid for r in retrieval.bm25_top(queries, table, "q", "text", "uid", "title", **more).collect()}
    before = size()
    assert find() == want
    assert size() - before < sum(len(t) for _, t in docs)
    assert find(index=retrieval.weights(table, "uid", "title")) == want
    monkeypatch.setattr(retrieval, "DOCUMENTS", 300)
    monkeypatch.setattr(retrieval, "ASKED", 60)
    assert find() == want


def test_similar_titles_against_all_pairs(spark):
    import random

    rng = random.Random(8)
    title = lambda: " ".join(rng.choices("of the a data graph tree map query user text".split(), k=rng.randint(0, 9)))
    a = [(i, title(), rng.choice([2000, 2001])) for i in range(120)]
    b = [(f"o{i}", title(), rng.choice([2000, 2001])) for i in range(120)]
    want = set()
    for i, t, y in a:
        for o, u, z in b:
            x, w = set(t.split()), set(u.split())
            if y == z and x and w and len(x & w) / len(x | w) >= 0.7:
                want.add((i, o))
    got = enrich.similar_titles(spark.createDataFrame(a, "row_id int, title string, year int"), spark.createDataFrame(b, "id string, title string, year int"), "row_id", "id", 0.7)
    assert len(want) > 20 and {(r.row_id, r.id) for r in got.collect()} == want


def test_loading_options(spark):
    from citeloom.operators import load

    rows = papers(spark, {"paper_uid": "1", "doi": " 10.1/a ", "title": " t ", "abstract": " ", "authors": [" A B 0001", "a b", ""], "year": None}, {"title": "x" * 5000, "keywords": ["k"] * 300, "abstract": "long", "year": 2001})
    one, two = load.to_entity(rows).orderBy("title").collect()
    assert (one.doi, one.abstract, one.authors, one.authors_normalised, one.year, one.has_doi, one.has_abstract) == ("10.1/a", None, ["A B 0001", "a b"], ["a b"], 0, True, False)
    assert len(two.title) == 4096 and len(two.keywords) == 256 and two.paper_uid.startswith("fallback:") and two.has_abstract
    assert load.to_load(rows, ("title",), skip_missing_doi=True).count() == 1
    there = spark.createDataFrame([("1",)], "paper_uid string")
    for bad in ({}, {"resume": True, "skip": 5}):
        try:
            load.to_load(rows, ("title",), there, **bad)
            raise AssertionError("not refused")
        except ValueError:
            pass
    assert load.to_load(rows, ("title",), there, resume=True).count() == 1
    assert load.to_load(rows, ("title",), there, allow_non_empty=True).count() == 1


def test_gaps_are_filled_and_a_found_doi_renames(spark):
    rows = spark.sql("select 'u' as paper_uid, '' as doi, cast(null as string) as abstract, array() as keywords, cast(null as bigint) as citation_count, named_struct('doi', 'https://doi.org/10.1/AB', 'abstract', ' a  b ', 'keywords', array('k'), 'citation_count', 3L) as found union all select 'v', '10.2/x', 'mine', array('m'), 1L, named_struct('doi', '10.3/y', 'abstract', 'other', 'keywords', array('o'), 'citation_count', 9L) union all select 'w', null, null, null, null, null")
    got = {tuple(r[c] if c != "keywords" else tuple(r[c] or ()) for c in ("paper_uid", "doi", "abstract", "keywords", "citation_count")) for r in enrich.apply_found(rows).collect()}
    assert got == {("doi:10.1/ab", "10.1/AB", "a b", ("k",), 3), ("v", "10.2/x", "mine", ("m",), 1), ("w", None, None, (), None)}


def test_cosine_blocks_give_what_one_block_gives(spark):
    import numpy as np

    x = np.random.default_rng(2).standard_normal((60, 8))
    df = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(60)], "id bigint, v array<float>")
    rows = lambda block: {tuple(r) for r in retrieval.cosine_top(df, df, "id", "v", 3, block, 8).collect()}
    assert rows(1000) == rows(7) and len(rows(7)) == 180


def test_bad_vectors_end_the_query(spark):
    import pytest

    make = lambda *vs: spark.createDataFrame([(str(i), v) for i, v in enumerate(vs)], "k string, embedding array<float>")
    assert changes.checked_vectors(make([1.0, 2.0], None, []), 2).count() == 1
    for bad, why in (([1.0], "of 1 numbers"), ([1.0, float("nan")], "not finite")):
        with pytest.raises(Exception, match=why):
            changes.checked_vectors(make([1.0, 2.0], bad), 2).collect()


def test_a_kept_model_places_only_what_changed(spark, tmp_path):
    import random

    rng = random.Random(1)
    rows = spark.createDataFrame([(f"k{i:02d}", [rng.random() for _ in range(4)]) for i in range(20)], "k string, v array<double>")
    path = str(tmp_path / "model")
    first = retrieval.project(rows, "k", "v", model_path=path)
    changed = rows.where("k < 'k03'").withColumn("v", F.transform("v", lambda x: x + 1))
    after = {r.k: (round(r.x, 9), round(r.y, 9)) for r in retrieval.project_more(changed, "k", "v", path, first).collect()}
    before = {r.k: (round(r.x, 9), round(r.y, 9)) for r in first.collect()}
    assert len(after) == 20 and {k for k in after if after[k] != before[k]} == {"k00", "k01", "k02"}
