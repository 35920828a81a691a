"""Problems 4 to 6."""

import numpy as np
import pyarrow as pa

from citeloom.llm import canonical, names, vectors


def test_names_of_one_person(spark):
    lists = [["Anneli B. Kortelund", "Kortelund, Anneli B.", "A. B. Kortelund", "ANNELI B. KORTELUND", "Anmeli B. Kortelund", "Dr. Anneli B. Kortelund"], ["Anneli C. Kortelund", None, "", "et al.", "Anonymous"], ["Robert Vandresso 0001", "Bob Vandresso 0001", "Robert Vandresso 0002"], ["Anneli B. Kortelund"], None]
    df = spark.createDataFrame([(x, 1) for x in lists], "authors array<string>, name int")
    got = {tuple(r) for r in names.variant_pairs(df).collect()}
    person = sorted(lists[0])
    assert {(a, b) for i, a in enumerate(person) for b in person[i + 1 :]} | {("Bob Vandresso 0001", "Robert Vandresso 0001")} == got
    assert names.variant_pairs(df.where("1 = 0")).count() == 0


def test_near_index_against_brute_force(spark):
    words = ["kortelund", "kortelnud", "kortelun", "vandresso", "vandreso", "smith", "smyth", "ab", "abc", "dremont", "drernont"]
    got = {tuple(r) for r in names.near_index(spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    assert got == {(a, b) for a in words for b in words if names.near_words(a, b)}


def test_name_judgements():
    same = lambda a, b: names.same_person(names.parse(a), names.parse(b))
    assert same("Ann Kortelund", "Kortelund Ann") == 3 and same("Ann Kortelund", "A. Kortelund") == 1
    assert same("Ann B. Kortelund", "Ann Kortelund") == 2 and same("Ann B. Kortelund", "Ann C. Kortelund") == 0
    assert same("Ann Kortelund 0001", "Ann Kortelund 0002") == 0 and same("Elizabeth Kortelund", "Beth Kortelund") == 3
    assert names.parse("Anonymous")[0] == [] and same("Ann Kortelund", "et al.") == 0


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((60, 128))
    x = (centres[rng.integers(0, 60, 900)] + 0.35 * rng.standard_normal((900, 128))) * rng.uniform(0.1, 9, (900, 1))
    rows = [(f"u{i:04d}", [float(v) for v in x[i]], "m" if i % 10 else "n", i) for i in range(900)]
    bad = [("z1", None, "m", 0), ("z2", [1.0] * 64, "m", 0), ("z3", [0.0] * 128, "m", 0), ("z4", [float("nan")] * 128, "m", 0), ("z5", [], "m", 0)]
    df = spark.createDataFrame(rows + bad, "paper_uid string, embedding array<float>, embedding_model string, id int")
    got = {(r.uid_a, r.uid_b) for r in vectors.close_pairs(df).collect()}
    want = set()
    for model in "mn":
        at = [i for i in range(900) if rows[i][2] == model]
        u = x[at].astype(np.float32).astype(float)
        u /= np.linalg.norm(u, axis=1, keepdims=True)
        c = u @ u.T
        np.fill_diagonal(c, -2)
        for i, j in enumerate(np.argsort(-c, axis=1)[:, :5]):
            want |= {tuple(sorted((rows[at[i]][0], rows[at[k]][0]))) for k in j if c[i, k] >= 0.8}
    assert len(want) > 500 and len(got & want) / len(want) >= 0.98 and len(got & want) / len(got) >= 0.98
    assert vectors.close_pairs(df.where("1 = 0")).count() == 0


def test_crowded_cells_are_cut_into_blocks(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal(128) + 0.5 * rng.standard_normal((300, 128))
    df = spark.createDataFrame([(i, "m", [float(v) for v in x[i]]) for i in range(300)], "id bigint, model string, vector array<float>")
    whole = {(r.id, r.other) for r in vectors.neighbours(df, 3).collect()}
    parts = {(r.id, r.other) for r in vectors.neighbours(df, 3, block=40).collect()}
    assert len(whole) == 900 and len(whole & parts) > 880


def test_error_bounds_hold():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((400, 128)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = np.concatenate([np.stack([a, b]) for a, b, _ in vectors.search_cell(np.arange(400), x, x, np.arange(400), 5, vectors.rotation(128))], axis=1)
    c = x @ x.T
    np.fill_diagonal(c, -2)
    want = {(i, j) for i in range(400) for j in np.argsort(-c[i])[:5]}
    assert len(want & set(zip(*got.tolist()))) / len(want) > 0.99


ENTRIES = [("GLYPHON", "GLYPHON"), ("GLYPHON", "GLYPHON (Posters)"), ("JCPD", "J. Chart Percept. Des."), ("MOTIFA", "MOTIFA")]
LONG = [("GLYPHON", "International Conference on Glyph Design and Notation"), ("JCPD", "Journal of Chart Perception and Design"), ("MOTIFA", "Workshop on Motion and Trajectory Analysis")]


def test_venues(spark):
    typed = ["Proc. of the 3rd Int'l Conf. on Glyph Desing &amp; Notation '98", "glyphon2001 poster session", "J Chart Percept Des, 3:1", "Motion and Trajectory Analysis (Wkshp)", "Journal of Chart Navigation at Sea", "n/a", " ", None, "GLYPHON" * 2000]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(typed)], "input_id bigint, dblp_source string, source string")
    entries, long = spark.createDataFrame(ENTRIES, "source string, dblp_source string"), spark.createDataFrame(LONG, "abrv string, full_name string")
    got = {r.input_id: r.dblp_source for r in canonical.map_column(df, "input_id", "dblp_source", entries, long).collect()}
    assert got == {0: "GLYPHON", 1: "GLYPHON (Posters)", 2: "J. Chart Percept. Des.", 3: "MOTIFA", 4: "", 5: "", 8: ""}
    assert {r.value for r in canonical.misses(df, "dblp_source", entries, long).collect()} == {typed[4], "n/a", typed[8]}
    assert canonical.map_column(df.where("1 = 0"), "input_id", "dblp_source", entries, long).count() == 0


def test_weighted_distance():
    d = canonical.weighted_distance
    assert d("abc", "abc") == 0 and d("abc", "acb") == 0.7 and d("abc", "abbc") == 0.6 and d("abc", "abp") == 1 and d("gas", "gad") == 0.7 and d("", "ab") == 2


def test_words_of_a_name_are_assigned_one_to_one():
    same = lambda a, b: names.same_person(names.parse(a), names.parse(b))
    assert same("Ann Beth Kortelund", "Ann Bob Kortelund") == 0 and same("Maria Garcia Lopez", "Maria Gonzalez Lopez") == 0
    assert same("Lopez Maria Garcia", "Garcia Lopez Maria") == 3 and same("Ann B. Kortelund", "Ann Beth Kortelund") == 2
    assert same("Ann Kortelund", "Ann Kortelund-Smid") == 1 and same("Robert Kortelund", "Bob Kortelnud") == 3
    left, cost, pairs = names.assign(["maria", "garcia", "b"], ["garcai", "bella", "mari"])
    assert left == 0 and set(pairs) == {("maria", "mari"), ("garcia", "garcai"), ("b", "bella")}
    assert names.assign([], ["a"]) == (0, 0, []) and names.assign(["ann"], ["bob"])[0] == 1


def test_links_do_not_depend_on_how_common_a_name_is(spark):
    letters = "abcdefghiklmnoprstuvwxz"
    for others in (5, 60, 3000):
        crowd = ["".join(letters[(i * 7 + k * (3 + i // 23)) % 23] for k in range(7)).capitalize() + letters[i % 23] + letters[i // 23 % 23] + letters[i // 529 % 23] + " Kortelund" for i in range(others)]
        df = spark.createDataFrame([([n],) for n in ["Robert Kortelund", "Bob Kortelnud", "J. Kortelund", "Jürgen Kortelund", *crowd]], "authors array<string>")
        got = {tuple(r) for r in names.variant_pairs(df).collect()}
        assert ("Bob Kortelnud", "Robert Kortelund") in got, others


def test_near_words_that_are_both_names_are_no_errors(spark):
    first = ["Wei", "Jun", "Lan", "Hao", "Min", "Qiang", "Tao"]
    df = spark.createDataFrame([([f"{g} {f}"],) for g in first for f in ("Zhang", "Zheng")] + [(["Tao Zhagn"],)], "authors array<string>")
    assert {tuple(r) for r in names.variant_pairs(df).collect()} == {("Tao Zhagn", "Tao Zhang")}


def test_long_words_are_looked_up_and_only_hits_are_scored():
    d = canonical.Dictionary([("IVK", "Informationsvisualisierungskonferenz"), ("GDN", "Glyph Notes"), ("GDX", "Glyph Notes X"), ("GDX", "Glyph Notes X (Posters)")], [])
    assert d.find("Informationsvisualisierungskonferemz")[0] == "IVK" and d.find("x" * 5000)[:2] == ("", "") and d.find("")[:2] == ("", "")
    seen = []
    cover = d._cover
    d._cover = lambda words, near, variant: seen.append(variant) or cover(words, near, variant)
    assert d.find("glyph nots")[0] == "GDN" and all({"glyph", "notes"} & set(v) for v in seen)
    # of words equally near the more frequent one in the list comes first
    e = canonical.Dictionary([("A", "mottos plain"), ("B", "mostos other"), ("C", "mostos third")], [])
    assert list(e.near("mottod", False))[:1] == ["mottos"] and list(e.near("mostxs", False))[0] == "mostos"


def test_reference_lists_have_a_bound(spark, monkeypatch):
    import pytest

    monkeypatch.setattr(canonical, "MOST_ENTRIES", 2)
    entries, long = spark.createDataFrame(ENTRIES, "source string, dblp_source string"), spark.createDataFrame(LONG, "abrv string, full_name string")
    with pytest.raises(ValueError, match="more than 2 rows"):
        canonical.misses(entries, "dblp_source", entries, long)


def test_equal_vectors_are_searched_once(spark):
    rng = np.random.default_rng(6)
    base = rng.standard_normal((3, 128))
    x = [base[0]] * 9 + [base[0] + 0.01 * base[1]] * 2 + [base[2]]
    df = spark.createDataFrame([(f"u{i:02d}", [float(v) for v in x[i]], "m") for i in range(12)], "paper_uid string, embedding array<float>, embedding_model string")
    got = {(r.uid_a, r.uid_b) for r in vectors.close_pairs(df).collect()}
    near = lambda i: [j for j in sorted(range(12), key=lambda j: (-round(float(x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j])), 9), j)) if j != i][:5]
    want = {tuple(sorted((f"u{i:02d}", f"u{j:02d}"))) for i in range(12) for j in near(i) if x[i] @ x[j] / np.linalg.norm(x[i]) / np.linalg.norm(x[j]) >= 0.8}
    assert got == want


def test_two_levels_of_cells(spark):
    rng = np.random.default_rng(9)
    centres = rng.standard_normal((80, 128))
    x = centres[rng.integers(0, 80, 1600)] + 0.35 * rng.standard_normal((1600, 128))
    df = spark.createDataFrame([(i, "m", [float(v) for v in x[i]]) for i in range(1600)], "id bigint, model string, vector array<float>")
    assert len(vectors.fit_cells(df, cell=4, fit_rows=300).second) > 1
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    c = u @ u.T
    np.fill_diagonal(c, -2)
    want = {(i, int(j)) for i in range(1600) for j in np.argsort(-c[i])[:5] if c[i, j] >= 0.8}
    found = {(r.id, r.other) for r in vectors.neighbours(df, 5, least=0.8, cell=4, probes=8).collect()}
    assert len(want & found) / len(want) >= 0.9


def test_close_vectors_share_cells_when_there_are_many(spark):
    rng = np.random.default_rng(11)
    base = rng.standard_normal((40_000, 128)) * np.exp(-np.arange(128) / 60)
    near = base[:4_000] + 0.45 * rng.standard_normal((4_000, 128)) * np.exp(-np.arange(128) / 60)
    unit = lambda x: (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    base, near = unit(base), unit(near)
    close = (base[:4_000] * near).sum(axis=1) >= 0.8

    class Many:
        """Stands for three million vectors, of which the sample is taken."""

        count = lambda self: 3_000_000
        where = select = limit = lambda self, *a: self

        def toArrow(self):
            return pa.table({"vector": pa.array(list(base[-vectors.FIT_ROWS :]), pa.list_(pa.float32()))})

    cells = vectors.fit_cells(Many())
    one, two = (cells.nearest(x[close], vectors.PROBES) for x in (base[:4_000], near))
    found = (one == two[:, :1]).any(axis=1) | (two == one[:, :1]).any(axis=1)
    assert close.sum() > 2_000 and found.mean() > 0.9
