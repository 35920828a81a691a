"""Problems 7 to 9."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from citeloom.llm import packing, quality, tokens

PROSE = "We describe how readers can find their way through large collections of papers. The results show that this is faster than before, but it needs more care. "


@pytest.fixture(scope="module")
def enc():
    return tokens.encoder(tokens.vocabulary())


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["ab", "\n", "  ", "'s", "'", "'re", "'ve", "'ll", "ading", "''", "12", "é", " x", "😀", "中文", "--", "\t", "<|endoftext|>", "qqqq"]), max_size=60), st.integers(2, 25))
def test_joined_leaves_encode_exactly(parts, leaf):
    enc, text = tokens.encoder(tokens.vocabulary()), "".join(parts)
    cut = tokens.leaves(text, leaf)
    assert "".join(p for p, _ in cut) == text
    assert tokens.encode_parts(enc, cut) == enc.encode_ordinary(text)


def test_contractions_at_every_cut(enc):
    for text in ("x'reading", "x'velvet y'llama", "'re're're've'll", "a''reading'", " 'relay 'lll", "x'r'eading"):
        for leaf in range(1, len(text)):
            assert tokens.encode_parts(enc, tokens.leaves(text, leaf)) == enc.encode_ordinary(text), (text, leaf)


def test_ids(spark, enc):
    random.seed(2)
    texts = [None, "", " ", "a <|endoftext|> b", "x" * 50_000, "".join(random.choice("abcdefg'1-") for _ in range(60_000)), PROSE * 400, "中文" * 9_000]
    df = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)], "doc_id bigint, text string, ids string")
    got = {r.doc_id: r.ids for r in tokens.encode(df, leaf=1000).collect()}
    assert got == {i: enc.encode_ordinary(t) if t else [] for i, t in enumerate(texts)}
    assert [enc.decode(got[i]) for i in (4, 5, 6, 7)] == texts[4:]
    assert tokens.encode(df.where("1 = 0")).count() == 0


def test_packing(spark):
    random.seed(3)
    rows = [(i, random.choice(["a", "a", "b", None]), int(random.expovariate(1 / 60)) + 1) for i in range(3000)] + [(9001, "a", 0), (9002, "b", None), (9003, "b", 1000), (9004, "a", 256)]
    counts = spark.createDataFrame(rows, "doc_id bigint, source string, tokens bigint")
    windows = spark.createDataFrame([("w", 256), ("none", 0)], "window_name string, capacity_tokens int")
    out = packing.pack(counts, windows, shard_containers=64).toPandas()
    assert out.groupby(["shard", "container"]).tokens.sum().max() <= 256
    sizes = out.groupby("doc_id").tokens.sum()
    assert set(sizes.index) == {r[0] for r in rows} and all(sizes[i] == (t or 0) for i, _, t in rows)
    assert (out.groupby("doc_id").size() > 1).sum() == (sizes > 256).sum() and len(out[out.doc_id == 9003]) == 4
    boxes = out.groupby(["shard", "container"]).tokens.sum()
    assert boxes.sum() / (256 * len(boxes)) > 0.93
    share = out[out.source == "a"].tokens.sum() / out.tokens.sum()
    # over the run of containers, shard after shard, the mixture stays near its target
    run = out.sort_values(["shard", "container"])
    sums = (run.tokens * (run.source == "a")).cumsum() / run.tokens.cumsum()
    assert (sums[len(sums) // 10 :] - share).abs().max() < 0.05
    assert packing.pack(counts.where("1 = 0"), windows).count() == 0
    assert packing.room_left(packing.pack(counts, windows)).count() == 1


def test_not_prose(spark):
    table = "\n".join(f"name{k}\t{k * 7}\t0.{k}\t-" for k in range(40))
    lists = "\n".join(f"- layered glyphs {k}" for k in range(40))
    markup = "\n".join(f'<article key="conf/x/{k}"><author>Ann Bo</author><year>2001</year></article>' for k in range(20))
    wrapped = (PROSE * 3).replace(" can ", "\ncan ").replace(" that ", "\nthat ")
    german = "Wir stellen ein Verfahren vor, mit dem die Daten besser verstanden werden. Die Ergebnisse zeigen, dass es schneller ist. "
    chinese = "本文提出了一种语义地图，用于帮助研究者更好地理解洪水预警。我们通过观察，研究了城市规划者如何使用层次化图表。"
    cases = [PROSE * 4, PROSE.upper() * 2, PROSE.lower() * 8, wrapped, german * 3, chinese * 3, table, lists, markup, PROSE + "\n\n" + table * 3, None, "", " \n ", table * 60, "x"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(cases * 20)], "doc_id bigint, text string, words int")
    stats = quality.text_statistics(df)
    found = {r.doc_id % len(cases) for r in quality.not_prose(stats).collect()}
    assert {6, 7, 8, 9, 13} <= found and not found & {0, 1, 2, 3, 4, 5, 10, 11, 12}
    zero = stats.where("doc_id = 10").first()
    assert zero.words == 0 and zero.lines == 0 and zero.prose == 0.0
    assert quality.text_statistics(df.where("1 = 0")).count() == 0


def test_shares_add_up(spark):
    df = spark.createDataFrame([(1, PROSE + "\n- a\n- b\n1;2;3")], "doc_id bigint, text string")
    r = quality.text_statistics(df).first()
    assert abs(r.prose + r.list + r.table + r.junk - 1) < 1e-9 and 4 < r.mean_word_length < 6 and r.words == 29


def test_mixture_follows_targets_until_a_source_runs_out(spark):
    random.seed(4)
    rows = [(i, "big" if i % 10 else "small", random.randint(5, 40)) for i in range(6000)]
    counts = spark.createDataFrame(rows, "doc_id bigint, source string, tokens bigint")
    windows = spark.createDataFrame([("w", 256)], "window_name string, capacity_tokens int")
    target = spark.createDataFrame([("big", 0.8), ("small", 0.2)], "source string, share double")
    out = packing.pack(counts, windows, target, shard_containers=128)
    far = {r.tenth: r.distance for r in packing.mixture(out, target, 8).collect()}
    own = {r.tenth: r.distance for r in packing.mixture(out, packing.own_shares(counts), 8).collect()}
    # a fifth is asked of what is a tenth: in each shard the first containers keep to it, the last ones have none left
    assert far[0] < 0.05 < own[0] and far[9] > 0.15
    assert out.count() >= 6000 and packing.mixture(packing.pack(counts, windows), packing.own_shares(counts), 16).agg({"distance": "max"}).first()[0] < 0.1


def test_prefix_sums_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANGE", 4)
    rows = [(k, s, (s * 7 + len(k)) % 11) for k in ("a", "bb") for s in range(0, 30, 1 + len(k))]
    got = {(r.k, r.shard): r.past for r in packing._before(spark.createDataFrame(rows, "k string, shard int, v bigint"), ["k"], "v", "past").collect()}
    assert got == {(k, s): sum(v for k2, s2, v in rows if k2 == k and s2 < s) for k, s, _ in rows}
