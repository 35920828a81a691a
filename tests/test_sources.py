import gzip
import json

from citeloom.schemas import PAPER, schema
from citeloom.sinks import writers
from citeloom.sources import readers

DUMP = """<?xml version="1.0"?><dblp>
<article key="journals/a/1"><author>A. B&uuml;r</author><title>On <i>k</i>-means &amp; more.</title><journal>J. X</journal><year>2001</year><ee>http://a</ee><ee>https://doi.org/10.1/q</ee></article>
<www key="homepages/1"><title>no</title></www>
<inproceedings key="conf/b/2"><author>C</author><author>D</author><title>Two</title><booktitle>CONF</booktitle><year>2002</year></inproceedings>
</dblp>"""


def test_record_dump_in_ranges_and_gzip(spark, tmp_path):
    spark.dataSource.register(readers.DumpSource)
    (tmp_path / "d.xml").write_text(DUMP)
    with gzip.open(tmp_path / "d.xml.gz", "wt") as f:
        f.write(DUMP)
    for path, step in (("d.xml", 40), ("d.xml", 10**6), ("d.xml.gz", 10)):
        rows = spark.read.format("record_dump").option("path", str(tmp_path / path)).option("range_bytes", step).load().orderBy("dblp_key").collect()
        assert [r.dblp_key for r in rows] == ["conf/b/2", "journals/a/1"]
        assert rows[1].title == "On k-means & more." and rows[1].authors == ["A. Bür"] and rows[0].authors == ["C", "D"]
    venues = spark.createDataFrame([("X", "J. X", "yes")], "source string, dblp_source string, full_paper string")
    paper = readers.paper_records(spark.read.format("record_dump").option("path", str(tmp_path / "d.xml")).load(), venues).collect()
    assert [(p.paper_uid, p.source, p.full_paper) for p in paper] == [("doi:10.1/q", "X", True)]


def test_json_lists_and_values(spark, tmp_path):
    (tmp_path / "j").mkdir()
    (tmp_path / "j/a.json").write_text(json.dumps([{"paper_uid": "1", "year": "2001"}, {"paper_uid": "2"}]))
    (tmp_path / "j/_skip.json").write_text(json.dumps([{"paper_uid": "3"}]))
    assert sorted(r.paper_uid for r in readers.json_arrays(spark, str(tmp_path / "j"), PAPER).collect()) == ["1", "2"]
    (tmp_path / "v.txt").write_text('# note\nk1\n "k2"\n{"dblp_key": "k3"}\n\nk1\n')
    assert sorted(r[0] for r in readers.value_list(spark, str(tmp_path / "v.txt")).collect()) == ["k1", "k2", "k3"]


def test_free_csv_and_pipe_table(spark, tmp_path):
    (tmp_path / "f.csv").write_text('Title,Title,,Paper DOI\n"a, ""b""\nc",x,y,10.1/z\n,,,\n')
    rows = readers.free_csv(spark, str(tmp_path / "f.csv"))
    assert rows.columns == ["Title", "Title_2", "column_3", "Paper DOI"]
    assert [r[0] for r in rows.collect()] == ['a, "b"\nc']
    assert readers.guess_columns(rows.columns) == {"doi": "Paper DOI", "title": "Title"}
    (tmp_path / "t.md").write_text("| abrv | full |\n|---|---|\n| A | Alpha |\n")
    assert [tuple(r) for r in readers.pipe_table(spark, str(tmp_path / "t.md"), ["abrv", "full"]).collect()] == [("A", "Alpha")]


def test_saved_results(spark, tmp_path):
    (tmp_path / "r.csv").write_text("status,similarity,paper_uid\nmatched,87.5%,a\nmatched,0.4,b\nmissing,,\n")
    assert [r.similarity for r in readers.saved_results(spark, str(tmp_path / "r.csv")).collect()] == [0.875, 0.4, 0.0]


def test_writers(spark, tmp_path):
    rows = spark.createDataFrame([("b", "S 1"), ("a", "s-1"), (None, "S/1")], "k string, source string")
    writers.sorted_values(rows, "k", str(tmp_path / "k"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "k")).collect()] == ["a", "b"]
    names = {r.source: r.file_name for r in writers.file_names(rows, "source").collect()}
    assert len({n.lower() for n in names.values()}) == 3
    writers.partitioned_json(rows, str(tmp_path / "p"), "source")
    assert spark.read.schema(schema("k string, source string")).json(str(tmp_path / "p")).count() == 3
    cache = spark.createDataFrame([("d1", "found"), ("d2", "error")], "doi string, status string")
    assert writers.grow_cache(spark, cache, str(tmp_path / "c"), "doi", ("found",)).count() == 1
    assert writers.grow_cache(spark, cache, str(tmp_path / "c"), "doi", ("found",)).count() == 1
    assert writers.markdown(cache.where("doi = 'd1'")) == "| doi | status |\n|---|---|\n| d1 | found |"


def test_batch_states_read_the_hidden_file(spark, tmp_path):
    for name, uid in (("enriched/a.json", "1"), ("missing/b.json", "2"), ("missing/_missing_doi.json", "3")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(json.dumps([{"paper_uid": uid}]))
    got = {(r.paper_uid, r.state, r.file_name) for r in readers.batch_states(spark, str(tmp_path)).collect()}
    assert got == {("1", "enriched", "a.json"), ("2", "missing_abstract", "b.json"), ("3", "missing_doi", "_missing_doi.json")}
    assert readers.batch_states(spark, str(tmp_path), missing_doi=False).count() == 2


def test_value_lists_of_every_form(spark, tmp_path):
    import pytest

    read = lambda name, text, **k: ((tmp_path / name).write_text(text), sorted(tuple(r) for r in readers.value_list(spark, str(tmp_path / name), **k).collect()))[1]
    assert read("a.json", '["k/1", "k/2", {"dblp_key": "k/3"}, {"x": 1}, null]') == [("k/1",), ("k/2",), ("k/3",)]
    assert read("b.txt", 'z\n#c\na "b"\nz\n', ordered=True) == [('a "b"', 2), ("z", 0)]
    for bad in ('"k2",', '{"dblp_key": ', '"open'):
        with pytest.raises(Exception, match="invalid JSON line"):
            read("c.txt", f"k1\n{bad}\n")


def test_venue_list_is_read_strictly(spark, tmp_path):
    import pytest

    def read(text):
        (tmp_path / "v.csv").write_text("source,dblp_source,Full paper\n" + text)
        return sorted(tuple(r) for r in readers.venue_map(spark, str(tmp_path / "v.csv")).collect())

    assert read("A, a  b ,Yes\nB,b,n\n") == [("A", "a b", True), ("B", "b", False)]
    for bad, why in (("A,a,maybe\n", "neither yes nor no"), ("A,a,yes\nB,a,yes\n", "several sources")):
        with pytest.raises(Exception, match=why):
            read(bad)


def test_columns_of_a_look_up_list(spark):
    assert readers.guess_columns(["Venue", "Name", "Pub Year", "DOI link", "dblp key", "Abstract text", "First Author"]) == {"doi": "DOI link", "title": "Name", "year": "Pub Year", "source": "Venue", "dblp_source": "dblp key", "authors": "First Author", "abstract": "Abstract text"}
    rows = readers.mapped(spark.createDataFrame([(" x ", None)], "`My Title` string, doi string"), {"title": "My Title", "doi": "doi"})
    assert rows.first().asDict() == {"doi": "", "title": "x", "year": "", "source": "", "dblp_source": "", "authors": "", "abstract": ""}


def test_header_with_a_line_break(spark, tmp_path):
    (tmp_path / "h.csv").write_text('"A\nb",c\n1,2\n')
    assert [tuple(r) for r in readers.free_csv(spark, str(tmp_path / "h.csv")).collect()] == [("1", "2")]


def test_file_names_are_cut_and_told_apart(spark):
    typed = ["a/b", "A?b", " a/b ", "x" * 200, "...", None]
    got = {r.v: r.file_name for r in writers.file_names(spark.createDataFrame([(t,) for t in typed], "v string"), "v").collect()}
    assert got["a/b"] == got[" a/b "] != got["A?b"] and {got["a/b"], got["A?b"]} >= {"A_b.json"} and got["x" * 200] == "x" * 160 + ".json"
    assert {got["..."], got[None]} >= {"__unknown_source__.json"} and len({n.lower() for n in got.values()}) == 5


def test_first_or_last_venue_of_a_record():
    xml = '<article key="k"><journal>A</journal><journal>B</journal><title>t</title>'
    assert readers.record(xml)[4] == "A" and readers.record(xml, True)[4] == "B"
