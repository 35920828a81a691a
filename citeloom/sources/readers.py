"""Readers: JSON arrays and lines, value lists, dimension CSV, free CSV with any header, pipe tables, and XML record dumps."""

from __future__ import annotations

import re
import uuid
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import text as X
from ..operators import filters
from ..schemas import PAPER, RECORD



def json_arrays(spark: SparkSession, path: str, schema: T.StructType = PAPER) -> DataFrame:
    """Rows of JSON array files with their file name; files whose name begins with '_' are left out."""
    rows = spark.read.schema(schema).option("multiLine", True).json(path)
    return rows.withColumn("file_name", F.col("_metadata.file_name")).where(~F.col("file_name").startswith("_"))


def _plain_copy(spark: SparkSession, path: str) -> str | None:
    """A copy of a file under a name that Spark does not hide (it hides what begins with '_'), beside ``spark.checkpoint.dir`` or, where
    that is unset, beside the file's directory; None if there is no such file."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(conf)
    if not fs.exists(at):
        return None
    to = jvm.org.apache.hadoop.fs.Path(f"{spark.conf.get('spark.checkpoint.dir', None) or at.getParent().getParent().toString()}/{uuid.uuid4().hex}/{at.getName().lstrip('_')}")
    jvm.org.apache.hadoop.fs.FileUtil.copy(fs, at, to.getFileSystem(conf), to, False, conf)
    return to.toString()


def batch_states(spark: SparkSession, path: str, schema: T.StructType = PAPER, missing_doi: bool = True) -> DataFrame:
    """A directory with enriched/ and missing/ arrays as one table with its state, file name and an order of states; with
    ``missing_doi`` also the records of missing/_missing_doi.json, if there is one."""
    read = lambda p: spark.read.schema(schema).option("multiLine", True).json(p)
    named = lambda df, s, o, n: df.withColumn("state", F.lit(s)).withColumn("state_rank", F.lit(o)).withColumn("file_name", n)
    name = F.col("_metadata.file_name")
    out = named(read(f"{path}/enriched"), "enriched", 0, name).unionByName(named(read(f"{path}/missing"), "missing_abstract", 1, name))
    copy = _plain_copy(spark, f"{path}/missing/_missing_doi.json") if missing_doi else None
    return out.unionByName(named(read(copy), "missing_doi", 1, F.lit("_missing_doi.json"))) if copy else out


def json_lines(spark: SparkSession, path: str, schema: T.StructType, strict: bool = True) -> DataFrame:
    return spark.read.schema(schema).json(path, mode="FAILFAST" if strict else "DROPMALFORMED")


def value_list(spark: SparkSession, path: str, field: str = "dblp_key", ordered: bool = False) -> DataFrame:
    """The different values of a file: a .json file is an array of texts or objects; any other has one value a line, plain or as JSON
    (a text, or an object's field), '#' beginning a comment line. A line that looks like JSON and is none ends the query.

    ``ordered`` adds ``position``, the place of a value's first line (the lines of a file read whole are numbered)."""
    if path.lower().endswith(".json"):
        items = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", "array<string>", {"mode": "FAILFAST"})).alias("position", "line"))
    elif ordered:
        items = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("position", "line"))
    else:
        items = spark.read.text(path).select(F.lit(0).alias("position"), F.col("value").alias("line"))
    line = X.trim_all(X.as_text(F.col("line")))
    broken = lambda c: F.coalesce(c, F.raise_error(F.concat(F.lit("invalid JSON line: "), line)).cast("string"))
    text = F.get(F.from_json(F.concat(F.lit("["), line, F.lit("]")), "array<string>"), F.lit(0))
    entry = F.get(F.from_json(F.concat(F.lit("["), line, F.lit("]")), "array<map<string,string>>"), F.lit(0))
    whole = F.size(F.from_json(F.concat(F.lit("["), line, F.lit("]")), "array<string>")) == 1
    value = F.when(line.startswith("{"), F.when(entry.isNotNull(), F.coalesce(entry[field], F.lit(""))).otherwise(broken(F.lit(None).cast("string"))))
    if not path.lower().endswith(".json"):
        value = value.when(line.startswith('"'), F.when(whole & line.endswith('"'), text).otherwise(broken(F.lit(None).cast("string"))))
    out = items.where(~line.startswith("#") & (line != "")).select("position", X.collapse(value.otherwise(line)).alias(field)).where(f"{field} <> ''")
    return out.groupBy(field).agg(F.min("position").alias("position")) if ordered else out.select(field).distinct()


def dimension(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """A CSV with a header; missing columns end the read."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    lacking = [c for c in required if c not in rows.columns]
    if lacking:
        raise ValueError(f"{path}: no column {', '.join(lacking)}")
    return rows


def venue_map(spark: SparkSession, path: str) -> DataFrame:
    """The list of venues (source, dblp_source, full_paper): a lacking column, a flag that is neither yes nor no, and a venue with two
    sources end the query."""
    rows = dimension(spark, path, ["source", "dblp_source", "Full paper"])
    return filters.check_venues(rows.select(X.collapse(F.col("source")).alias("source"), X.collapse(F.col("dblp_source")).alias("dblp_source"), X.to_flag_strict(F.col("`Full paper`")).alias("full_paper")))


def free_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with any header: empty headers get names, repeated ones a number; rows without any value are left out."""
    raw = spark.read.option("header", False).option("multiLine", True).option("escape", '"').csv(path)
    head = raw.first()
    if head is None:
        return raw
    seen: Counter = Counter()
    names = []
    for n, name in enumerate(raw.columns):
        label = (head[n] or "").strip() if n < len(head) else ""
        label = label or f"column_{n + 1}"
        seen[label] += 1
        names.append(label if seen[label] == 1 else f"{label}_{seen[label]}")
    rows = spark.read.option("header", True).option("enforceSchema", True).option("multiLine", True).option("escape", '"').schema(T.StructType([T.StructField(f"c{n}", T.StringType()) for n in range(len(names))])).csv(path)
    some = F.lit(False)
    for c in rows.columns:
        some |= X.has_value(F.col(c))
    return rows.where(some).toDF(*names)


# For each field, headers that are it as a whole, and words that a header of it contains.
HEADERS = {
    "doi": ((), ("doi",)), "title": (("name",), ("title",)), "year": ((), ("year",)), "source": (("source", "venue"), ("conference", "journal")),
    "dblp_source": ((), ("dblp",)), "authors": ((), ("author",)), "abstract": ((), ("abstract",)),
}


def guess_columns(columns: list[str]) -> dict[str, str]:
    """Field -> the first column of a free CSV whose header is taken for it."""
    out: dict[str, str] = {}
    for field, (whole, words) in HEADERS.items():
        hit = next((c for c in columns if c.lower().strip() in whole or any(w in c.lower() for w in words)), None)
        if hit:
            out[field] = hit
    return out


def mapped(rows: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """The fields of a look-up list, trimmed; '' for a field without a column or value."""
    return rows.select(*(X.trim_all(X.as_text(F.col(f"`{mapping[f]}`"))).alias(f) if f in mapping else F.lit("").alias(f) for f in HEADERS))


def pipe_table(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """A Markdown table: trimmed cells, without header and rule."""
    cells = F.split(F.regexp_replace(X.trim_all(F.col("value")), r"^\||\|$", ""), r"\|")
    rows = spark.read.text(path).where("value like '%|%'").where(~F.col("value").rlike(r"^[\s|:-]+$"))
    out = rows.select(*(X.trim_all(F.coalesce(F.get(cells, F.lit(n)), F.lit(""))).alias(c) for n, c in enumerate(names)))
    return out.where(F.lower(F.col(names[0])) != names[0].lower())




class _Part(InputPartition):
    def __init__(self, path: str, start: int, end: int):
        self.path, self.start, self.end = path, start, end


class DumpSource(DataSource):
    """Records of a large XML dump (``spark.read.format("record_dump").load(path)``).

    A plain file is read in byte ranges: a range yields the records that begin in it. A gzip file is one range. Inline markup
    inside a title is kept as running text, and named entities are resolved. Options: path, range_bytes, venue (first or last)."""

    @classmethod
    def name(cls) -> str:
        return "record_dump"

    def schema(self) -> T.StructType:
        return RECORD

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _DumpReader(self.options)


class _DumpReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.step = int(options.get("range_bytes", 32 << 20))
        self.last = options.get("venue", "first") == "last"

    def _open(self):
        """(size, file) by any file system that pyarrow knows; a plain path is a local one."""
        from pyarrow import fs

        at, path = fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)
        return at.get_file_info(path).size, at.open_input_file(path)

    def partitions(self):
        size = self._open()[0]
        if self.path.endswith(".gz"):
            return [_Part(self.path, 0, -1)]
        return [_Part(self.path, s, min(size, s + self.step)) for s in range(0, max(1, size), self.step)]

    def read(self, part: _Part):
        import gzip

        begin = re.compile(rb"<(article|inproceedings)\s[^>]*>")
        with self._open()[1] as raw, gzip.open(raw) if part.path.endswith(".gz") else raw as file:
            file.seek(part.start)
            buffer, base, done = b"", part.start, False
            while True:
                hit = begin.search(buffer)
                if hit and (part.end < 0 or base + hit.start() < part.end):
                    close = b"</" + hit.group(1) + b">"
                    end = buffer.find(close, hit.end())
                    if end >= 0:
                        yield record(buffer[hit.start() : end].decode("utf-8", "replace"), self.last)
                        buffer, base = buffer[end + len(close) :], base + end + len(close)
                        continue
                elif hit or done:
                    return
                elif part.end >= 0 and base + max(0, len(buffer) - 4096) >= part.end:
                    return
                if done:
                    return
                if not hit and len(buffer) > 8192:
                    base, buffer = base + len(buffer) - 4096, buffer[-4096:]
                more = file.read(1 << 20)
                done = not more
                buffer += more


def record(xml: str, last_venue: bool = False) -> tuple:
    """One element's text as a row of ``RECORD``; of several venues the first counts, or the last."""
    import html

    def texts(tag: str) -> list[str]:
        found = re.findall(rf"<{tag}(?:\s[^>]*)?>(.*?)</{tag}>", xml, re.S)
        return [t for t in (" ".join(html.unescape(re.sub(r"<[^>]+>", "", f)).split()) for f in found) if t]

    kind = re.match(r"<(\w+)", xml)
    key = re.search(r'\bkey="([^"]*)"', xml)
    venue = texts("journal") or texts("booktitle")
    first = lambda xs: xs[0] if xs else None
    return (kind.group(1) if kind else None, html.unescape(key.group(1)) if key else None, first(texts("title")), texts("author"), first(venue[::-1] if last_venue else venue), first(texts("year")), texts("ee"))


def paper_records(dump: DataFrame, venues: DataFrame) -> DataFrame:
    """Papers of a record dump whose venue is listed, as rows of ``PAPER``. ``venues`` is a reference list of bounded size."""
    listed = venues.select(X.collapse(F.col("dblp_source")).alias("dblp_source"), "source", X.to_flag(F.col("full_paper")).alias("full_paper"))
    rows = dump.withColumn("dblp_source", X.collapse(F.col("dblp_source"))).join(listed, "dblp_source").withColumn("doi", X.first_doi(F.col("links")))
    uid = X.paper_uid(F.col("doi"), F.col("dblp_key"), F.col("title"), F.col("authors"), F.col("year"), F.col("dblp_source"))
    return rows.select(uid.alias("paper_uid"), "dblp_key", "title", "authors", "source", "dblp_source", "year", "doi", F.lit("").alias("abstract"), F.array().cast("array<string>").alias("keywords"), F.lit(None).cast("bigint").alias("citation_count"), "full_paper")


def saved_results(spark: SparkSession, path: str) -> DataFrame:
    """Saved look-up results with typed columns; a similarity above 1 is a percentage."""
    rows = dimension(spark, path, ["status", "similarity", "paper_uid"])
    out = rows.withColumn("similarity", X.percentage(F.col("similarity")))
    return out.withColumn("source_mismatch", X.to_flag(F.col("source_mismatch"))) if "source_mismatch" in rows.columns else out
