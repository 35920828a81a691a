"""Explicit schemas of the tables that are read from files."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {"string": T.StringType(), "bigint": T.LongType(), "boolean": T.BooleanType(), "double": T.DoubleType(), "float": T.FloatType(), "int": T.IntegerType()}


def schema(text: str) -> T.StructType:
    """A schema of 'name kind, ...' with plain kinds and array<kind>, built without a session."""
    fields = []
    for part in text.split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, T.ArrayType(_KINDS[kind[6:-1]]) if kind.startswith("array<") else _KINDS[kind]))
    return T.StructType(fields)


PAPER = schema("paper_uid string, dblp_key string, title string, authors array<string>, source string, dblp_source string, year string, doi string, abstract string, keywords array<string>, citation_count bigint, full_paper boolean")
RECORD = schema("kind string, dblp_key string, title string, authors array<string>, dblp_source string, year string, links array<string>")
EXCLUDED = schema("key string, dblp_key string, doi string, title string")
CACHE = schema("cache_schema_version int, doi string, status string, abstract string, keywords array<string>, citation_count bigint")
PRODUCTION = schema("paper_uid string, dblp_key string, doi string, embedding array<float>, embedding_model string, has_embedding boolean, title string, abstract string, authors array<string>, keywords array<string>, source string, dblp_source string, year bigint, citation_count bigint, full_paper boolean")
STATS = schema("stat_key string, stat_type string, source_collection string, source string, dblp_source string, year bigint, paper_count bigint, missing_doi_count bigint, missing_abstract_count bigint, complete_count bigint, generated_at bigint")
LEGACY = schema("id string, title string, abstract string, authors array<string>, keywords array<string>, source string, year bigint, citation_count double, lang string, doi string")
