"""Registered queries of the core, each beside the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import changes, enrich, filters, merge, retrieval, stats
from ..session import ship, stage
from ..sinks import writers
from ..streaming import incremental

MODEL = "embed-small-3"
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of a table reader under its name, with its SQL."""

    def wrap(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        _QUERIES[f.__name__] = run
        if sql:
            _SQL[f.__name__] = sql
        return f

    return wrap


# SQL of the text functions
def _t(c: str) -> str:
    return rf"regexp_replace(coalesce({c}, ''), '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def _c(c: str) -> str:
    return rf"trim(regexp_replace(coalesce({c}, ''), '[\s\p{{Z}}]+', ' ', 'g'))"


def _label(c: str) -> str:
    return f"coalesce(nullif({_t(c)}, ''), 'Unknown')"


def _fold(c: str) -> str:
    return f"replace(lower({c}), 'ß', 'ss')"


_PREFIX = r"(?i)^(?:https?://(?:dx\.)?doi\.org/|doi:)"


def _doi(c: str) -> str:
    return f"trim(regexp_replace({_c(c)}, '{_PREFIX}', ''))"


def _dkey(c: str) -> str:
    return f"lower({_doi(c)})"


def _find_doi(c: str) -> str:
    inside = rf"regexp_replace(regexp_extract({_c(c)}, '(10\.[0-9]{{4,9}}/[^\s\"<>'']+)', 1), '[.,;)\]}}]+$', '')"
    return f"case when regexp_matches({_c(c)}, '{_PREFIX}') or starts_with({_c(c)}, '10.') then {_doi(c)} else {inside} end"


def _plain(c: str) -> str:
    return f"trim(regexp_replace(lower(strip_accents(lower(coalesce({c}, '')))), '[^a-z0-9]+', ' ', 'g'))"


def _words(c: str) -> str:
    return f"list_filter(string_split({_plain(c)}, ' '), lambda t: t <> '')"


def _typed_doi(c: str) -> str:
    return rf"lower(regexp_replace(regexp_replace({_t(c)}, '(?i)^https?://(dx\.)?doi\.org/', ''), '(?i)^doi:\s*', ''))"


def _title(c: str) -> str:
    return f"trim(regexp_replace(regexp_replace(regexp_replace({_fold(f'coalesce({c}, chr(0))')}, '&[a-z0-9#]+;', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'), ' +', ' ', 'g'))"


def _tokens(c: str) -> str:
    return f"list_filter(regexp_split_to_array(lower(coalesce({c}, '')), '[^a-z0-9]+'), lambda t: t <> '')"


def _name(c: str) -> str:
    return rf"substring(regexp_replace({_fold(_c(c))}, '\s+[0-9]{{4}}$', ''), 1, 512)"


def _jaccard(a: str, b: str) -> str:
    union = f"len(list_distinct(list_concat({a}, {b})))"
    return f"case when {union} = 0 then 1.0 else len(list_intersect(list_distinct({a}), list_distinct({b}))) / {union} end"


_FLAGS = f"f as (select {_label('source')} as source, {_label('dblp_source')} as dblp_source, year, {_t('doi')} <> '' as has_doi, {_t('abstract')} <> '' as has_abstract from paper_new)"
_COUNTS = "count(*) as paper_count, count(*) filter (not has_doi) as missing_doi_count, count(*) filter (not has_abstract) as missing_abstract_count, count(*) filter (has_doi and has_abstract) as complete_count"
_LATEST = "(select * exclude (rn) from (select *, row_number() over (partition by paper_uid order by row_id desc) as rn from paper_new) where rn = 1)"


def _latest(read) -> DataFrame:
    return merge.last_by_key(read("paper_new"), "paper_uid", "row_id")


# -- counts and profiles


_STATS = f"""{_FLAGS}, g as (select source, dblp_source, year, grouping(dblp_source) * 2 + grouping(year) as g, {_COUNTS} from f group by grouping sets ((source, year), (source, dblp_source), (source))),
k as (select *, case g when 2 then 'source_year' when 1 then 'source_dblp_completeness' else 'source_summary' end as stat_type, case g when 2 then '::' || coalesce(cast(year as varchar), 'None') when 1 then '::' || dblp_source else '' end as more from g),
s as (select stat_type || '::paper_new::' || sha1(stat_type || '::paper_new::' || source || more) as stat_key, stat_type, 'paper_new' as source_collection, source, dblp_source, year, paper_count, missing_doi_count, missing_abstract_count, complete_count, cast(1700000000000 as bigint) as generated_at from k)"""


@query(f"with {_STATS} select * from s")
def stats_grouping_sets(read):
    return stats.grouping_sets(read("paper_new"), "paper_new", 1700000000000)


@query(f"with {_STATS} select stat_key, stat_type, source, row_number() over (partition by stat_type order by {_fold('source')}, source, year nulls last, {_fold('dblp_source')} nulls first, dblp_source) as position from s")
def stats_in_order(read):
    """The place of each row of the counts in its table."""
    return stats.in_order(stats.grouping_sets(read("paper_new"), "paper_new")).select("stat_key", "stat_type", "source", "position")


@query(f"with {_FLAGS} select source, year, {_COUNTS} from f group by 1, 2")
def stats_source_year(read):
    return stats.one_kind(read("paper_new"), "source", "year")


@query(f"with {_FLAGS} select source, dblp_source, {_COUNTS} from f group by 1, 2")
def stats_source_venue(read):
    return stats.one_kind(read("paper_new"), "source", "dblp_source")


@query(f"with {_FLAGS} select source, {_COUNTS} from f group by 1")
def stats_source(read):
    return stats.one_kind(read("paper_new"), "source")


@query(f"""with {_FLAGS}, v as (select source, dblp_source, {_COUNTS}, min(year) as a, max(year) as b from f group by 1, 2)
select source, cast(sum(paper_count) as bigint) as paper_count, cast(sum(missing_doi_count) as bigint) as missing_doi_count, cast(sum(missing_abstract_count) as bigint) as missing_abstract_count, cast(sum(complete_count) as bigint) as complete_count,
min(a) as first_year, max(b) as last_year, count(*) as venues, string_agg(dblp_source || ':' || paper_count, '; ' order by paper_count desc, {_fold('dblp_source')}, dblp_source) as venue_counts,
round((sum(paper_count) - sum(missing_doi_count)) / sum(paper_count), 6) as doi_share, round((sum(paper_count) - sum(missing_abstract_count)) / sum(paper_count), 6) as abstract_share, round(sum(complete_count) / sum(paper_count), 6) as complete_share
from v group by source""")
def report_by_source(read):
    return stats.source_report(read("paper_new"))


@query(f"with {_FLAGS} select {_COUNTS}, count(distinct source) as sources, min(year) as first_year, max(year) as last_year from f")
def report_totals(read):
    return stats.totals(read("paper_new"))


@query(f"""with {_FLAGS}, c as (select source, year, {_COUNTS} from f where year is not null group by 1, 2), g as (select * from (select distinct source from c), (select distinct year from c))
select source, year, coalesce(paper_count, 0) as paper_count, round(coalesce((paper_count - complete_count) / paper_count, 0.0), 6) as incomplete_ratio from g left join c using (source, year)""")
def source_year_matrix(read):
    return stats.year_matrix(read("paper_new"))


@query(f"with {_FLAGS}, y as (select source, year from f where year is not null) pivot y on year using count(*) group by source")
def source_year_pivot(read):
    """Counts of each source with a column for each year that occurs."""
    papers = read("paper_new")
    return stats.year_pivot(papers.where("year is not null"))


@query(f"""with {_FLAGS}, s as (select source, {_COUNTS} from f group by 1) select source, paper_count, paper_count - complete_count as missing_any,
greatest(0, missing_doi_count + missing_abstract_count - (paper_count - complete_count)) as missing_both, round((paper_count - complete_count) / paper_count, 6) as missing_ratio from s""")
def gaps_by_source(read):
    return stats.quality(read("paper_new"))


@query(f"""with {_FLAGS}, p as (select source, dblp_source, count(*) as paper_count from f group by 1, 2)
select *, cast(coalesce(sum(paper_count) over (partition by source order by paper_count desc, dblp_source rows between unbounded preceding and 1 preceding), 0) as bigint) as "offset" from p""")
def composition_offsets(read):
    return stats.composition(read("paper_new"))


@query(f"""with s as (select {_label('source')} as source, {_doi('doi')} as doi, row_id from paper_new), c as (select source, count(*) as papers, count(*) filter (doi <> '') as with_doi from s group by 1),
d as (select source, doi, min(row_id) as pos from s where doi <> '' group by 1, 2), r as (select *, row_number() over (partition by source order by pos) as n from d)
select c.source, papers, with_doi, coalesce((select string_agg(doi, ' ' order by n) from r where r.source = c.source and n <= 3), '') as examples from c""")
def raw_source_profile(read):
    return stats.source_examples(read("paper_new"), "row_id")


@query(f"select {_label('lang')} as value, count(*) as n, round(count(*) / sum(count(*)) over (), 6) as share from load_to_zilliz group by 1")
def language_shares(read):
    return stats.frequency(read("load_to_zilliz"), "lang")


@query(f"""with l as (select source, count(*) as venues, count(*) filter (lower(trim(full_paper)) in ('1', 'true', 'yes', 'y')) as full_venues from source_mapping group by 1),
o as (select {_label('source')} as source, count(*) as n from load_to_zilliz group by 1), p as (select {_label('source')} as source, count(*) as n from paper_new group by 1)
select l.source, venues, full_venues, coalesce(o.n, 0) as old_papers, coalesce(p.n, 0) as new_papers from l left join o using (source) left join p using (source)""")
def venue_growth(read):
    return stats.venue_growth(read("load_to_zilliz"), read("paper_new"), read("source_mapping"))


# -- joins with reference lists, new records, exclusion, deduplication

@query(f"""select m.source as mapped_source, lower(trim(m.full_paper)) in ('1', 'true', 'yes', 'y') as mapped_full_paper, count(*) as papers from paper_new p join source_mapping m on {_c('p.dblp_source')} = {_c('m.dblp_source')} group by 1, 2""")
def venue_map_join(read):
    return filters.map_venues(read("paper_new"), read("source_mapping")).groupBy("mapped_source", "mapped_full_paper").agg(F.count("*").alias("papers"))


_REASONS = f"""e as (select * from paper_new where batch_id < 5), x as (select distinct {_c('dblp_key')} as k from paper_new where not full_paper and batch_id = 1 and {_c('dblp_key')} <> ''),
t as (select distinct {_fold(_c('title'))} as t from load_to_zilliz where {_t('source')} = '' and {_fold(_c('title'))} <> ''),
k as (select distinct {_c('dblp_key')} as k from e where {_c('dblp_key')} <> ''), d as (select distinct {_dkey('doi')} as d from e where {_dkey('doi')} <> ''),
r as (select row_id, source, case when {_fold(_c('title'))} in (select t from t) then 'excluded_title' when {_c('dblp_key')} in (select k from x) then 'excluded' when {_c('dblp_key')} in (select k from k) then 'existing_key'
when {_dkey('doi')} in (select d from d) then 'existing_doi' when {_c('dblp_key')} = '' then 'missing_key' else 'new' end as reason from paper_new where batch_id >= 5)"""


def _classified(read) -> DataFrame:
    papers = read("paper_new")
    excluded = papers.where(~F.col("full_paper") & (F.col("batch_id") == 1))
    titles = read("load_to_zilliz").where(~X.has_value(F.col("source")))
    return filters.classify_new(papers.where("batch_id >= 5"), papers.where("batch_id < 5"), excluded, titles)


@query(f"with {_REASONS} select row_id, reason from r")
def new_record_filter(read):
    return _classified(read).select("row_id", "reason")


@query(f"with {_REASONS} select {_label('source')} as source, reason, count(*) as papers from r group by 1, 2")
def new_record_counts(read):
    return filters.reason_counts(_classified(read))


@query(f"""with b as (select 'dblp_key' as kind, {_c('dblp_key')} as value from paper_new union all select 'doi', {_dkey('doi')} from paper_new) select kind, value, count(*) as n from b where value <> '' group by 1, 2""")
def existing_keys(read):
    return filters.keys_and_dois(read("paper_new"))


@query(f"""with b as (select 'dblp_key' as kind, {_c('dblp_key')} as value from paper_new union all select 'doi', {_dkey('doi')} from paper_new), v as (select kind, value, count(*) as n from b where value <> '' group by 1, 2)
select kind, count(*) as distinct_values, cast(sum(n) - count(*) as bigint) as duplicates from v group by 1""")
def existing_key_counts(read):
    return filters.key_counts(read("paper_new"))


@query(f"""select paper_uid, dblp_key, doi, year, '' as abstract, 'Unknown' as source, 'Unknown' as dblp_source from paper_new where {_t('doi')} <> '' and {_t('abstract')} = '' and year = 2021""")
def backfill_candidates(read):
    return filters.backfill_candidates(read("paper_new"), 2021)


@query(f"select row_id from (select row_id, {_dkey('doi')} as d, row_number() over (partition by {_dkey('doi')} order by batch_id, row_id) as n from paper_new) where n = 1 or d = ''")
def dedupe_first_wins(read):
    return filters.first_by_key(read("paper_new").select("row_id", "batch_id", "doi"), X.doi_key(F.col("doi")), F.col("batch_id"), F.col("row_id")).select("row_id")


@query("select distinct paper_uid from paper_new where paper_uid not in (select paper_uid from paper_prod)")
def resume_export(read):
    return filters.remaining(read("paper_new").select("paper_uid"), read("paper_prod"), "paper_uid")


@query(f"""with k as (select distinct dblp_key from paper_prod where {_t('dblp_key')} <> '') select dblp_key, dblp_key in (select dblp_key from paper_new where batch_id > 1 and dblp_key is not null) as found from k""")
def requested_keys(read):
    return filters.requested(read("paper_prod"), read("paper_new").where("batch_id > 1"), "dblp_key")


# -- changes and merges


@query(f"select paper_uid, row_id, title, year from {_LATEST}")
def latest_by_uid(read):
    return _latest(read).select("paper_uid", "row_id", "title", "year")


_CHANGE = f"""c as (select n.paper_uid, case when o.paper_uid is null then 'new'
when lower({_t('n.title')}) <> lower({_t('o.title')}) or lower({_t('n.abstract')}) <> lower({_t('o.abstract')}) or lower({_t('o.embedding_model')}) <> '{MODEL}' or o.has_embedding is distinct from true then 'embed_input_change'
when n.dblp_key is not distinct from o.dblp_key and n.doi is not distinct from o.doi and n.title is not distinct from o.title and n.abstract is not distinct from o.abstract and coalesce(n.authors, []) = coalesce(o.authors, [])
and coalesce(n.keywords, []) = coalesce(o.keywords, []) and n.source is not distinct from o.source and n.dblp_source is not distinct from o.dblp_source and n.year is not distinct from o.year
and n.citation_count is not distinct from o.citation_count and n.full_paper is not distinct from o.full_paper then 'unchanged' else 'metadata_only_change' end as change
from {_LATEST} n left join paper_prod o using (paper_uid) where {_t('n.paper_uid')} <> '')"""


@query(f"with {_CHANGE} select paper_uid, change from c")
def change_classes(read):
    return changes.classify(_latest(read), read("paper_prod"), MODEL)


@query(f"with {_CHANGE} select change, count(*) as papers from c group by 1")
def change_counts(read):
    return changes.counts(changes.classify(_latest(read), read("paper_prod"), MODEL))


_COLUMNS = ["paper_uid", "doi", "title", "year", "citation_count"]
_LATE = f"(select paper_uid, doi, title, year, citation_count from {_LATEST} where batch_id >= 6)"


def _late(read) -> DataFrame:
    return _latest(read).where("batch_id >= 6").select(*_COLUMNS)


@query(f"select paper_uid, doi, title, year, citation_count from paper_prod where paper_uid not in (select paper_uid from {_LATE}) union all select * from {_LATE}")
def merge_full(read):
    return merge.upsert(read("paper_prod").select(*_COLUMNS), _late(read), "paper_uid")


@query(f"""select coalesce(t.paper_uid, s.paper_uid) as paper_uid, t.doi, t.title, coalesce(s.year, t.year) as year, coalesce(s.citation_count, t.citation_count) as citation_count from paper_prod t full join {_LATE} s on t.paper_uid = s.paper_uid""")
def merge_partial(read):
    return merge.upsert_columns(read("paper_prod").select(*_COLUMNS), _late(read), "paper_uid", ["year", "citation_count"])


@query(f"select paper_uid, doi, title, year, citation_count from paper_prod where paper_uid not in (select paper_uid from {_LATE})")
def delete_by_key(read):
    return merge.delete(read("paper_prod").select(*_COLUMNS), _late(read), "paper_uid")


@query("""select source, paper_uid from paper_prod where source is distinct from 'VIXAR' union all select 'VIXAR' as source, paper_uid from paper_new where source = 'VIXAR' and batch_id = 1""")
def versioned_replace(read):
    fresh = read("paper_new").where("source = 'VIXAR' and batch_id = 1").select(F.lit("VIXAR").alias("source"), "paper_uid")
    return merge.replace_version(read("paper_prod").select("source", "paper_uid"), fresh, "source", "VIXAR")


@query("""with o as (select paper_uid, max(row_id) as row_id, arg_max(title, row_id) as title from paper_new where batch_id = 1 group by 1), n as (select paper_uid, max(row_id) as row_id, arg_max(title, row_id) as title from paper_new where batch_id > 1 group by 1)
select paper_uid, row_id, title from o where paper_uid not in (select paper_uid from n) union all select n.paper_uid, coalesce(o.row_id, (select max(row_id) from o) + n.row_id), n.title from n left join o using (paper_uid)""")
def keyed_merge_replace(read):
    papers = read("paper_new").select("paper_uid", "row_id", "title", "batch_id")
    old = merge.last_by_key(papers.where("batch_id = 1").drop("batch_id"), "paper_uid", "row_id")
    return merge.replace_in_place(old, papers.where("batch_id > 1").drop("batch_id"), "paper_uid", "row_id")


_EXCLUDE = f"""w as (select distinct {_c('dblp_key')} as key from paper_prod where not full_paper and {_c('dblp_key')} <> ''), x as (select dblp_key as key, dblp_key, min(doi) as doi, min(title) as title from paper_prod where year < 2005 and {_c('dblp_key')} = dblp_key and dblp_key <> '' group by 1, 2),
r as (select {_c('dblp_key')} as key, 0 as rank, row_id as place, {_c('doi')} as doi, {_c('title')} as title from paper_new where batch_id > 1 union all select {_c('dblp_key')}, 1, 0, {_c('doi')}, {_c('title')} from paper_prod where year >= 2010 union all select key, 2, 0, {_c('doi')}, {_c('title')} from x),
b as (select key, doi, title from (select *, row_number() over (partition by key order by rank, place, doi, title) as n from r where key in (select key from w)) where n = 1)"""


def _excluded(read):
    keys = read("paper_prod").where("not full_paper").select("dblp_key")
    old = read("paper_prod").where((F.col("year") < 2005) & (X.collapse(F.col("dblp_key")) == F.col("dblp_key")) & (F.col("dblp_key") != ""))
    known = old.groupBy(F.col("dblp_key").alias("key"), "dblp_key").agg(F.min("doi").alias("doi"), F.min("title").alias("title"))
    return merge.move_to_excluded([read("paper_new").where("batch_id > 1"), read("paper_prod").where("year >= 2010")], known, keys, ["row_id", None])


@query(f"""with {_EXCLUDE} select w.key, w.key as dblp_key, coalesce(doi, '') as doi, coalesce(title, '') as title from w left join b using (key) union all select key, dblp_key, doi, title from x where key not in (select key from w)""")
def move_to_excluded(read):
    return _excluded(read)[1]


@query(f"""with {_EXCLUDE} select row_id, paper_uid from paper_new where batch_id > 1 and {_c('dblp_key')} not in (select key from w)""")
def kept_after_exclusion(read):
    return _excluded(read)[0][0].select("row_id", "paper_uid")


@query(f"""with a as (select row_id, i, {_name('authors[i]')} as n from (select row_id, authors, unnest(range(1, len(authors) + 1)) as i from paper_new where len(authors) > 0)),
d as (select row_id, n, min(i) as i from a where n <> '' group by 1, 2) select p.row_id, coalesce((select string_agg(n, '|' order by i) from d where d.row_id = p.row_id), '') as names from paper_new p where len(authors) > 0""")
def column_backfill(read):
    papers = read("paper_new").where("size(authors) > 0").select("row_id", "authors", F.lit(None).cast("array<string>").alias("names"))
    filled = merge.fill_column(papers, "names", X.author_names(F.col("authors")))
    return filled.select("row_id", F.array_join(F.coalesce("names", F.array().cast("array<string>")), "|").alias("names"))


@query(f"""with k as (select distinct dblp_key from paper_new where dblp_key is not null), p as (select dblp_key, min(title) as t from paper_prod group by 1), n as (select dblp_key, min(title) as t from paper_new group by 1)
select k.dblp_key, case when p.dblp_key is not null then p.t else n.t end as title from k left join p using (dblp_key) left join n using (dblp_key)""")
def first_found_title(read):
    """The title of each key in production, or else in the staging collection."""
    return merge.first_found(read("paper_new").where("dblp_key is not null").select("dblp_key"), [read("paper_prod"), read("paper_new")], "dblp_key", ["title"])


@query(f"""select paper_uid, concat_ws(chr(10), nullif({_t('title')}, ''), nullif({_t('abstract')}, '')) as text from paper_prod where {_t('title')} <> '' and {_t('abstract')} <> '' and has_embedding is distinct from true""")
def texts_to_embed(read):
    return changes.to_embed(read("paper_prod"))


@query("""select embedding_model, case when embedding is null then 'missing' when len(embedding) = 0 then 'empty' when len(embedding) <> 128 then 'wrong_size' when len(list_filter(embedding, lambda x: x is null or isnan(x))) > 0 then 'not_finite'
when len(list_filter(embedding, lambda x: x <> 0)) = 0 then 'zero' else 'sound' end as state, has_embedding, count(*) as papers from paper_prod group by all""")
def vector_report(read):
    return changes.vector_report(read("paper_prod"), 128)


# -- enrichment


def _cache(read) -> DataFrame:
    """The collection in production as a cache by DOI: of several papers with one DOI, that with the smallest uid."""
    prod = read("paper_prod").select("paper_uid", X.doi_key(F.col("doi")).alias("doi"), "abstract", "keywords", "citation_count").where("doi <> ''")
    return prod.groupBy("doi").agg(F.min_by(F.struct("abstract", "keywords", "citation_count"), "paper_uid").alias("e")).select("doi", "e.*")


_ENRICHED = f"""with h as (select doi, e.abstract as abstract, e.keywords as keywords, e.citation_count as citation_count from (select {_dkey('doi')} as doi, arg_min({{'abstract': abstract, 'keywords': keywords, 'citation_count': citation_count}}, paper_uid) as e from paper_prod where {_dkey('doi')} <> '' group by 1)),
r as (select p.row_id, h.doi is not null as there, p.abstract as a, h.abstract as b, p.keywords as k, h.keywords as l, p.citation_count as c, h.citation_count as d from paper_new p left join h on {_dkey('p.doi')} = h.doi)"""


_NEW = _c("b")


@query(_ENRICHED + f""" select row_id, 'overwrite' as rule, length(case when there then {_NEW} else a end) as abstract_length, len(case when len(l) > 0 then l else k end) as keyword_number, coalesce(d, c) as citation_count from r
union all select row_id, 'prefer', length(case when {_NEW} <> '' then {_NEW} else a end), len(case when len(k) > 0 then k else l end), coalesce(c, d) from r
union all select row_id, 'fill', length(case when {_NEW} <> '' and {_t("a")} = '' then {_NEW} else a end), len(case when len(k) > 0 then k else l end), coalesce(c, d) from r""")
def enrich_precedence(read):
    cache, papers = _cache(read), read("paper_new").select("row_id", "doi", "abstract", "keywords", "citation_count")
    one = lambda rule: enrich.by_doi(papers, cache, rule).select("row_id", F.lit(rule).alias("rule"), F.length("abstract").alias("abstract_length"), F.when(F.col("keywords").isNotNull(), F.size("keywords")).alias("keyword_number"), "citation_count")
    return one("overwrite").unionAll(one("prefer")).unionAll(one("fill"))


@query(f"""select {_label('source')} as source, case when {_t('doi')} = '' then 'missing_doi' when {_t('abstract')} <> '' then 'enriched' else 'missing_abstract' end as state, count(*) as papers from paper_new group by 1, 2""")
def state_routing(read):
    return enrich.state(read("paper_new")).groupBy(X.label(F.col("source")).alias("source"), "state").agg(F.count("*").alias("papers"))


@query()
def title_match_fuzzy(read):
    """Best old record of each new one by matching blocks of titles, years and shared names."""
    old = read("load_to_zilliz").groupBy("id").agg(F.min_by(F.struct("title", "authors", "year"), F.struct("title", "year")).alias("e")).select("id", "e.*")
    return enrich.best_matches(_latest(read).select("paper_uid", "title", "authors", "year"), old)


@query(f"""with a as (select row_id, list_distinct({_tokens('title')}) as t, year from paper_new where year is not null), b as (select distinct id, list_distinct({_tokens('title')}) as t, year from load_to_zilliz where year is not null),
c as (select row_id, len(t) as n, unnest(t) as w, year from a), d as (select id, t as key, len(t) as n, unnest(t) as w, year from b), j as (select row_id, id, key, c.n as m, d.n as n, count(*) as s from c join d using (year, w) group by all)
select distinct row_id, id, round(s / (m + n - s), 4) as similarity from j where s >= 0.7 * (m + n - s) - 1e-9""")
def title_match_jaccard(read):
    """All pairs of one year whose titles share 0.7 of their words."""
    old = read("load_to_zilliz").where("year is not null").select("id", "title", "year").distinct()
    return enrich.similar_titles(read("paper_new").where("year is not null"), old, "row_id", "id", 0.7)


# -- look-up and retrieval

def _bm25(inputs: str) -> str:
    """Common tables that end in ``best`` (input_id, uid, score): the first title by BM25, scored against all papers."""
    return f"""bd as (select paper_uid, {_tokens('title')} as w from paper_prod), bn as (select count(*) as n, avg(len(w)) as average from bd), bp as (select paper_uid, term, count(*) as tf from (select paper_uid, unnest(w) as term from bd) group by 1, 2), bf as (select term, count(*) as df from bp group by 1),
bq as (select distinct input_id, term from (select input_id, unnest({_tokens('title')}) as term from {inputs})), bw as (select input_id, term, ln(1 + (n - df + 0.5) / (df + 0.5)) as idf from bq join bf using (term), bn),
bs as (select input_id, bp.paper_uid, round(sum(idf * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * len(bd.w) / average))), 6) as score from bw join bp using (term) join bd on bd.paper_uid = bp.paper_uid, bn group by 1, 2),
best as (select input_id, paper_uid as uid, score from (select *, row_number() over (partition by input_id order by score desc, paper_uid) as rn from bs) where rn = 1)"""


_LOOKUP = f"""i as (select input_id, {_t('doi')} as raw, {_typed_doi('doi')} as norm, {_t('title')} as title from coverage_input), d as (select doi as v, min(paper_uid) as u from paper_prod where doi <> '' group by 1), t as (select title as v, min(paper_uid) as u from paper_prod where title <> '' group by 1),
e as (select i.*, coalesce(d1.u, d2.u, d3.u) as by_doi, t.u as by_title from i left join d d1 on raw = d1.v left join d d2 on norm = d2.v left join d d3 on norm <> '' and 'https://doi.org/' || norm = d3.v left join t on i.title = t.v),
rest as (select input_id, title from e where by_doi is null and by_title is null and title <> ''), {_bm25('rest')}, bt as (select paper_uid as uid, min(title) as their from paper_prod group by 1),
l as (select e.input_id, coalesce(by_doi, by_title, best.uid) as paper_uid, case when by_doi is not null then 'matched_doi' when by_title is not null then 'matched_title' when best.uid is null then 'missing' when {_plain('e.title')} = {_plain('their')} then 'matched_title' else 'candidate' end as status
from e left join best using (input_id) left join bt on bt.uid = best.uid)"""


def _found(read) -> DataFrame:
    return stage(retrieval.lookup(read("coverage_input"), read("paper_prod")), "found")


@query(f"with {_LOOKUP} select * from l")
def coverage_lookup(read):
    return _found(read)


def _known(a: str, b: str, score: str) -> str:
    return f"case when coalesce({a}, '') <> '' and coalesce({b}, '') <> '' then {score} end"


def _place(c: str) -> str:
    return f"lower({_t(c)})"


_SIMILAR = f"""{_LOOKUP}, m as (select l.input_id, l.paper_uid, l.status, {_t('i.title')} as it, {_t('i.doi')} as id, {_t('i.year')} as iy, {_t('i.source')} as isrc, {_t('i.authors')} as ia, p.title as pt, p.doi as pd, cast(p.year as varchar) as py, p.source as ps, array_to_string(list_filter(p.authors, lambda x: x <> ''), ', ') as pa
from l join coverage_input i using (input_id) join paper_prod p on l.paper_uid = p.paper_uid),
s as (select input_id, paper_uid, status, list_filter([{_known('it', 'pt', _jaccard(_words('it'), _words('pt')))}, {_known('id', 'pd', f"case when {_typed_doi('id')} = {_typed_doi('pd')} then 1.0 else 0.0 end")}, {_known('iy', 'py', "case when iy = py then 1.0 else 0.0 end")},
{_known('isrc', 'ps', f"case when {_place('isrc')} = {_place('ps')} then 1.0 else 0.0 end")}, {_known('ia', 'pa', _jaccard(_words('ia'), _words('pa')))}], lambda x: x is not null) as k, isrc <> '' and coalesce(ps, '') <> '' and {_place('isrc')} <> {_place('ps')} as source_mismatch from m),
c as (select input_id, paper_uid, status, round(coalesce(list_avg(k), 0.0), 4) as similarity, source_mismatch from s)"""


def _scored(read, found: DataFrame | None = None) -> DataFrame:
    return retrieval.similarity(read("coverage_input"), read("paper_prod"), _found(read) if found is None else found)


@query(f"with {_SIMILAR} select * from c")
def coverage_similarity(read):
    return _scored(read)


@query(f"with {_SIMILAR} select count(*) as inputs, count(*) filter (status like 'matched%') as matched, count(*) filter (status = 'candidate') as candidate, count(*) filter (status = 'missing') as missing, (select count(*) filter (source_mismatch) from c) as source_mismatch from l")
def coverage_counts(read):
    found = _found(read)
    return retrieval.lookup_counts(found, _scored(read, found))


@query(f"with {_SIMILAR} select * from c order by source_mismatch desc, case status when 'matched_doi' then 0 when 'matched_title' then 1 when 'candidate' then 2 else 3 end, similarity desc, input_id limit 100")
def coverage_doubtful(read):
    """The hundred results to look at first: other sources, then by status, then by similarity."""
    return retrieval.results_in_order(_scored(read)).limit(100)


@query(f"""with {_SIMILAR} select input_id, l.status, coalesce(c.source_mismatch, false) as source_mismatch, coalesce(c.similarity, 0.0) as similarity, {_t('i.title')} as csv_title, {_t('i.doi')} as csv_doi, {_t('i.source')} as csv_source, {_t('i.year')} as csv_year, {_t('i.authors')} as csv_authors,
coalesce(p.title, '') as match_title, coalesce(p.doi, '') as match_doi, coalesce(p.source, '') as match_source, coalesce(cast(p.year as varchar), '') as match_year, coalesce(array_to_string(list_filter(p.authors, lambda x: x <> ''), ', '), '') as match_authors, coalesce(l.paper_uid, '') as paper_uid
from l join coverage_input i using (input_id) left join c using (input_id) left join paper_prod p on p.paper_uid = l.paper_uid""")
def coverage_export(read):
    found = _found(read)
    return retrieval.export(read("coverage_input"), read("paper_prod"), found, _scored(read, found))


@query(f"with q as (select input_id, title from coverage_input where input_id % 20 = 0), {_bm25('q')} select input_id, uid as paper_uid, round(score, 4) as score from best")
def bm25_top(read):
    """The best title for every twentieth input, against all papers."""
    return retrieval.bm25_top(read("coverage_input").where("input_id % 20 = 0"), read("paper_prod"), "input_id", "title", "paper_uid", "title")


@query("""with d as (select vec_id, cast(embedding as double[]) as v from embeddings), s as (select q.vec_id as query, d.vec_id as key, round(list_cosine_similarity(q.v, d.v), 6) as c from d q, d where q.vec_id % 20 = 0 and q.vec_id <> d.vec_id)
select query, key, round(c, 4) as cosine from (select *, row_number() over (partition by query order by c desc, key) as rn from s) where rn <= 5""")
def cosine_top(read):
    vectors = read("embeddings")
    return retrieval.cosine_top(vectors.where("vec_id % 20 = 0"), vectors, "vec_id", "embedding")


@query()
def vector_projection(read):
    """Two principal components of every sound vector."""
    rows = read("paper_prod").where(F.size("embedding") == 128).where(~F.exists("embedding", lambda x: x.isNull() | F.isnan(x)))
    return retrieval.project(rows, "paper_uid", "embedding")


# -- scalar functions over whole tables


@query(f"""select doc_id, sha1(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g'))) as digest from documents where len({_tokens('text')}) > 0""")
def rebuild_from_positions(read):
    words = read("documents").select("doc_id", F.posexplode(X.tokens(F.col("text"))).alias("p", "w"))
    index = words.groupBy("doc_id", "w").agg(F.collect_list("p").alias("ps")).groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("w", "ps"))).alias("index"))
    return index.select("doc_id", F.sha1(X.text_of_positions(F.col("index"))).alias("digest"))


@query()
def clean_markup(read):
    """Texts without markup and with entities resolved, which SQL cannot; tested against a plain version."""
    return read("documents").select("doc_id", F.sha1(X.without_markup(F.col("text"))).alias("digest"))


@query(f"select input_id, {_find_doi('doi')} as found, {_dkey('doi')} as key from coverage_input")
def extract_doi(read):
    return read("coverage_input").select("input_id", X.find_doi(F.col("doi")).alias("found"), X.doi_key(F.col("doi")).alias("key"))


@query(f"""select input_id, case when regexp_matches({_t('year')}, '^[+-]?[0-9]+$') then try_cast({_t('year')} as bigint) end as year_number, case when regexp_matches({_t('year')}, '^[0-9]+$') then {_t('year')} else 'Unknown' end as year_label from coverage_input""")
def year_forms(read):
    return read("coverage_input").select("input_id", X.year_or_null(F.col("year")).alias("year_number"), X.year_label(F.col("year")).alias("year_label"))


_AUTHORS_JSON = f"coalesce((select string_agg(to_json({_fold(_c('authors[n]'))}), ',' order by n) from unnest(range(1, len(authors) + 1)) as u(n)), '')"
_FALLBACK = f"""'fallback:' || sha1('{{"authors":[' || {_AUTHORS_JSON} || '],"dblp_source":' || to_json({_fold(_c('dblp_source'))}) || ',"title":' || to_json({_fold(_c('title'))}) || ',"year":' || to_json(coalesce(cast(year as varchar), '')) || '}}')"""


@query(f"""select row_id, case when {_dkey('doi')} <> '' then 'doi:' || {_dkey('doi')} when {_t('dblp_key')} <> '' then 'dblp:' || {_c('dblp_key')} else {_FALLBACK} end as uid, {_FALLBACK} as digest from paper_new""")
def paper_uids(read):
    """Each record's uid, and the one it would have without DOI and key."""
    uid = lambda doi, key: X.paper_uid(doi, key, F.col("title"), F.col("authors"), F.col("year").cast("string"), F.col("dblp_source"))
    return read("paper_new").select("row_id", uid(F.col("doi"), F.col("dblp_key")).alias("uid"), uid(F.lit(""), F.lit("")).alias("digest"))


_WHOLE = "nullif(array_to_string(list_filter(list_transform(coalesce({0}, []), lambda x: " + _t("x") + "), lambda x: x <> ''), ' '), '')"
_SEARCH = f"nullif(substring(lower(concat_ws(' ', nullif({_t('title')}, ''), nullif({_t('abstract')}, ''), {_WHOLE.replace('{0}', 'keywords')}, {_WHOLE.replace('{0}', 'authors')})), 1, 65535), '')"


@query(f"select row_id, sha1({_SEARCH}) as digest from paper_new")
def search_texts(read):
    return read("paper_new").select("row_id", F.sha1(X.search_text(F.col("title"), F.col("abstract"), F.col("keywords"), F.col("authors"))).alias("digest"))


_MATCH_NAMES = "list_distinct(list_filter(list_transform(coalesce({0}, []), lambda a: trim(regexp_replace(" + _name("a") + ", '[^a-z0-9]+', ' ', 'g'))), lambda x: x <> ''))"


@query(f"""with b as (select n.row_id, {_MATCH_NAMES.replace('{0}', 'n.authors')} as x, {_MATCH_NAMES.replace('{0}', 'p.authors')} as y from paper_new n join paper_prod p using (paper_uid))
select row_id, round(case when len(x) = 0 or len(y) = 0 then 0.0 else len(list_intersect(x, y)) / greatest(len(x), len(y)) end, 4) as overlap from b""")
def author_overlaps(read):
    both = read("paper_new").select("row_id", "paper_uid", "authors").join(read("paper_prod").select("paper_uid", F.col("authors").alias("others")), "paper_uid")
    return both.select("row_id", F.round(X.author_overlap(F.col("authors"), F.col("others")), 4).alias("overlap"))


_SAFE = f"coalesce(nullif(substring(regexp_replace(regexp_replace(regexp_replace(x, '[^A-Za-z0-9._ -]+', '_', 'g'), '\\s+', ' ', 'g'), '^[ ._]+|[ ._]+$', '', 'g'), 1, 160), ''), '__unknown_source__')"


@query(f"""with n as (select distinct dblp_source as typed, {_c('dblp_source')} as x from coverage_input), s as (select *, row_number() over (partition by lower(f) order by x) as k from (select distinct x, {_SAFE} as f from n))
select typed, case when k = 1 then f else substring(f, 1, 149) || '_' || substring(sha1(x), 1, 10) end || '.json' as file_name from n join s using (x)""")
def venue_file_names(read):
    return writers.file_names(read("coverage_input").select(F.col("dblp_source").alias("typed")), "typed")


# -- events


@query("select user_id, event_id, ts, event_type from (select *, row_number() over (partition by user_id order by ts, event_id) as n from events) where n = 1")
def first_seen_events(read):
    return incremental.first_seen(read("events").select("user_id", "event_id", "ts", "event_type"), "user_id", "ts", "event_id")


@query("select date_trunc('hour', ts) as window_start, event_type, count(*) as n, round(sum(value), 4) as total from events group by 1, 2")
def event_windows(read):
    return incremental.windows(read("events"), "ts", "event_type", "value")


from . import more  # noqa: E402,F401  registers its queries


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
