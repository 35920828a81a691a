"""Registered queries of the core, continued: loading, reports, titles and keys, extraction from provider records, saved coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.udfs import plain_ascii, resolve_entities, sequence_ratio
from ..operators import changes, enrich, filters, load, merge, stats
from .queries import MODEL, _CHANGE, _COUNTS, _FLAGS, _SEARCH, _c, _dkey, _doi, _fold, _label, _latest, _name, _plain, _t, _title, query

# -- loading


def _cut(c: str, most: int) -> str:
    return f"substring({_t(c)}, 1, {most})"


_LIST = "list_filter(list_transform(coalesce({0}, [])[1:256], lambda x: " + _cut("x", 512) + "), lambda x: x <> '')"
_JOINED = "coalesce(array_to_string({0}, '|'), '')"


def _flat(df: DataFrame, *lists: str) -> DataFrame:
    """List columns as one text, so that rows can be compared."""
    none = F.array().cast("array<string>")
    return df.select(*(F.array_join(F.coalesce(c, none), "|").alias(c) if c in lists else F.col(c) for c in df.columns))


@query(f"""select row_id, substring({_c('paper_uid')}, 1, 1024) as paper_uid, nullif({_cut('dblp_key', 1024)}, '') as dblp_key, nullif({_cut('doi', 512)}, '') as doi, sha1({_SEARCH}) as search_text, {_cut('title', 4096)} as title, sha1(nullif({_cut('abstract', 65535)}, '')) as abstract,
{_JOINED.replace('{0}', _LIST.replace('{0}', 'authors'))} as authors, {_JOINED.replace('{0}', _LIST.replace('{0}', 'keywords'))} as keywords, {_cut('source', 1024)} as source, {_cut('dblp_source', 1024)} as dblp_source, coalesce(year, 0) as year, citation_count, coalesce(full_paper, false) as full_paper,
{_t('doi')} <> '' as has_doi, {_t('abstract')} <> '' as has_abstract from paper_new where {_c('paper_uid')} <> ''""")
def load_entities(read):
    """Every column of the staging collection of each delivered record, coerced for loading."""
    papers = read("paper_new").where(X.has_value(F.col("paper_uid")))
    ready = load.to_entity(papers.withColumn("paper_uid", F.concat_ws("\x01", F.col("row_id").cast("string"), "paper_uid")))
    own = ready.withColumn("row_id", F.substring_index("paper_uid", "\x01", 1).cast("bigint")).withColumn("paper_uid", F.substring_index("paper_uid", "\x01", -1))
    out = own.withColumn("search_text", F.sha1("search_text")).withColumn("abstract", F.sha1("abstract")).drop("embedding", "umap", "authors_normalised")
    return _flat(out, "authors", "keywords")


@query(f"""select row_id, {_c('paper_uid')} as paper_uid, nullif({_doi('doi')}, '') as doi, length({_c('abstract')}) as abstract_length, case when len(keywords) > 0 then len(keywords) end as keyword_number, citation_count from paper_new where {_c('abstract')} <> ''""")
def partial_updates(read):
    """What a partial update takes over from records with an abstract."""
    rows = read("paper_new").withColumn("paper_uid", F.concat_ws("\x01", F.col("row_id").cast("string"), X.collapse(F.col("paper_uid"))))
    out = load.to_update(rows)
    number = F.when(F.col("keywords").isNotNull(), F.size("keywords"))
    return out.select(F.substring_index("paper_uid", "\x01", 1).cast("bigint").alias("row_id"), F.substring_index("paper_uid", "\x01", -1).alias("paper_uid"), "doi", F.length("abstract").alias("abstract_length"), F.coalesce(number, F.lit(None)).alias("keyword_number"), "citation_count")


@query(f"""with u as (select paper_uid, row_id, doi from (select *, row_number() over (partition by paper_uid order by row_id desc) as n from paper_new) where n = 1), s as (select * from u order by row_id offset 100)
select {_c('paper_uid')} as paper_uid from s where {_t('doi')} <> '' and {_c('paper_uid')} not in (select paper_uid from paper_prod)""")
def upload_rest(read):
    """The records that an upload adds which skips the first hundred, those without a DOI and known uids."""
    return load.to_load(_latest(read), ("row_id",), read("paper_prod"), 100, True, allow_non_empty=True).select("paper_uid")


@query(f"""select paper_uid, year, {_t('doi')} <> '' as has_doi, false as has_abstract from paper_prod""")
def exported_flags(read):
    """Flags of rows of a table that has none: a DOI that is there counts, an abstract does not."""
    return load.clean_flags(read("paper_prod")).select("paper_uid", "year", "has_doi", "has_abstract")


@query(f"select count(*) as total, count(*) filter ({_dkey('doi')} <> '') as with_doi, count(*) filter ({_t('abstract')} <> '') as with_abstract, count(*) filter ({_t('abstract')} = '') as missing_abstract, count(*) filter ({_dkey('doi')} <> '' and {_t('abstract')} = '') as doi_missing_abstract from paper_new where batch_id > 1")
def batch_readiness(read):
    return stats.readiness(read("paper_new").where("batch_id > 1"))


@query(f"select row_id from paper_new where batch_id > 1 and ({_dkey('doi')} = '' or {_dkey('doi')} not in (select {_dkey('doi')} from paper_prod))")
def recovered_dois_new(read):
    return filters.without_known_dois(read("paper_new").where("batch_id > 1"), read("paper_prod")).select("row_id")


@query("select paper_uid, title from paper_prod where source = 'VIXAR' order by paper_uid limit 5")
def rest_query(read):
    """The first five rows with a value."""
    return filters.equal_to(read("paper_prod"), "source", "VIXAR", 5, "paper_uid").select("paper_uid", "title")


@query("select row_id, paper_uid from paper_new where lower(source) = 'vixar' order by row_id limit 50")
def source_limited(read):
    return filters.of_source(read("paper_new"), "vixar", 50, "row_id").select("row_id", "paper_uid")


@query("select id, length(abstract) as n from (select distinct id, abstract from load_to_zilliz) where length(abstract) > 50 order by id, abstract limit 1000")
def long_abstracts(read):
    return load.long_abstracts(read("load_to_zilliz").select("id", "abstract").distinct(), order=("id", "abstract")).select("id", F.length("abstract").alias("n"))


@query("select paper_uid, dblp_key, doi, title, source, year from paper_prod")
def metadata_export(read):
    """All columns but the heavy ones (some of what is left)."""
    return load.metadata(read("paper_prod")).select("paper_uid", "dblp_key", "doi", "title", "source", "year")


@query(f"""select distinct id, {_cut('title', 4096)} as title, {_JOINED.replace('{0}', _LIST.replace('{0}', 'authors'))} as authors, coalesce(year, 0) as year, {_cut('source', 1024)} as source from load_to_zilliz""")
def older_records(read):
    """Records of older files: the first column that has a value, cut and typed."""
    rows = read("load_to_zilliz").withColumnsRenamed({"id": "ID", "title": "Title", "authors": "Authors", "year": "Year"})
    return _flat(load.from_older(rows).select("id", "title", "authors", "year", "source"), "authors").distinct()


@query("select paper_uid from paper_prod where umap is null or umap.x is null")
def without_coordinates(read):
    return load.without_coordinates(read("paper_prod")).select("paper_uid")


@query("""with s as (select row_number() over (order by paper_uid) - 1 as ordinal, paper_uid, umap.x as x, umap.y as y from paper_prod where umap.x is not null) select ordinal, s.paper_uid, x, y, title from s join paper_prod using (paper_uid) where ordinal >= 50 and ordinal < 450""")
def saved_coordinates(read):
    """A slice of saved coordinates joined to the rows that are there."""
    from pyspark.sql import Window

    papers = read("paper_prod")
    saved = papers.where("umap.x is not null").select((F.row_number().over(Window.orderBy("paper_uid")) - 1).alias("ordinal"), "paper_uid", F.col("umap.x").alias("x"), F.col("umap.y").alias("y"))
    return load.saved_coordinates(saved, papers.select("paper_uid", "title"), 50, 450)


@query("""select paper_uid, '{"x":' || cast(round(umap.x) as bigint) || '.0,"y":' || cast(round(umap.y) as bigint) || '.0,"algorithm":"umap-learn"' || coalesce(',"mode":' || to_json(umap.mode), '') || coalesce(',"generated_at":' || to_json(umap.generated_at), '') || case when umap.model_version <> '' then ',"model_version":' || to_json(umap.model_version) else '' end
|| case when umap.embedding_model <> '' then ',"embedding_model":' || to_json(umap.embedding_model) else '' end || '}' as payload from paper_prod where umap.x is not null and abs(umap.x) < 1000000 and abs(umap.y) < 1000000""")
def coordinates_json(read):
    u = lambda c: F.col(f"umap.{c}")
    whole = lambda c: F.floor(F.abs(u(c)) + 0.5) * F.signum(u(c)) + F.lit(0.0)
    rows = read("paper_prod").where("umap.x is not null and abs(umap.x) < 1000000 and abs(umap.y) < 1000000")
    return rows.select("paper_uid", X.coordinates_json(whole("x"), whole("y"), u("mode"), u("generated_at"), u("model_version"), u("embedding_model")).alias("payload"))


@query("""with a as (select dblp_key as key, 0 as list, min(row_id) as position from paper_new where batch_id > 1 and trim(dblp_key) <> '' group by 1), b as (select dblp_key, 1, min(row_id) from paper_new where batch_id = 1 and trim(dblp_key) <> '' group by 1)
select * from a union all select * from b where dblp_key not in (select key from a)""")
def asked_keys(read):
    """Keys of one list and then of another, each once where it comes first."""
    papers = read("paper_new").select(F.col("dblp_key").alias("key"), F.col("row_id").alias("position"), "batch_id")
    return filters.asked_keys(papers.where("batch_id > 1"), papers.where("batch_id = 1"), "key", "position")


@query(f"with {_CHANGE} select paper_uid from c where change <> 'unchanged' and paper_uid in (select paper_uid from paper_new where batch_id >= 6)")
def changed_uids(read):
    """The uids that later stages have to look at: changed against production and touched by the last batches."""
    changed = changes.classify(_latest(read), read("paper_prod"), MODEL).where("change <> 'unchanged'")
    return changed.join(read("paper_new").where("batch_id >= 6").select("paper_uid"), "paper_uid", "left_semi").select("paper_uid")


# -- titles and keys


@query(f"select row_id, {_title('title')} as title, len(string_split({_title('title')}, ' ')) <= 2 or {_title('title')} in ('editorial', 'preface', 'introduction', 'foreword', 'contents', 'back matter', 'front matter', 'panel session', 'panel sessions') as generic from paper_new where title is not null")
def match_titles(read):
    return read("paper_new").where("title is not null").select("row_id", X.match_title(F.col("title")).alias("title"), X.is_generic_title(F.col("title")).alias("generic"))


@query(f"select row_id, {_plain('title')} as title from paper_new where title is not null")
def plain_titles(read):
    return read("paper_new").where("title is not null").select("row_id", plain_ascii("title").alias("title"))


@query()
def resolved_entities(read):
    """Texts with their entities resolved, which SQL cannot; tested against the plain function."""
    return read("documents").where("text like '%&%'").select("doc_id", F.sha1(resolve_entities("text")).alias("digest"))


@query(f"""select row_id, '{{"source":' || to_json({_fold(_c('source'))}) || ',"title":' || to_json({_title('title')}) || ',"year":' || to_json(coalesce(cast(year as varchar), '')) || '}}' as key from paper_new where title is not null""")
def search_keys(read):
    return read("paper_new").where("title is not null").select("row_id", X.search_key(F.col("title"), F.col("year").cast("string"), F.col("source")).alias("key"))


@query(f"select row_id, case when {_c('dblp_key')} <> '' then 'dblp_key:' || {_c('dblp_key')} when {_c('paper_uid')} <> '' then 'paper_uid:' || {_c('paper_uid')} when {_dkey('doi')} <> '' then 'doi:' || {_dkey('doi')} else '' end as key from paper_new")
def merge_keys(read):
    return read("paper_new").select("row_id", X.merge_key(F.col("dblp_key"), F.col("paper_uid"), F.col("doi")).alias("key"))


@query("select row_id, abs(n.year - p.year) as apart from paper_new n join paper_prod p using (paper_uid)")
def year_distances(read):
    return read("paper_new").select("row_id", "paper_uid", "year").join(read("paper_prod").select("paper_uid", F.col("year").alias("other")), "paper_uid").select("row_id", X.year_distance(F.col("year"), F.col("other")).alias("apart"))


@query()
def title_ratios(read):
    """Similarity of each record's title to that in production by matching blocks; tested against the plain function."""
    both = read("paper_new").select("row_id", "paper_uid", X.match_title(F.col("title")).alias("t")).join(read("paper_prod").select("paper_uid", X.match_title(F.col("title")).alias("u")), "paper_uid")
    return both.select("row_id", F.round(sequence_ratio("t", "u"), 4).alias("similarity"))


_CACHE = f"h as (select key, e.doi as doi, e.abstract as abstract, e.keywords as keywords, e.citation_count as citation_count from (select {_title('title')} || '|' || coalesce(cast(year as varchar), '') || '|' || {_fold(_c('source'))} as key, arg_min({{'doi': doi, 'abstract': abstract, 'keywords': keywords, 'citation_count': citation_count}}, paper_uid) as e from paper_prod where title is not null group by 1))"


@query(f"""with {_CACHE}, r as (select row_id, p.paper_uid, p.doi, p.abstract, p.keywords, p.citation_count, {_doi('h.doi')} as hd, {_c('h.abstract')} as ha, h.keywords as hk, h.citation_count as hc from paper_new p left join h on {_title('p.title')} || '|' || coalesce(cast(p.year as varchar), '') || '|' || {_fold(_c('p.source'))} = h.key where p.title is not null)
select row_id, case when hd <> '' and {_doi('doi')} = '' then 'doi:' || {_fold('hd')} else paper_uid end as paper_uid, case when hd <> '' and {_doi('doi')} = '' then hd else doi end as doi, length(case when ha <> '' and {_c('abstract')} = '' then ha else abstract end) as abstract_length,
len(case when len(hk) > 0 and coalesce(len(keywords), 0) = 0 then hk else keywords end) as keyword_number, coalesce(citation_count, hc) as citation_count from r""")
def title_search_fill(read):
    """Gaps filled from a cache of searches by title, year and source; a DOI that was found renames its record."""
    prod = read("paper_prod").where("title is not null").select("paper_uid", X.search_key(F.col("title"), F.col("year").cast("string"), F.col("source")).alias("key"), F.struct("doi", "abstract", "keywords", "citation_count").alias("found"))
    cache = prod.groupBy("key").agg(F.min_by("found", "paper_uid").alias("found"))
    papers = read("paper_new").where("title is not null").select("row_id", "paper_uid", "doi", "title", F.col("year").cast("string").alias("year"), "source", "abstract", "keywords", "citation_count")
    out = enrich.by_title(papers, cache)
    return out.select("row_id", "paper_uid", "doi", F.length("abstract").alias("abstract_length"), F.when(F.col("keywords").isNotNull(), F.size("keywords")).alias("keyword_number"), "citation_count")


@query("""select doi, max(abstract) as abstract from (select doi, abstract, row_number() over (partition by doi order by updated_at desc nulls last, row_id desc) as n from paper_new where doi is not null and batch_id > 4 and abstract is not null) where n = 1 group by 1""")
def valid_cache(read):
    """Of look-up results those of the current version with a final status, for each DOI the last one."""
    version, status = F.when(F.col("batch_id") > 4, 2).otherwise(1), F.when(F.col("abstract").isNull(), "error").otherwise("found")
    order = F.struct(F.coalesce(F.col("updated_at"), F.lit("0001-01-01").cast("timestamp_ntz")), "row_id")
    cache = read("paper_new").where("doi is not null").withColumn("updated_at", F.col("updated_at").cast("timestamp_ntz")).select("doi", "abstract", version.alias("cache_schema_version"), status.alias("status"), order.alias("at"))
    return enrich.valid_cache(cache, 2, order="at").select("doi", "abstract")


# -- what providers say


@query(f"""select row_id, (select string_agg(x, '|' order by i) from (select x, min(n) as i from (select {_c('keywords[n]')} as x, n from unnest(range(1, len(keywords) + 1)) as u(n)) where x <> '' group by 1)) as names, array_to_string(list_filter(list_transform(authors, lambda a: {_c('a')}), lambda x: x <> ''), '|') as authors,
case when len(keywords) > 0 then 'keywords' when len(authors) > 0 then 'authors' else '' end as source from paper_new where keywords is not null and authors is not null""")
def provider_names(read):
    """Names out of lists of structs as providers give them: distinct ones, all authors, and the first list that has any."""
    rows = read("paper_new").where("keywords is not null and authors is not null")
    named = rows.withColumn("topics", F.transform("keywords", lambda k: F.struct(k.alias("display_name")))).withColumn("ships", F.transform("authors", lambda a: F.struct(a.alias("display_name"))))
    names = F.array_join(X.display_names(F.col("topics")), "|")
    first = X.first_list(F.when(F.size("keywords") > 0, F.array(F.lit("keywords"))), F.when(F.size("authors") > 0, F.array(F.lit("authors"))))
    return named.select("row_id", F.nullif(names, F.lit("")).alias("names"), F.array_join(X.display_names(F.col("ships"), distinct=False), "|").alias("authors"), F.array_join(first, "|").alias("source"))


@query(f"""with a as (select row_id, {_c('x')} as x, n from (select row_id, unnest(list_concat(coalesce(keywords, []), coalesce(authors, []))) as x, unnest(range(1, 1 + coalesce(len(keywords), 0) + coalesce(len(authors), 0))) as n from paper_new)), b as (select row_id, x, min(n) as i from a where x <> '' group by 1, 2)
select row_id, string_agg(x, '|' order by i) as joined from b group by 1""")
def provider_fields(read):
    """The different elements of two lists, in their order."""
    out = read("paper_new").select("row_id", F.array_join(X.joined_lists(F.col("keywords"), F.col("authors")), "|").alias("joined"))
    return out.where("joined <> ''")


# -- reports

_SHARES = f"""{_FLAGS}, c as (select source, {_COUNTS} from f group by 1)"""


def _share(c: str) -> str:
    return f"round((paper_count - {c}) / paper_count, 6)"


@query(f"""with {_SHARES}, s as (select *, {_share('missing_doi_count')} as d, round(complete_count / paper_count, 6) as k from c), o as (select source, row_number() over (order by d desc, paper_count desc, {_fold('source')}, source) as by_doi, row_number() over (order by k desc, paper_count desc, {_fold('source')}, source) as by_complete,
row_number() over (order by paper_count desc, {_fold('source')}, source) as by_papers, row_number() over (order by {_fold('source')}, source) as by_name from s) select * from o""")
def report_orders(read):
    """The place of each source in the four orders of the report."""
    from pyspark.sql import Window

    report = stats.source_report(read("paper_new"))
    place = lambda o: F.row_number().over(Window.orderBy(*(F.desc(c) for c in stats.REPORT_ORDERS[o]), X.casefold(F.col("source")), "source"))
    return report.select("source", *(place(o).alias(f"by_{o}") for o in stats.REPORT_ORDERS))


def _pct(a: str) -> str:
    return f"round(({a}) / paper_count * 100, 2)"


_D, _A = "(paper_count - missing_doi_count)", "(paper_count - missing_abstract_count)"


@query(f"""with {_FLAGS}, v as (select source, dblp_source, count(*) as n from f group by 1, 2), t as (select source, string_agg(dblp_source || ':' || n, '; ' order by n desc, {_fold('dblp_source')}, dblp_source) as dblp_sources from v group by 1), c as (select source, {_COUNTS}, min(year) as year_min, max(year) as year_max from f group by 1)
select source, paper_count as total, {_D} as with_doi, missing_doi_count as without_doi, {_pct(_D)} as doi_percent, {_A} as with_abstract, missing_abstract_count as without_abstract, {_pct(_A)} as abstract_percent, complete_count as complete, {_pct('complete_count')} as complete_percent,
{_D} - complete_count as with_doi_without_abstract, {_pct(_D + ' - complete_count')} as with_doi_without_abstract_percent, dblp_sources, year_min, year_max from c join t using (source)""")
def report_summary(read):
    return stats.summary(read("paper_new"))


@query(f"""with y as (select {_label('source')} as source, coalesce(case when year >= 0 then cast(year as varchar) end, 'Unknown') as year, count(*) as n from paper_new group by 1, 2) select source, string_agg(year || ':' || n, '; ' order by year) as year_counts from y group by 1""")
def report_years(read):
    return stats.year_profile(read("paper_new"))


@query(f"""with {_FLAGS}, c as (select source, year, count(*) as n from f where year is not null group by 1, 2), g as (select * from (select distinct source from c), (select distinct year from c)), m as (select max(n) as most from c)
select source, year, case when n > 0 then round(greatest(0.08, least(1.0, ln(1 + n) / ln(1 + most))), 6) else 0.0 end as intensity from g left join c using (source, year), m""")
def heat_map(read):
    return stats.heat_map(read("paper_new")).select("source", "year", "intensity")


@query("select source, dblp_source, lower(trim(full_paper)) in ('yes', 'true', '1', 'y') as full_paper from source_mapping")
def checked_venues(read):
    """The list of venues, read strictly: a bad flag, or a venue with two sources, would end the query."""
    rows = read("source_mapping")
    return filters.check_venues(rows.select("source", "dblp_source", X.to_flag_strict(F.col("full_paper")).alias("full_paper")))


@query(f"""with n as (select batch_id, {_name('a')} as name from (select batch_id, unnest(authors) as a from paper_new)) select name, min(batch_id) as first_batch, max(batch_id) as last_batch from n where name <> '' group by 1""")
def author_batches(read):
    """The first and the last batch of each normal author name."""
    names = read("paper_new").select("batch_id", F.explode(F.coalesce(X.author_names(F.col("authors")), F.array().cast("array<string>"))).alias("name"))
    return names.groupBy("name").agg(F.min("batch_id").alias("first_batch"), F.max("batch_id").alias("last_batch"))


@query("""with t as (select paper_uid, case when has_embedding is distinct from true and trim(title) <> '' and trim(abstract) <> '' then length(trim(title) || chr(10) || trim(abstract)) end as n from paper_prod) select paper_uid, n as backfilled from t where n is not null""")
def vector_backfill(read):
    """Vectors made for rows that lack one, written back in part (here by an embedder that measures the text)."""
    from ..operators import retrieval

    texts = changes.to_embed(read("paper_prod"))
    made = retrieval.embed(texts, _measure, 1).withColumn("has_embedding", F.lit(True))
    table = read("paper_prod").select("paper_uid", F.lit(None).cast("array<float>").alias("embedding"), F.lit(None).cast("boolean").alias("has_embedding"))
    return merge.upsert_columns(table, made, "paper_uid", ["embedding", "has_embedding"]).where("has_embedding").select("paper_uid", F.get("embedding", F.lit(0)).cast("bigint").alias("backfilled"))


def _measure(texts: list[str]) -> list[list[float]]:
    return [[float(len(t))] for t in texts]


@query("select source, row_number() over (order by lower(strip_accents(source)), source) as position from (select distinct source from paper_new where source is not null)")
def sources_in_order(read):
    return stats.names_in_order(read("paper_new"), "source")


@query("select paper_uid, len(embedding) as numbers from paper_prod where len(embedding) = 128 and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0")
def checked_vectors(read):
    """Vectors of the right size and without bad numbers; one that is not would end the query, so others are left out before."""
    sound = (F.size("embedding") == 128) & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return changes.checked_vectors(read("paper_prod").where(sound), 128).select("paper_uid", F.size("embedding").alias("numbers"))
