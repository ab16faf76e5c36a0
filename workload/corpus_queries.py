"""Scans, projections, filters and statistics over the archive of documents."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from folioforge.functions import dates as D
from folioforge.functions import text as X
from folioforge.operators import filters as FL
from folioforge.operators import ordered, records, stats
from folioforge.operators.windows import audit_windows
from folioforge.schema import (
    ACTIVE_TYPES,
    COMMISSION_SOURCE,
    KNOWN_TYPES,
    OTHER_INSTITUTION_TYPES,
    OTHER_SOURCE,
    TYPE_LABELS,
    SearchSpec,
    normalize_type_codes,
)
from folioforge.session import new_path
from folioforge.sources.corpus import scan_corpus, scan_summary, scan_type_counts
from workload.registry import query
from workload.views import (
    corpus,
    corpus_columns,
    dates_as_text,
    duck_views,
    keyed_corpus,
    legacy_corpus,
    table,
)

C = duck_views("corpus")


def sql_list(values) -> str:
    return ", ".join("'" + value.replace("'", "''") + "'" for value in values)


# --- Scans -------------------------------------------------------------------


@query("scan_corpus", C + f"select {corpus_columns()} from corpus")
def q_scan_corpus(spark, sf):
    path = new_path(spark, "scan-corpus")
    corpus(spark, sf).write.parquet(path)
    return scan_corpus(spark, path)


@query("scan_summary", C + "select count(*) as row_count, max(date) as cutoff from corpus")
def q_scan_summary(spark, sf):
    return scan_summary(legacy_corpus(spark, sf))


@query(
    "scan_type_counts",
    C + "select doc_type, count(*) as n from corpus where doc_type is not null group by doc_type",
)
def q_scan_type_counts(spark, sf):
    return scan_type_counts(legacy_corpus(spark, sf).drop("doc_type"))


# --- Projections -------------------------------------------------------------

BOOLEAN_WORDS = """case doc_id % 9 when 0 then 'TRUE' when 1 then ' yes ' when 2 then '1' when 3 then '0'
  when 4 then 'No' when 5 then 'false' when 6 then '1.0' when 7 then '' end"""
BOOLEAN_SQL = "case when doc_id % 9 in (0, 1, 2) then true when doc_id % 9 in (3, 4, 5) then false end"


@query(
    "normalize_schema",
    C + "select " + corpus_columns().replace("place", "cast(null as varchar) as place").replace(
        "detail_ok", f"{BOOLEAN_SQL} as detail_ok"
    ) + " from corpus",
)
def q_normalize_schema(spark, sf):
    loose = keyed_corpus(spark, sf).drop("place").withColumn("detail_ok", F.expr(BOOLEAN_WORDS))
    return records.normalize_schema(loose.withColumn("unused", F.lit(1)))


@query(
    "migrate_legacy",
    C + """select document_id, reference, case when doc_type = 'MEMO' then 'NOTE' else doc_type end as doc_type,
      doc_type_name, title, subtitle, summary, date, language, spokespersons, policy_areas, full_text, url,
      pdf_url, full_text <> '' as detail_ok, scraped_at from corpus""",
)
def q_migrate_legacy(spark, sf):
    return records.migrate_legacy(legacy_corpus(spark, sf))


@query(
    "typed_view",
    C + """select document_id, cast(try_cast(date as date) as varchar) as date,
      epoch(try_cast(replace(publish_datetime, 'Z', '') as timestamp)) as published,
      cast(len([x for x in string_split(coalesce(commissioners, ''), '; ') if x <> '']) as integer) as people,
      case when policy_areas is null then '' else policy_areas end as areas from corpus""",
)
def q_typed_view(spark, sf):
    typed = records.typed_view(corpus(spark, sf))
    return typed.select(
        "document_id",
        F.col("date").cast("string").alias("date"),
        F.unix_timestamp("publish_datetime").cast("double").alias("published"),
        F.size("commissioners").alias("people"),
        F.array_join("policy_areas", "; ").alias("areas"),
    )


@query("coerce_boolean", f"select doc_id, {BOOLEAN_SQL} as flag from documents")
def q_coerce_boolean(spark, sf):
    words = table(spark, sf, "documents").select("doc_id", F.expr(BOOLEAN_WORDS).alias("word"))
    return words.select("doc_id", X.coerce_boolean(F.col("word")).alias("flag"))


@query(
    "source_bucket",
    C + f"""select document_id, case when doc_type in ({sql_list(OTHER_INSTITUTION_TYPES)})
      then '{OTHER_SOURCE}' else '{COMMISSION_SOURCE}' end as source from corpus""",
)
def q_source_bucket(spark, sf):
    return corpus(spark, sf).select(
        "document_id", records.source_bucket(F.col("doc_type")).alias("source")
    )


@query("fallback_fields", C + """select document_id,
  coalesce(nullif(subtitle, ''), nullif(summary, ''), '') as first_text,
  coalesce(nullif(doc_type, ''), nullif(place, ''), '') as first_code from corpus""")
def q_fallback_fields(spark, sf):
    return corpus(spark, sf).select(
        "document_id",
        X.first_filled(F.col("subtitle"), F.col("summary")).alias("first_text"),
        X.first_filled(F.col("doc_type"), F.col("place")).alias("first_code"),
    )


# --- Filters -----------------------------------------------------------------


def ids(df):
    return df.select("document_id", "doc_type", "date")


def ids_where(condition: str) -> str:
    return C + f"select document_id, doc_type, date from corpus where {condition}"


@query("filter_types", ids_where("doc_type in ('SPEECH', 'MEMO')"))
def q_filter_types(spark, sf):
    return ids(FL.filter_types(corpus(spark, sf), ["SPEECH", "MEMO"]))


@query("filter_scope", ids_where(f"doc_type in ({sql_list(ACTIVE_TYPES)})"))
def q_filter_scope(spark, sf):
    return ids(FL.filter_scope(corpus(spark, sf), "active"))


@query("filter_window", ids_where("date >= '1990-01-15' and date <= '2005-06-30'"))
def q_filter_window(spark, sf):
    return ids(FL.filter_window(corpus(spark, sf), date(1990, 1, 15), date(2005, 6, 30)))


@query("filter_language", ids_where("language = 'fr'"))
def q_filter_language(spark, sf):
    return ids(FL.filter_language(corpus(spark, sf), "fr"))


KEYWORD_SQL = """(contains(lower(coalesce(title, '')), '{0}') or contains(lower(coalesce(summary, '')), '{0}')
  or contains(lower(full_text), '{0}'))"""
COMMISSIONER_SQL = "list_contains(string_split(coalesce(commissioners, ''), '; '), '{0}')"
POLICY_SQL = """(list_contains(string_split(coalesce(policy_areas, ''), '; '), '{0}')
  or list_contains(string_split(coalesce(policy_codes, ''), '; '), '{0}'))"""


@query("filter_keyword", ids_where(KEYWORD_SQL.format("ouelle")))
def q_filter_keyword(spark, sf):
    return ids(FL.filter_union(corpus(spark, sf), SearchSpec(keywords=("OuElle",))))


@query("filter_commissioner", ids_where(COMMISSIONER_SQL.format("Person 3")))
def q_filter_commissioner(spark, sf):
    return ids(FL.filter_union(corpus(spark, sf), SearchSpec(commissioners=("Person 3",))))


@query("filter_policy", ids_where(POLICY_SQL.format("SRC3")))
def q_filter_policy(spark, sf):
    return ids(FL.filter_union(corpus(spark, sf), SearchSpec(policy_areas=("SRC3",))))


@query(
    "filter_union",
    ids_where(" or ".join([
        KEYWORD_SQL.format("ouelle"), KEYWORD_SQL.format("uxpa"),
        COMMISSIONER_SQL.format("Person 3"), POLICY_SQL.format("src4"),
    ])),
)
def q_filter_union(spark, sf):
    spec = SearchSpec(keywords=("ouelle", "uxpa"), commissioners=("Person 3",), policy_areas=("src4",))
    return ids(FL.filter_union(corpus(spark, sf), spec))


@query("filter_nonempty_date", ids_where("date <> ''"))
def q_filter_nonempty_date(spark, sf):
    return ids(FL.filter_nonempty_date(corpus(spark, sf)))


@query(
    "build_descriptive",
    C + f"""select {corpus_columns()} from corpus where date between '1985-03-01' and '2019-12-31'
      and doc_type in ('SPEECH', 'MEMO', 'IP', 'PRES') and language = 'en'
      and ({COMMISSIONER_SQL.format('Person 1')} or {KEYWORD_SQL.format('ing')})""",
)
def q_build_descriptive(spark, sf):
    spec = SearchSpec(
        start=date(1985, 3, 1), end=date(2019, 12, 31), document_types=(" speech", "Memo", "ip", "pres"),
        commissioners=("Person 1",), keywords=("ing",),
    )
    return FL.build_descriptive(corpus(spark, sf), spec)


@query(
    "select_references",
    C + "select document_id, doc_type, date from corpus where doc_id % 3 = 1",
)
def q_select_references(spark, sf):
    wanted = keyed_corpus(spark, sf).where("doc_id % 3 = 1").select(
        F.concat(F.lit(" "), F.lower("reference")).alias("reference")
    )
    return ids(FL.select_references(corpus(spark, sf), wanted))


@query(
    "normalize_type_codes",
    C + f"""select doc_type, count(*) as n from corpus
      where doc_type in ({sql_list(ACTIVE_TYPES)}) group by doc_type""",
)
def q_normalize_type_codes(spark, sf):
    return stats.per_type_counts(FL.filter_types(corpus(spark, sf), normalize_type_codes([" Active "])))


@query(
    "unknown_types",
    C + f"select distinct upper(doc_type) as doc_type from corpus where upper(doc_type) not in ({sql_list(KNOWN_TYPES)})",
)
def q_unknown_types(spark, sf):
    return FL.unknown_types(corpus(spark, sf))


# --- Statistics --------------------------------------------------------------


@query("total_documents", C + "select count(*) as total_documents from corpus")
def q_total_documents(spark, sf):
    return stats.total_documents(corpus(spark, sf))


@query("cutoff", C + "select max(date) as cutoff from corpus where date <> ''")
def q_cutoff(spark, sf):
    return stats.cutoff(corpus(spark, sf))


@query("date_range", C + "select min(date) as first_date, max(date) as last_date from corpus where date <> ''")
def q_date_range(spark, sf):
    return stats.date_range(corpus(spark, sf))


@query("per_type_counts", C + "select doc_type, count(*) as n from corpus where doc_type is not null group by 1")
def q_per_type_counts(spark, sf):
    return stats.per_type_counts(corpus(spark, sf))


DISTRIBUTION = """
  select case when rk <= {top} then doc_type else '…' end as doc_type, cast(sum(n) as bigint) as n from (
    select *, row_number() over (order by n desc, doc_type) as rk from (
      select coalesce(doc_type, '(missing)') as doc_type, count(*) as n from corpus group by 1) a) b
  group by 1"""


@query("type_distribution", C + DISTRIBUTION.format(top=12))
def q_type_distribution(spark, sf):
    return stats.type_distribution(corpus(spark, sf))


@query("top_types", C + DISTRIBUTION.format(top=4))
def q_top_types(spark, sf):
    return stats.type_distribution(corpus(spark, sf), top=4)


SHARE = "avg(case when coalesce(detail_ok, false) then cast(1 as double) else cast(0 as double) end) * 100"


@query("detail_share", C + f"select round({SHARE}, 6) as detail_share from corpus")
def q_detail_share(spark, sf):
    return stats.detail_share(corpus(spark, sf)).select(F.round("detail_share", 6).alias("detail_share"))


@query(
    "status_report",
    C + f"""select count(*) as total_documents, min(nullif(date, '')) as first_date,
      max(nullif(date, '')) as last_date, round({SHARE}, 6) as detail_share from corpus""",
)
def q_status_report(spark, sf):
    return stats.status_report(corpus(spark, sf)).withColumn("detail_share", F.round("detail_share", 6))


@query(
    "overview",
    C + """select count(*) as documents, cast(min(try_cast(date as date)) as varchar) as first_date,
      cast(max(try_cast(date as date)) as varchar) as last_date, count(distinct doc_type) as types,
      (select upper(language) from corpus group by 1 order by count(*) desc, 1 limit 1) as language
      from corpus""",
)
def q_overview(spark, sf):
    return dates_as_text(stats.overview(corpus(spark, sf)))


LABELS = "labels_t(doc_type, label) as (values " + ", ".join(
    f"({sql_list([code])}, {sql_list([label])})" for code, label in TYPE_LABELS.items()
) + ")"
COVERAGE = """select c.doc_type, n, first_date, last_date, substring(first_date, 1, 4) as first_year,
  substring(last_date, 1, 4) as last_year, coalesce(label, '—') as label
  from (select doc_type, count(*) as n, min(date) as first_date, max(date) as last_date
        from corpus where doc_type is not null group by 1) c left join labels_t l on c.doc_type = l.doc_type"""


@query("coverage_by_type", C.rstrip() + f", {LABELS} " + COVERAGE)
def q_coverage_by_type(spark, sf):
    return stats.coverage_by_type(corpus(spark, sf))


@query("sort_types", C.rstrip() + f", {LABELS} select doc_type, n from ({COVERAGE}) order by n desc, doc_type")
def q_sort_types(spark, sf):
    return stats.coverage_by_type(legacy_corpus(spark, sf).drop("doc_type")).select("doc_type", "n")


@query(
    "type_labels",
    C.rstrip() + f""", {LABELS} select document_id, c.doc_type, coalesce(label, '—') as label
      from corpus c left join labels_t l on c.doc_type = l.doc_type""",
)
def q_type_labels(spark, sf):
    return stats.with_type_label(corpus(spark, sf).select("document_id", "doc_type"))


FIELD_SQL = {"Full text": "full_text", "Subtitle": "subtitle", "Summary": "summary", "Policy areas": "policy_areas",
             "Spokespersons": "spokespersons", "Commissioners": "commissioners", "Place": "place"}
DECADES = "dated as (select *, year(try_cast(date as date)) // 10 * 10 as decade from corpus)"
COMPLETENESS = " union all ".join(
    f"""select decade, '{label}' as field,
      avg(case when {column} <> '' then cast(1 as double) else cast(0 as double) end) as share
      from dated where decade >= 1980 group by decade"""
    for label, column in FIELD_SQL.items()
)


@query(
    "completeness_by_decade",
    C.rstrip() + f", {DECADES} select cast(decade as integer) as decade, field, round(share, 6) as share from ({COMPLETENESS})",
)
def q_completeness_by_decade(spark, sf):
    return stats.completeness_by_decade(corpus(spark, sf)).withColumn("share", F.round("share", 6))


@query(
    "completeness_table",
    C.rstrip() + f", {DECADES} select field, " + ", ".join(
        f'coalesce(round(max(share) filter (where decade = {d}), 6), 0) as "{d}"' for d in (1980, 1990, 2000, 2010, 2020, 2030)
    ) + f" from ({COMPLETENESS}) group by field",
)
def q_completeness_table(spark, sf):
    decades = [1980, 1990, 2000, 2010, 2020, 2030]
    wide = stats.completeness_table(corpus(spark, sf), decades)
    return wide.select("field", *[F.round(F.col(str(d)), 6).alias(str(d)) for d in decades])


@query(
    "docs_per_year_source",
    C + f"""select cast(year(try_cast(date as date)) as integer) as year,
      case when doc_type in ({sql_list(OTHER_INSTITUTION_TYPES)}) then '{OTHER_SOURCE}' else '{COMMISSION_SOURCE}' end as source,
      count(*) as n from corpus group by 1, 2""",
)
def q_docs_per_year_source(spark, sf):
    return stats.docs_per_year_source(corpus(spark, sf))


@query("sort_newest", C + "select document_id, date from corpus order by date desc nulls last, document_id")
def q_sort_newest(spark, sf):
    return ordered.sort_newest(corpus(spark, sf)).select("document_id", "date")


@query(
    "audit_windows",
    C + """select cast(row_number() over (order by m desc) - 1 as bigint) as position,
      cast(greatest(m, lo) as varchar) as date_from, cast(least(last_day(m), date'2026-06-15') as varchar) as date_to
      from (select lo, cast(unnest(generate_series(date_trunc('month', lo), timestamp '2026-06-01', interval 1 month)) as date) as m
            from (select min(try_cast(date as date)) as lo from corpus where date <> '') a) b""",
)
def q_audit_windows(spark, sf):
    return dates_as_text(audit_windows(corpus(spark, sf), date(2026, 6, 15)))


# --- Scalars -----------------------------------------------------------------

RAW_REF = "chr(9) || ' ' || upper(source) || '/26/' || cast(doc_id as {S}) || ' ' || chr(10)"


def documents(spark, sf):
    return table(spark, sf, "documents").withColumn("raw_ref", F.expr(RAW_REF.format(S="string")))


@query("document_id", "select doc_id, lower(source) || '_26_' || cast(doc_id as varchar) as document_id from documents")
def q_document_id(spark, sf):
    return documents(spark, sf).select("doc_id", X.document_id(F.col("raw_ref")).alias("document_id"))


@query("normalize_ref", "select doc_id, upper(source) || '/26/' || cast(doc_id as varchar) as reference from documents")
def q_normalize_ref(spark, sf):
    return documents(spark, sf).select("doc_id", X.normalize_ref(F.lower("raw_ref")).alias("reference"))


@query("nullable", C + "select document_id, nullif(subtitle, '') as subtitle, nullif(summary, '') as summary from corpus")
def q_nullable(spark, sf):
    return corpus(spark, sf).select(
        "document_id", X.nullable(F.col("subtitle")).alias("subtitle"), X.nullable(F.col("summary")).alias("summary")
    )


BLANKS = "chr(9) || chr(10) || chr(13) || ' ' || chr(160)"


@query(
    "join_nonempty",
    f"""select conv_id, turn, nullif(array_to_string(
      [trim(x, {BLANKS}) for x in string_split(text, ',') if trim(x, {BLANKS}) <> ''], '; '), '') as joined
      from conversations""",
)
def q_join_nonempty(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", X.join_nonempty(F.split("text", ",")).alias("joined")
    )


@query(
    "spokespersons",
    """select conv_id, turn, case turn % 4 when 0 then 'C' || cast(conv_id as varchar) || ' (desk)'
      when 1 then case when conv_id % 2 = 0 then 'desk' end
      else case when conv_id % 2 = 0 then role || ' C' || cast(conv_id as varchar) || ' (desk)'
                else role || ' C' || cast(conv_id as varchar) end end as label
      from (select *, conv_id % 2 as odd from conversations) c
      where turn % 4 <> 0 or conv_id % 2 = 0
      union all select conv_id, turn, 'C' || cast(conv_id as varchar) from conversations
      where turn % 4 = 0 and conv_id % 2 = 1""",
)
def q_spokespersons(spark, sf):
    contact = F.expr("case turn % 4 when 0 then null when 1 then ' ' else role || ' ' end")
    last = F.expr("case when turn % 4 = 1 then '' else ' C' || cast(conv_id as string) end")
    title = F.expr("case when conv_id % 2 = 0 then ' desk ' else '' end")
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", X.join_nonempty(F.array(X.contact_label(contact, last, title))).alias("label")
    )


@query(
    "detail_url",
    C + "select document_id, 'https://archive.example/detail/' || language || '/' || document_id as url from corpus",
)
def q_detail_url(spark, sf):
    return corpus(spark, sf).select(
        "document_id",
        X.detail_url("https://archive.example", F.col("language"), F.col("document_id")).alias("url"),
    )


@query(
    "pdf_url",
    C + """select document_id, 'https://archive.example/api/files/document/print/' || language || '/' || document_id
      || '/' || upper(replace(reference, '/', '_')) || '_' || upper(language) || '.pdf' as url from corpus""",
)
def q_pdf_url(spark, sf):
    return corpus(spark, sf).select(
        "document_id",
        X.pdf_url(
            "https://archive.example", F.col("language"), F.col("document_id"), F.col("reference")
        ).alias("url"),
    )


LANGUAGE_CODE = "case doc_id % 4 when 0 then null when 1 then '' when 2 then '  ' else ' ' || lang || ' ' end"


@query("record_language", "select doc_id, case when doc_id % 4 = 3 then lang else 'en' end as language from documents")
def q_record_language(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", X.record_language(F.expr(LANGUAGE_CODE), F.lit("en")).alias("language")
    )


@query(
    "format_api_date",
    "select o_orderkey, case when o_orderkey % 3 = 2 then null else strftime(o_orderdate, '%d%m%Y') end as api_date from orders",
)
def q_format_api_date(spark, sf):
    value = F.expr(
        "case o_orderkey % 3 when 0 then date_format(o_orderdate, 'yyyy-MM-dd') "
        "when 1 then date_format(o_orderdate, 'ddMMyyyy') else 'soon' end"
    )
    return table(spark, sf, "orders").select("o_orderkey", D.format_api_date(value).alias("api_date"))


@query(
    "month_bounds",
    """select o_orderkey, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') as month_start,
      strftime(last_day(o_orderdate), '%Y-%m-%d') as month_end from orders""",
)
def q_month_bounds(spark, sf):
    day = F.to_date("o_orderdate")
    return dates_as_text(
        table(spark, sf, "orders").select(
            "o_orderkey", D.month_start(day).alias("month_start"), D.month_end(day).alias("month_end")
        )
    )


@query(
    "decade",
    C + "select document_id, cast(year(try_cast(date as date)) // 10 * 10 as integer) as decade from corpus",
)
def q_decade(spark, sf):
    return corpus(spark, sf).select("document_id", D.decade(D.to_date(F.col("date"))).alias("decade"))


@query("coverage_years", C + "select document_id, substring(date, 1, 4) as year from corpus")
def q_coverage_years(spark, sf):
    return corpus(spark, sf).select("document_id", D.coverage_year(F.col("date")).alias("year"))


@query("row_digest", "select doc_id, sha256(text) as digest from documents")
def q_row_digest(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.row_digest(F.col("text")).alias("digest"))
