"""Ingestion of landed payloads, top-up runs, retries and repair."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from folioforge.functions import text as X
from folioforge.functions import variants as V
from folioforge.functions.html import html_to_text, unescape
from folioforge.operators import audit as A
from folioforge.operators import ledgers as L
from folioforge.operators.merge import new_documents
from folioforge.operators.records import flatten_record, rebuild_retry_summary
from folioforge.plans import update as U
from folioforge.plans.dataset import corpus_root, update_dataset
from folioforge.plans.repair import audit_repair
from folioforge.schema import ACTIVE_TYPES, SearchSpec
from folioforge.session import new_path, stage
from folioforge.sources import landed as LD
from folioforge.sources.corpus import scan_snapshot
from folioforge.sources.ledgers import repair_ref_ledger
from folioforge.sources.parts import stored_days
from folioforge.sources.sinks import compact_corpus, replace_rows, write_corpus
from folioforge.streaming.feed import stream_dataset
from workload.registry import query
from workload.views import (
    SCRAPED_AT,
    SITE,
    corpus_columns,
    dates_as_text,
    detail_bodies,
    duck_views,
    feed,
    feed_windows,
    landed_details,
    landed_pages,
    page_bodies,
    ref_ledger,
    stored_feed,
    table,
)

FEED_DUCK = duck_views("feed")
PAGES_DUCK = duck_views("feed", "totals", "pg")
READ_DUCK = duck_views("feed", "totals", "pg", "reading", "marked", "lasts", "windows_read")
FLAT_DUCK = duck_views("feed", "detail", "flat")
RUN_VIEWS = ("feed", "totals", "pg", "reading", "marked", "lasts", "windows_read", "usable", "usable_windows", "detail", "flat")
SPAN = "cast(date_from as varchar) as date_from, cast(date_to as varchar) as date_to"


def facts(spark, sf):
    return LD.page_facts(LD.parse_pages(landed_pages(spark, sf)))


def summaries(spark, sf):
    """All listed summaries of the first search variant."""
    return LD.ingest_search_pages(landed_pages(spark, sf)).where("variant_no = 0")


def listed(spark, sf):
    """Every document of the feed as a summary, without the paging around it."""
    rows = feed(spark, sf).where("ref <> ' '")
    return rows.select(
        X.document_id(F.col("ref")).alias("requested_id"),
        F.col("ref").alias("ref_code"),
        "event_date",
        "title",
        "lead_text",
        F.col("code").alias("type_code"),
        F.concat(F.lit("Type "), F.col("code")).alias("type_name"),
        F.col("lang").alias("language_code"),
        F.lit("{}").alias("summary_json"),
    )


# --- Pages and counts --------------------------------------------------------


@query(
    "ingest_search_pages",
    PAGES_DUCK + f"""select {SPAN}, cast(pg.variant_no as integer) as variant_no, cast(f.page_no as integer) as page_no,
        trim(ref) as ref_code, lower(replace(trim(ref), '/', '_')) as requested_id, event_date, title, lead_text,
        code as type_code, 'Type ' || code as type_name, lang as language_code
      from feed f join (select w, page_no, variant_no from pg where page_ok and n_items > 0) pg
        on f.w = pg.w and f.page_no = pg.page_no""",
)
def q_ingest_search_pages(spark, sf):
    rows = LD.ingest_search_pages(landed_pages(spark, sf))
    return dates_as_text(rows.drop("pos", "summary_json"))


@query(
    "parse_pages",
    PAGES_DUCK + f"""select {SPAN}, cast(variant_no as integer) as variant_no, cast(page_no as integer) as page_no, page_ok,
        page_ok and total is not null as total_ok, case when page_ok then cast(total as bigint) end as total,
        cast(case when page_ok then n_listed else 0 end as integer) as n_listed,
        case when page_ok then cast(n_items as bigint) else 0 end as n_items from pg""",
)
def q_parse_pages(spark, sf):
    rows = facts(spark, sf).withColumn("total", F.when(F.col("page_ok"), F.col("total")))
    return dates_as_text(rows.drop("has_blank").withColumn("total_ok", F.col("page_ok") & F.col("total_ok")))


@query(
    "page_completeness",
    READ_DUCK + f"""select {SPAN}, case when w % 4 = 0 then status else 'failed' end as status, pages, items
      from windows_read""",
)
def q_page_completeness(spark, sf):
    # Two passes over the facts: staged, so that bodies are parsed once.
    # The second of two values landed for every fourth window only.
    search = SearchSpec(keywords=("first", "second"))
    return dates_as_text(LD.page_completeness(stage(facts(spark, sf), "page-facts"), search))


@query(
    "require_reference",
    FEED_DUCK.rstrip() + duck_views("totals", "pg").replace("with ", ", ", 1) + f"""
      select {SPAN}, bool_or(trim(ref) = '') as blank_reference from feed f
      where exists (select 1 from pg where pg.w = f.w and pg.page_no = f.page_no and page_ok) group by 1, 2""",
)
def q_require_reference(spark, sf):
    return dates_as_text(LD.require_reference(LD.ingest_search_pages(landed_pages(spark, sf))))


@query(
    "ingest_counts",
    PAGES_DUCK + f"select {SPAN}, case when page_ok then cast(total as bigint) end as api_count from pg",
)
def q_ingest_counts(spark, sf):
    """Every landed answer as that of a request for counts."""
    landed = landed_pages(spark, sf).select("batch_id", "date_from", "date_to", "http_status", "body")
    return dates_as_text(LD.ingest_counts(landed))


# --- Details -----------------------------------------------------------------


@query("classify_detail", FLAT_DUCK + "select ref as reference, outcome from detail")
def q_classify_detail(spark, sf):
    return landed_details(spark, sf).select(
        "reference", LD.classify_detail(F.col("http_status"), F.col("body")).alias("outcome")
    )


@query("attach_detail", FLAT_DUCK + "select document_id as requested_id, outcome, detail_ok as has_payload from flat")
def q_attach_detail(spark, sf):
    attached = U.attach_detail(listed(spark, sf), landed_details(spark, sf))
    return attached.select("requested_id", "outcome", F.col("detail").isNotNull().alias("has_payload"))


@query("flatten_record", FLAT_DUCK + f"select {corpus_columns()} from flat")
def q_flatten_record(spark, sf):
    attached = U.attach_detail(listed(spark, sf), landed_details(spark, sf))
    return flatten_record(attached, SITE, scraped_at=SCRAPED_AT)


@query(
    "partial_record",
    FEED_DUCK + """select lower(replace(ref, '/', '_')) as document_id, coalesce(title, '') as title,
        nullif(lead_text, '') as summary, code as doc_type, event_date as date, '' as full_text, false as detail_ok
      from feed where ref <> ' '""",
)
def q_partial_record(spark, sf):
    nothing = landed_details(spark, sf).where("reference is null")
    rows = flatten_record(U.attach_detail(listed(spark, sf), nothing), SITE, scraped_at=SCRAPED_AT)
    return rows.select("document_id", "title", "summary", "doc_type", "date", "full_text", "detail_ok")


@query(
    "policy_lists",
    FLAT_DUCK + "select reference, policy_areas, policy_codes, commissioners from flat where outcome = 'ok'",
)
def q_policy_lists(spark, sf):
    read = LD.read_details(landed_details(spark, sf)).where("outcome = 'ok'")
    return read.select("reference", "detail.policy_areas", "detail.policy_codes", "detail.commissioners")


@query(
    "type_guard",
    FLAT_DUCK + """select ref as reference, case when doc_id % 2 = 0 then 'Geneva' end as place,
        case doc_id % 5 when 1 then 2 when 2 then 2 when 3 then 0 end as contacts from detail where outcome = 'ok'""",
)
def q_type_guard(spark, sf):
    read = LD.detail_payloads(landed_details(spark, sf)).where("outcome = 'ok'")
    return read.select(
        "reference",
        V.text(F.col("payload"), "placeResource", "description").alias("place"),
        F.array_size(V.items(F.col("payload"), "contactsResource")).alias("contacts"),
    )


# --- HTML --------------------------------------------------------------------

HTML_WHITE = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ' || chr(160)"
HTML_SPLIT = (
    r"(?is)<script[^>]*>.*?</script\s*>|<style[^>]*>.*?</style\s*>|<template[^>]*>.*?</template\s*>|<!--.*?-->|<[!?/a-z][^>]*>"
)


def sql_unescape(value: str) -> str:
    """A reference ends with ';', or where the text ends because a tag follows."""
    for name, text in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        value = f"regexp_replace({value}, '&{name}(;|$)', '{text}', 'g')"
    return value


HTML_NODE = f"trim({sql_unescape('x')}, {HTML_WHITE})"


@query(
    "html_to_text",
    f"""select page_id, array_to_string([{HTML_NODE} for x in regexp_split_to_array(html, '{HTML_SPLIT}')
      if {HTML_NODE} <> ''], chr(10)) as full_text from pages""",
)
def q_html_to_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", html_to_text(F.col("html")).alias("full_text"))


@query(
    "html_references",
    """select doc_id, text || chr(65 + cast(doc_id % 26 as integer)) || 'é' || '’' || '&nosuch x & y' || '–' || '😀' || '&lt;'
      as decoded from documents""",
)
def q_html_references(spark, sf):
    rows = table(spark, sf, "documents")
    written = F.concat(
        F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("&#"), (F.col("doc_id") % 26 + 65).cast("string"),
        F.lit(";&eacute;&#146;&nosuch; x & y&ndash;&#x1F600;&amp;lt;"),
    )
    return rows.select("doc_id", unescape(written).alias("decoded"))


# --- Ledgers -----------------------------------------------------------------

LEDGER = """ledger as (
  select *, ref as reference, lower(replace(ref, '/', '_')) as id, doc_id % 3 = 0 as stored, doc_id % 3 = 0 and doc_id % 2 = 0 as stored_ok
  from feed where ref <> ' ' and doc_id % 5 = 1 and (doc_id % 3 = 0 or doc_id % 4 = 1))"""
LEDGER_DUCK = FEED_DUCK.rstrip() + ", " + LEDGER + "\n"
# The ledger summary names reference, title and language, unless it was no object.
KEPT = "doc_id % 7 <> 3"


@query(
    "scan_ledgers",
    LEDGER_DUCK + f"""select reference, case when {KEPT} then reference || '|' || lang else reference || '|' end as entry from ledger""",
)
def q_scan_ledgers(spark, sf):
    ledger = repair_ref_ledger(ref_ledger(spark, sf))
    summary = V.parse_object(X.strip(F.col("summary_json")))
    entry = F.concat(V.text(summary, "refCode"), F.lit("|"), F.coalesce(V.text(summary, "languageCode"), F.lit("")))
    return ledger.select("reference", entry.alias("entry"))


@query(
    "rebuild_retry_summary",
    LEDGER_DUCK + f"""select reference, id as requested_id, reference as ref_code,
        case when {KEPT} then case when doc_id % 2 = 0 then 'Ledger' end when stored then 'Stored' end as title,
        case when stored then event_date end as event_date, case when stored then 'Stored lead' end as lead_text,
        case when stored then code end as type_code, case when stored then 'Type ' || code end as type_name,
        case when {KEPT} or stored then lang end as language_code, stored_ok as already_complete from ledger""",
)
def q_rebuild_retry_summary(spark, sf):
    ledger, corpus = ref_ledger(spark, sf), stored_feed(spark, sf)
    return rebuild_retry_summary(ledger, L.ledger_latest(ledger, corpus)).drop("summary_json")


@query("ledger_latest", LEDGER_DUCK + "select id as document_id, 'Stored' as title, stored_ok as detail_ok from ledger where stored")
def q_ledger_latest(spark, sf):
    rows = L.ledger_latest(ref_ledger(spark, sf), stored_feed(spark, sf))
    return rows.select("document_id", "title", "detail_ok")


@query("unresolved_refs", LEDGER_DUCK + "select reference from ledger where not stored_ok")
def q_unresolved_refs(spark, sf):
    return L.unresolved_refs(ref_ledger(spark, sf), stored_feed(spark, sf)).select("reference")


@query("resolve_refs", LEDGER_DUCK + "select reference from ledger where doc_id % 4 <> 1")
def q_resolve_refs(spark, sf):
    settled = feed(spark, sf).where("doc_id % 4 = 1").select(F.col("ref").alias("reference"))
    return L.resolve_refs(ref_ledger(spark, sf), settled).select("reference")


# A retried reference asks for the language of its summary, or the default one.
RETRIED = f"""retried as (
  select l.*, case when stored_ok then 'stale' when not ({KEPT}) and not stored and lang <> 'en' then 'transient'
    else outcome end as result
  from ledger l join (select doc_id, outcome from detail) d using (doc_id))"""
RETRY_DUCK = duck_views("feed", "detail", "flat").rstrip() + ", " + LEDGER + ", " + RETRIED + "\n"


def retried(spark, sf):
    return U.retry_pass(
        ref_ledger(spark, sf), stored_feed(spark, sf), landed_details(spark, sf), SITE, scraped_at=SCRAPED_AT
    )


@query("retry_pass", RETRY_DUCK + "select reference, result as outcome from retried")
def q_retry_pass(spark, sf):
    return retried(spark, sf).refs.select("reference", "outcome")


@query(
    "retry_rows",
    RETRY_DUCK + f"""select f.document_id, f.detail_ok, f.full_text, f.place,
        case when r.result = 'ok' and r.doc_id % 4 <> 0 then f.title
             when {KEPT} then case when r.doc_id % 2 = 0 then 'Ledger' else '' end
             when stored then 'Stored' else '' end as title,
        case when stored then 'Stored lead' end as summary
      from retried r join flat f using (doc_id) where r.result in ('ok', 'permanently_empty')""",
)
def q_retry_rows(spark, sf):
    return retried(spark, sf).rows.select("document_id", "detail_ok", "full_text", "place", "title", "summary")


@query("ledger_after", RETRY_DUCK + "select reference from retried where result = 'transient'")
def q_ledger_after(spark, sf):
    return U.ledger_after(ref_ledger(spark, sf), retried(spark, sf).refs).select("reference")


# --- Runs --------------------------------------------------------------------


@query("process_batch", FLAT_DUCK + "select document_id, outcome, title, detail_ok, sha256(full_text) as digest from flat")
def q_process_batch(spark, sf):
    batch = U.process_batch(listed(spark, sf), landed_details(spark, sf), SITE, scraped_at=SCRAPED_AT)
    return batch.rows.select("document_id", "outcome", "title", "detail_ok", F.sha2("full_text", 256).alias("digest"))


@query(
    "build_fixed",
    FLAT_DUCK + """select document_id, outcome, detail_ok, case when detail_ok and doc_id % 4 <> 0 then title else '' end as title,
        case when detail_ok and doc_id % 8 <> 2 then doc_type else '' end as doc_type
      from (select *, outcome = 'ok' as found from flat) f where language = 'en' and doc_id % 3 <> 0 and doc_id % 4 < 2""",
)
def q_build_fixed(spark, sf):
    wanted = feed(spark, sf).where("ref <> ' ' and lang = 'en' and doc_id % 4 < 2").select(
        F.concat(F.lit(" "), F.lower("ref")).alias("reference")
    )
    batch = U.run_fixed(stored_feed(spark, sf), wanted, landed_details(spark, sf), SITE, scraped_at=SCRAPED_AT)
    return batch.rows.select("document_id", "outcome", "detail_ok", "title", "doc_type")


RUN = duck_views(*RUN_VIEWS).rstrip() + ", " + LEDGER + ", " + RETRIED + """, recovered as (
  select * from retried where result in ('ok', 'permanently_empty')), added as (
  select u.doc_id, u.w, f.outcome from usable u join flat f using (doc_id)
  where u.doc_id % 3 <> 0 and u.doc_id not in (select doc_id from recovered)), all_windows as (
  select cast(d as date) as date_from, last_day(d) as date_to,
    (year(d) - 2020) * 12 + month(d) - 1 as w
  from (select unnest(generate_series(timestamp '2020-01-01', timestamp '2023-12-01', interval 1 month)) as d) m)
"""


def run(spark, sf, **options):
    windows = feed_windows(spark)
    return U.run_windows(
        stored_feed(spark, sf), landed_pages(spark, sf), landed_details(spark, sf), windows,
        windows.where("position % 5 = 2"), ref_ledger(spark, sf), SITE, SearchSpec(), scraped_at=SCRAPED_AT, **options,
    )


@query(
    "run_windows",
    RUN + f"""select cast(a.date_from as varchar) as date_from, cast(a.date_to as varchar) as date_to,
        case when u.w is null then 'failed' else 'complete' end as status,
        (select count(*) from usable x where x.w = a.w) as listed,
        (select count(*) from added x where x.w = a.w) as additions
      from all_windows a left join usable_windows u on u.w = a.w""",
)
def q_run_windows(spark, sf):
    return dates_as_text(run(spark, sf).windows.drop("queue_key"))


@query(
    "run_rows",
    RUN + """select document_id, outcome, detail_ok, full_text from flat
      where doc_id in (select doc_id from added) or doc_id in (select doc_id from recovered)""",
)
def q_run_rows(spark, sf):
    return run(spark, sf).rows.select("document_id", "outcome", "detail_ok", "full_text")


@query(
    "run_summary",
    RUN + """select *, pending_windows > 0 or pending_refs > 0 as partial, false as limit_reached from (select
        (select count(*) from added) as new_documents,
        (select count(*) from recovered where result = 'ok') as recovered_details,
        (select count(*) from added where outcome = 'permanently_empty')
          + (select count(*) from recovered where result = 'permanently_empty') as permanently_empty_details,
        (select count(*) from usable_windows) as completed_windows,
        48 - (select count(*) from usable_windows) as failed_window_attempts,
        48 - (select count(*) from usable_windows) as pending_windows,
        (select count(*) from (select doc_id from added where outcome = 'transient'
           union select doc_id from retried where result = 'transient'
             and doc_id not in (select doc_id from added where outcome <> 'transient')) p) as pending_refs) s""",
)
def q_run_summary(spark, sf):
    return run(spark, sf).summary


@query(
    "run_limited",
    RUN + f""", ranked as (
      select x.*, row_number() over (order by q, page_no, pos) as rn from (
        select u.doc_id, u.w, u.page_no, u.pos, case when (47 - u.w) % 5 = 2 then 0 else 1 end * 1000 + 47 - u.w as q
        from usable u where u.doc_id % 3 <> 0 and u.doc_id not in (select doc_id from recovered)) x)
      select cast(a.date_from as varchar) as date_from, cast(a.date_to as varchar) as date_to,
        count(rn) filter (rn <= 40) as additions
      from all_windows a left join ranked r on r.w = a.w group by 1, 2""",
)
def q_run_limited(spark, sf):
    return dates_as_text(run(spark, sf, limit=40).windows.select("date_from", "date_to", "additions"))


@query(
    "merged_corpus",
    RUN + """select document_id, detail_ok from flat
        where doc_id in (select doc_id from added) or doc_id in (select doc_id from recovered)
      union all select document_id, doc_id % 2 = 0 from flat
        where doc_id % 3 = 0 and doc_id not in (select doc_id from recovered)""",
)
def q_merged_corpus(spark, sf):
    return U.merged_corpus(stored_feed(spark, sf), run(spark, sf)).select("document_id", "detail_ok")


@query(
    "save_run",
    RUN + """select document_id, detail_ok from flat
        where doc_id in (select doc_id from added) or doc_id in (select doc_id from recovered)
      union all select document_id, doc_id % 2 = 0 from flat
        where doc_id % 3 = 0 and doc_id not in (select doc_id from recovered)""",
)
def q_save_run(spark, sf):
    return scan_snapshot(spark, stored_run(spark, sf)).select("document_id", "detail_ok")


def stored_run(spark, sf):
    root = new_path(spark, "corpus")
    write_corpus(stored_feed(spark, sf), root)
    U.save_run(scan_snapshot(spark, root), run(spark, sf), root)
    return root


@query(
    "compact_corpus",
    RUN + """select document_id, detail_ok from flat
        where doc_id in (select doc_id from added) or doc_id in (select doc_id from recovered)
      union all select document_id, doc_id % 2 = 0 from flat
        where doc_id % 3 = 0 and doc_id not in (select doc_id from recovered)""",
)
def q_compact_corpus(spark, sf):
    """A corpus and a run that replaces some of its rows, folded into one part."""
    root = stored_run(spark, sf)
    compact_corpus(spark, root)
    return scan_snapshot(spark, root).select("document_id", "detail_ok")


@query(
    "stored_days",
    FEED_DUCK + """select case when doc_id % 2 = 0 then event_date else '2024-02-29' end as day, count(*) as n
      from feed where ref <> ' ' and doc_id % 3 = 0 group by 1""",
)
def q_stored_days(spark, sf):
    """Rows per day after partial rows were replaced by others, from the counts that each part keeps."""
    root = new_path(spark, "corpus")
    write_corpus(stored_feed(spark, sf), root)
    partial = scan_snapshot(spark, root).where("not detail_ok")
    replace_rows(partial.withColumn("date", F.lit("2024-02-29")), partial.select("document_id", "date"), root)
    return dates_as_text(stored_days(spark, root).where("not beyond").select("day", "n"))


ACTIVE_SQL = ", ".join(f"'{code}'" for code in ACTIVE_TYPES)


@query(
    "update_active_scope",
    RUN + f"""select document_id, detail_ok from flat where doc_id in (select doc_id from usable where code in ({ACTIVE_SQL}))""",
)
def q_update_active_scope(spark, sf):
    """A new dataset of the active types; what landed beyond them is left out."""
    root = new_path(spark, "dataset")
    update_dataset(
        spark, root, landed_pages(spark, sf), landed_details(spark, sf), SITE, date(2023, 12, 31),
        since=date(2020, 1, 1), full=True, scope="active", scraped_at=SCRAPED_AT,
    )
    return scan_snapshot(spark, corpus_root(root)).select("document_id", "detail_ok")


@query(
    "stream_ingest",
    RUN + """select document_id, detail_ok, sha256(full_text) as digest from flat where doc_id in (select doc_id from usable)""",
)
def q_stream_ingest(spark, sf):
    """Pages and details that land in several files, streamed into a dataset; failed windows store nothing."""
    pages, details, root, checkpoint = (new_path(spark, name) for name in ("pages", "details", "dataset", "stream-state"))
    page_bodies(spark, sf).repartition(3, "date_from", "page_no").write.option("compression", "zstd").parquet(pages)
    detail_bodies(spark, sf).repartition(3, "reference").write.option("compression", "zstd").parquet(details)
    stream_dataset(spark, pages, details, root, checkpoint, feed_windows(spark), SITE, SearchSpec(), files_per_batch=2, scraped_at=SCRAPED_AT)
    return scan_snapshot(spark, corpus_root(root)).select("document_id", "detail_ok", F.sha2("full_text", 256).alias("digest"))


@query(
    "latest_answers",
    FEED_DUCK + """select ref as reference, cast(case when doc_id % 3 = 0 then 3 else 1 end as bigint) as batch_id
      from feed where ref <> ' '""",
)
def q_latest_answers(spark, sf):
    first = landed_details(spark, sf)
    again = feed(spark, sf).where("ref <> ' ' and doc_id % 3 = 0").select(
        F.explode(F.array(F.lit(2).cast("bigint"), F.lit(3).cast("bigint"))).alias("batch_id"),
        F.col("ref").alias("reference"), F.col("lang").alias("language"), F.lit(200).alias("http_status"), F.lit("").alias("body"),
    )
    return LD.latest_answers(first.unionByName(again), ["reference", "language"]).select("reference", "batch_id")


@query(
    "update_windows",
    """select cast(row_number() over (order by m desc) - 1 as bigint) as position, cast(greatest(m, lo) as varchar) as date_from,
      cast(least(last_day(m), date'2002-03-10') as varchar) as date_to
      from (select lo, cast(unnest(generate_series(date_trunc('month', lo), timestamp '2002-03-01', interval 1 month)) as date) as m
            from (select cast(max(o_orderdate) as date) - 3 as lo from orders) a) b""",
)
def q_update_windows(spark, sf):
    stored = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"))
    return dates_as_text(U.update_windows(stored, date(2002, 3, 10)))


# --- Repair ------------------------------------------------------------------
# Reported counts: what each window lists, three more for the inflated ones.

REPAIR = duck_views(*RUN_VIEWS).rstrip() + """, remote as (
  select w, min(date_from) as date_from, min(date_to) as date_to, count(*) + case when w % 12 in (2, 4) then 3 else 0 end as api,
    count(*) filter (doc_id % 3 = 0 and ref <> ' ') as before_local
  from feed group by w), repaired as (
  select r.*, before_local + (select count(*) from usable u where u.w = r.w and u.doc_id % 3 <> 0) as after_local,
    r.w in (select w from usable_windows) as readable
  from remote r where api > before_local), second as (
  select *, after_local < api and readable and after_local = before_local as unchanged from repaired)
"""


def repair(spark, sf, search=None):
    """Everything that can be read is stored already, except for some windows."""
    pages, windows = landed_pages(spark, sf), feed_windows(spark)
    counts = feed(spark, sf).groupBy("date_from", "date_to").agg(
        (F.count("*") + F.when(F.first("w") % 12 == 2, 3).when(F.first("w") % 12 == 4, 3).otherwise(0)).alias("api_count")
    )
    corpus = stored_feed(spark, sf)
    before = A.reconcile_windows(windows, counts, corpus)
    return audit_repair(
        corpus, before, pages, landed_details(spark, sf), counts, pages, SITE, search or SearchSpec(), scraped_at=SCRAPED_AT
    )


@query(
    "audit_repair_unlanded",
    REPAIR + f""", landed as (select *, w % 4 = 0 as whole from repaired), judged as (
      select *, case when whole then after_local else before_local end as now,
        readable and whole and after_local = before_local and api > after_local as unchanged from landed)
      select {SPAN}, now as after_local, case when unchanged then 'reconciled' when api > now then 'deficient'
          when api < now then 'surplus' else 'match' end as status,
        case when unchanged then cast(api - now as bigint) else 0 end as phantom_count from judged""",
)
def q_audit_repair_unlanded(spark, sf):
    """Two search values, of which the second landed for every fourth window only."""
    repaired = repair(spark, sf, SearchSpec(keywords=("first", "second")))
    return dates_as_text(repaired.windows.select("date_from", "date_to", "after_local", "status", "phantom_count"))


@query(
    "audit_repair",
    REPAIR + f"""select {SPAN}, cast(api as bigint) as before_api, before_local, cast(api as bigint) as after_api, after_local,
        case when unchanged then 'reconciled' when api > after_local then 'deficient' when api < after_local then 'surplus' else 'match' end as status,
        case when unchanged then cast(api - after_local as bigint) else 0 end as phantom_count from second""",
)
def q_audit_repair(spark, sf):
    return dates_as_text(repair(spark, sf).windows)


def complete_feed(spark, sf):
    """A corpus that holds every listed document already."""
    nothing = landed_details(spark, sf).where("reference is null")
    return flatten_record(U.attach_detail(listed(spark, sf), nothing), SITE, scraped_at=SCRAPED_AT)


@query(
    "audit_repair_phantoms",
    REPAIR + """select cast(date_from as varchar) as date_from, case when readable and blank = 0 then cast(api - n as bigint) else 0 end as phantom_count,
        case when readable and blank = 0 then 'reconciled' else 'deficient' end as status
      from (select w, date_from, api, w in (select w from usable_windows) as readable,
              (select count(*) from feed f where f.w = r.w and ref <> ' ') as n,
              (select count(*) from feed f where f.w = r.w and ref = ' ') as blank
            from remote r) x
      where api > n""",
)
def q_audit_repair_phantoms(spark, sf):
    pages, windows = landed_pages(spark, sf), feed_windows(spark)
    counts = feed(spark, sf).groupBy("date_from", "date_to").agg(
        (F.count("*") + F.when(F.first("w") % 12 == 2, 3).when(F.first("w") % 12 == 4, 3).otherwise(0)).alias("api_count")
    )
    corpus = complete_feed(spark, sf)
    before = A.reconcile_windows(windows, counts, corpus)
    repaired = audit_repair(
        corpus, before, pages, landed_details(spark, sf), counts, pages, SITE, SearchSpec(), scraped_at=SCRAPED_AT
    )
    return dates_as_text(repaired.windows.select("date_from", "status", "phantom_count"))


@query(
    "new_summaries",
    PAGES_DUCK + """select lower(replace(ref, '/', '_')) as requested_id from feed f
      where doc_id % 3 <> 0 and ref <> ' ' and exists (select 1 from pg where pg.w = f.w and pg.page_no = f.page_no and page_ok)""",
)
def q_new_summaries(spark, sf):
    found = summaries(spark, sf).where("ref_code <> ''").select("requested_id")
    return new_documents(found, stored_feed(spark, sf))


