"""Windows, merging and auditing, over orders as an archive at scale."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from folioforge.operators import audit as A
from folioforge.operators import ledgers as L
from folioforge.operators import merge as M
from folioforge.operators import ordered
from folioforge.operators import windows as WN
from workload.registry import query
from workload.views import STORED_DUCK, archive, dates_as_text, stored_archive, table

MONTHS_DUCK = """limits as (select cast(min(o_orderdate) as date) as lo, cast(max(o_orderdate) as date) as hi from orders),
months as (
  select cast(row_number() over (order by m desc) - 1 as bigint) as position,
    greatest(m, lo) as date_from, least(last_day(m), hi) as date_to
  from (select lo, hi, cast(unnest(generate_series(date_trunc('month', lo), cast(hi as timestamp), interval 1 month)) as date) as m
        from limits) a)"""
YEARS_DUCK = """years as (
  select cast(row_number() over (order by y desc) - 1 as bigint) as position,
    greatest(make_date(y, 1, 1), lo) as date_from, least(make_date(y, 12, 31), hi) as date_to
  from (select lo, hi, unnest(generate_series(year(lo), year(hi))) as y from limits) a)"""
REMOTE_DUCK = """remote as (
  select date_from, date_to, count(o_orderkey) as api_count
  from months left join orders on cast(o_orderdate as date) between date_from and date_to group by 1, 2)"""
LOCAL_DUCK = """audit as (
  select m.position, m.date_from, m.date_to, api_count, coalesce(n, 0) as local_count,
    api_count - coalesce(n, 0) as difference,
    case when api_count > coalesce(n, 0) then 'deficient' when coalesce(n, 0) > api_count then 'surplus' else 'match' end as status
  from months m join remote r on m.date_from = r.date_from and m.date_to = r.date_to
  left join (select date_from, count(*) as n from months join stored
             on date between cast(date_from as varchar) and cast(date_to as varchar) group by 1) s
    on s.date_from = m.date_from)"""
WINDOW_TEXT = "position, cast(date_from as varchar) as date_from, cast(date_to as varchar) as date_to"


def with_duck(*parts: str) -> str:
    return "with " + ", ".join(parts) + "\n"


def limits(spark, sf):
    return archive(spark, sf).agg(F.min("day").alias("since"), F.max("day").alias("until"))


def months(spark, sf):
    return WN.month_windows(limits(spark, sf))


def remote_counts(spark, sf):
    """Counts a source would report: those of the whole archive."""
    whole = WN.window_counts(archive(spark, sf), months(spark, sf))
    return whole.select("date_from", "date_to", F.col("local_count").alias("api_count"))


def audit(spark, sf):
    return A.reconcile_windows(months(spark, sf), remote_counts(spark, sf), stored_archive(spark, sf))


# --- Windows -----------------------------------------------------------------


@query("month_windows", with_duck(MONTHS_DUCK) + f"select {WINDOW_TEXT} from months")
def q_month_windows(spark, sf):
    return dates_as_text(months(spark, sf))


@query("year_windows", with_duck(MONTHS_DUCK, YEARS_DUCK) + f"select {WINDOW_TEXT} from years")
def q_year_windows(spark, sf):
    return dates_as_text(WN.year_windows(limits(spark, sf)))


@query("newest_first", with_duck(MONTHS_DUCK) + f"select {WINDOW_TEXT} from months order by date_from desc")
def q_newest_first(spark, sf):
    return dates_as_text(ordered.newest_first(months(spark, sf)))


@query(
    "overlap_range",
    "select cast(cast(max(o_orderdate) as date) - 3 as varchar) as since, '2002-03-31' as until from orders",
)
def q_overlap_range(spark, sf):
    return dates_as_text(WN.overlap_range(archive(spark, sf), date(2002, 3, 31)))


@query(
    "window_counts",
    with_duck(MONTHS_DUCK, YEARS_DUCK, STORED_DUCK,
              "both_kinds as (select date_from, date_to from months union all select date_from, date_to from years "
              "union all select cast(lo + 100 as date), cast(hi - 100 as date) from limits)")
    + """select cast(date_from as varchar) as date_from, cast(date_to as varchar) as date_to, count(document_id) as local_count
      from both_kinds left join stored on date between cast(date_from as varchar) and cast(date_to as varchar)
      group by 1, 2""",
)
def q_window_counts(spark, sf):
    span = limits(spark, sf)
    wide = span.select(F.date_add("since", 100).alias("date_from"), F.date_sub("until", 100).alias("date_to"))
    mixed = (
        WN.month_windows(span).drop("position")
        .unionByName(WN.year_windows(span).drop("position"))
        .unionByName(wide)
    )
    return dates_as_text(WN.window_counts(stored_archive(spark, sf), mixed))


@query(
    "range_windows_wide",
    with_duck(MONTHS_DUCK, YEARS_DUCK, STORED_DUCK,
              "spans as (select date_from, date_to from years union all select cast(lo + 100 as date), cast(hi - 100 as date) from limits "
              "union all select cast(lo + 45 as date), cast(lo + 75 as date) from limits)")
    + """select cast(date_from as varchar) as date_from, cast(date_to as varchar) as date_to, doc_type, count(*) as documents
      from (select doc_type, case when o_orderkey % 11 = 4 then date || 'T10' when o_orderkey % 11 = 7 then substring(date, 1, 7) else date end as date
            from stored) x join spans on date between cast(date_from as varchar) and cast(date_to as varchar) group by 1, 2, 3""",
)
def q_range_windows_wide(spark, sf):
    """Windows of years, of all but the ends, and over two months; some dates are cut short or go on."""
    span = limits(spark, sf)
    add = lambda begin, end: span.select(begin.alias("date_from"), end.alias("date_to"))
    spans = (
        WN.year_windows(span).drop("position")
        .unionByName(add(F.date_add("since", 100), F.date_sub("until", 100)))
        .unionByName(add(F.date_add("since", 45), F.date_add("since", 75)))
    )
    odd = F.expr("case when o_orderkey % 11 = 4 then date || 'T10' when o_orderkey % 11 = 7 then substring(date, 1, 7) else date end")
    rows = stored_archive(spark, sf).select("doc_type", odd.alias("date"))
    joined = WN.range_window_join(rows, spans)
    return dates_as_text(joined.groupBy("date_from", "date_to", "doc_type").agg(F.count("*").alias("documents")))


@query(
    "range_window_join",
    with_duck(MONTHS_DUCK, STORED_DUCK)
    + """select document_id, cast(date_from as varchar) as date_from, cast(date_to as varchar) as date_to
      from stored join months on date between cast(date_from as varchar) and cast(date_to as varchar)""",
)
def q_range_window_join(spark, sf):
    rows = stored_archive(spark, sf).select("document_id", "date")
    return dates_as_text(WN.range_window_join(rows, months(spark, sf)).select("document_id", "date_from", "date_to"))


# --- Auditing ----------------------------------------------------------------

AUDIT_DUCK = with_duck(MONTHS_DUCK, REMOTE_DUCK, STORED_DUCK, LOCAL_DUCK)


@query(
    "reconcile_windows",
    AUDIT_DUCK + f"select {WINDOW_TEXT}, api_count, local_count, status, difference from audit",
)
def q_reconcile_windows(spark, sf):
    return dates_as_text(audit(spark, sf))


@query("dry_run_counts", AUDIT_DUCK + f"select {WINDOW_TEXT}, api_count, local_count, difference from audit")
def q_dry_run_counts(spark, sf):
    return dates_as_text(A.dry_run_counts(months(spark, sf), remote_counts(spark, sf), stored_archive(spark, sf)))


@query("mismatches", AUDIT_DUCK + f"select {WINDOW_TEXT}, api_count, local_count, status, difference from audit where status <> 'match'")
def q_mismatches(spark, sf):
    return dates_as_text(A.mismatches(audit(spark, sf)))


@query(
    "audit_summary",
    AUDIT_DUCK + """select count(*) as windows, count(*) filter (status = 'deficient') as deficient,
      count(*) filter (status = 'surplus') as surplus, cast(0 as bigint) as reconciled, cast(0 as bigint) as unknown,
      count(*) filter (status = 'match') as matched from audit""",
)
def q_audit_summary(spark, sf):
    return A.audit_summary(audit(spark, sf))


JUDGED = """select l_orderkey, l_linenumber, cast(sum(l_quantity) as bigint) as api, cast(sum(l_partkey % 50) as bigint) as local,
  bool_or(l_returnflag = 'A') as flag from lineitem group by 1, 2"""


def judged(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.sum("l_quantity").cast("bigint").alias("api"),
        F.sum(F.col("l_partkey") % 50).alias("local"),
        F.bool_or(F.col("l_returnflag") == "A").alias("flag"),
    )


@query(
    "audit_status",
    f"""select l_orderkey, l_linenumber, case when flag then 'reconciled' when api > local then 'deficient'
      when local > api then 'surplus' else 'match' end as status from ({JUDGED})""",
)
def q_audit_status(spark, sf):
    status = A.audit_status(F.col("api"), F.col("local"), F.col("flag"))
    return judged(spark, sf).select("l_orderkey", "l_linenumber", status.alias("status"))


@query("difference", f"select l_orderkey, l_linenumber, api - local as difference from ({JUDGED})")
def q_difference(spark, sf):
    return judged(spark, sf).select(
        "l_orderkey", "l_linenumber", A.difference(F.col("api"), F.col("local")).alias("difference")
    )


@query(
    "phantom_count",
    f"""select l_orderkey, l_linenumber, case when flag then greatest(api - local, 0) else cast(0 as bigint) end as phantoms
      from ({JUDGED})""",
)
def q_phantom_count(spark, sf):
    phantoms = A.phantom_count(F.col("api"), F.col("local"), F.col("flag"))
    return judged(spark, sf).select("l_orderkey", "l_linenumber", phantoms.alias("phantoms"))


@query(
    "phantom_check",
    with_duck(MONTHS_DUCK, STORED_DUCK) + """
      select cast(date_from as varchar) as date_from, cast(date_to as varchar) as date_to,
        bool_and(cast(o_orderkey as varchar) in (select document_id from stored) and o_custkey % 500 <> 7) as all_stored
      from months join orders on cast(o_orderdate as date) between date_from and date_to group by 1, 2""",
)
def q_phantom_check(spark, sf):
    listed = table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.col("o_orderkey").cast("string").alias("requested_id"),
        F.expr("case when o_custkey % 500 = 7 then '' else 'ref' end").alias("ref_code"),
    )
    enumerated = WN.range_window_join(listed, months(spark, sf))
    return dates_as_text(A.phantom_check(enumerated, stored_archive(spark, sf)))


# --- Merging -----------------------------------------------------------------

CUSTOMER = "case when o_custkey % 40 = 3 then null else o_custkey end"


@query(
    "keep_last",
    f"""select customer, o_orderkey, date from (
      select {CUSTOMER} as customer, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as date,
        row_number() over (partition by {CUSTOMER} order by o_orderdate desc, o_orderkey desc) as rn from orders) a where rn = 1""",
)
def q_keep_last(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.expr(CUSTOMER).alias("customer"), "o_orderkey", "o_orderdate"
    )
    latest = M.keep_last(orders, ["o_orderdate", "o_orderkey"], "customer")
    return latest.select("customer", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"))


FIRST_ORDER = "l_shipdate, l_linenumber, l_partkey, l_suppkey, l_extendedprice"


@query(
    "first_wins",
    f"""select l_orderkey, l_partkey, l_suppkey from (select *, row_number() over (partition by l_orderkey
      order by {FIRST_ORDER}) as rn from lineitem) a where rn = 1""",
)
def q_first_wins(spark, sf):
    lines = table(spark, sf, "lineitem")
    first = M.first_wins(lines, FIRST_ORDER.split(", "), "l_orderkey")
    return first.select("l_orderkey", "l_partkey", "l_suppkey")


@query(
    "search_union",
    """select o_orderkey, cast(case when o_orderstatus = 'O' then 0 when o_orderpriority = '1-URGENT' then 1 else 2 end as integer) as variant_no
      from orders where o_orderstatus = 'O' or o_orderpriority = '1-URGENT' or o_custkey % 7 = 0""",
)
def q_search_union(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey")
    found = [
        orders.where("o_orderstatus = 'O'"),
        orders.where("o_orderpriority = '1-URGENT'"),
        orders.where("o_custkey % 7 = 0"),
    ]
    return M.search_union(found, ["o_orderkey"], "o_orderkey").select("o_orderkey", "variant_no")


@query(
    "running_total",
    """select l_suppkey, n_line, cast(sum(lines) over (partition by l_suppkey order by n_line) as bigint) as so_far from (
      select l_suppkey, l_orderkey as n_line, count(*) as lines from lineitem group by 1, 2) a""",
)
def q_running_total(spark, sf):
    per_order = table(spark, sf, "lineitem").groupBy("l_suppkey", F.col("l_orderkey").alias("n_line")).agg(
        F.count("*").alias("lines")
    )
    return ordered.running_total(per_order, ["l_suppkey"], "n_line", {"so_far": "lines"}, bucket=512).select(
        "l_suppkey", "n_line", "so_far"
    )


INCOMING_DUCK = """incoming as (
  select cast(o_orderkey as varchar) as document_id, 'NEW ' || o_orderpriority as doc_type,
    strftime(o_orderdate, '%Y-%m-%d') as date, s as seq
  from orders join (select unnest([1, 2]) as s) t on s = 1 or o_orderkey % 10 = 0 where o_orderkey % 5 = 0)"""


def incoming(spark, sf):
    """Every fifth document again, some twice, with a changed type."""
    seq = F.explode(
        F.when(F.expr("o_orderkey % 10 = 0"), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    )
    return archive(spark, sf).where("o_orderkey % 5 = 0").select(
        "document_id",
        F.concat(F.lit("NEW "), "doc_type").alias("doc_type"),
        "date",
        seq.alias("seq"),
    ).withColumn("doc_type", F.concat("doc_type", F.lit(" v"), F.col("seq").cast("string")))


LAST_INCOMING = """select document_id, doc_type || ' v' || cast(max(seq) as varchar) as doc_type, date
  from incoming group by document_id, doc_type, date"""
NARROW = ("document_id", "doc_type", "date")


@query(
    "append_upsert",
    with_duck(STORED_DUCK, INCOMING_DUCK) + f"""select document_id, doc_type, date from stored
      where document_id not in (select document_id from incoming) union all {LAST_INCOMING}""",
)
def q_append_upsert(spark, sf):
    return M.append_upsert(stored_archive(spark, sf), incoming(spark, sf), ["seq"]).select(*NARROW)


@query(
    "append_upsert_repeated",
    with_duck(INCOMING_DUCK) + """select document_id, doc_type || ' v' || cast(max(seq) as varchar) as doc_type, date
      from incoming group by document_id, doc_type, date""",
)
def q_append_upsert_repeated(spark, sf):
    rows = incoming(spark, sf)
    return M.append_upsert(rows, rows.where("seq > 1"), ["seq"], stored_order=["seq"]).select(*NARROW)


@query(
    "insert_only_merge",
    with_duck(STORED_DUCK, INCOMING_DUCK) + """select document_id, doc_type, date from stored
      union all select document_id, doc_type || ' v1', date from incoming
      where seq = 1 and document_id not in (select document_id from stored)""",
)
def q_insert_only_merge(spark, sf):
    return M.insert_only_merge(stored_archive(spark, sf), incoming(spark, sf), ["seq"]).select(*NARROW)


@query(
    "replace_partials",
    with_duck(STORED_DUCK, INCOMING_DUCK) + f"""select document_id, doc_type, date from stored
      where document_id not in (select document_id from incoming where seq = 2) union all
      select document_id, doc_type || ' v2', date from incoming where seq = 2""",
)
def q_replace_partials(spark, sf):
    return M.replace_partials(
        stored_archive(spark, sf), incoming(spark, sf).where("seq = 2"), ["seq"]
    ).select(*NARROW)


@query(
    "new_documents",
    with_duck(STORED_DUCK) + """select cast(o_orderkey as varchar) as requested_id from orders
      where cast(o_orderkey as varchar) not in (select document_id from stored)""",
)
def q_new_documents(spark, sf):
    listed = archive(spark, sf).select(F.col("document_id").alias("requested_id"))
    return M.new_documents(listed, stored_archive(spark, sf))


@query(
    "missing_references",
    with_duck(STORED_DUCK) + """select distinct ' ' || cast(o_orderkey as varchar) as reference from orders
      where cast(o_orderkey as varchar) not in (select document_id from stored)""",
)
def q_missing_references(spark, sf):
    wanted = archive(spark, sf).select(F.concat(F.lit(" "), "document_id").alias("reference"))
    return M.missing_references(wanted.unionAll(wanted), stored_archive(spark, sf)).select("reference")


# --- Ledgers -----------------------------------------------------------------

PENDING_DUCK = """pending as (
  select position, date_from, case when position % 2 = 0 then date_to else date_to - 1 end as date_to
  from months where position % 7 = 3)"""


def pending(spark, sf):
    """Every seventh window; half of them clipped differently than requested."""
    return months(spark, sf).where("position % 7 = 3").withColumn(
        "date_to", F.expr("case when position % 2 = 0 then date_to else date_sub(date_to, 1) end")
    )


QUEUE_SQL = """select cast(date_from as varchar) as date_from, cast(date_to as varchar) as date_to, cast(min(k) as bigint) as {name}
  from (select date_from, date_to, position as k from pending
        union all select date_from, date_to, position + (select coalesce(max(position) + 1, 0) from pending) from months) q group by 1, 2"""


@query("window_queue", with_duck(MONTHS_DUCK, PENDING_DUCK) + QUEUE_SQL.format(name="queue_key"))
def q_window_queue(spark, sf):
    return dates_as_text(L.window_queue(pending(spark, sf), months(spark, sf)))


@query("window_ledger", with_duck(MONTHS_DUCK, PENDING_DUCK) + QUEUE_SQL.format(name="position"))
def q_window_ledger(spark, sf):
    return dates_as_text(L.window_ledger(pending(spark, sf), months(spark, sf)))


@query(
    "resolve_windows",
    AUDIT_DUCK.rstrip() + ", " + PENDING_DUCK + f"""
      select {WINDOW_TEXT} from pending p where not exists (select 1 from audit a
        where a.date_from = p.date_from and a.date_to = p.date_to and status = 'match')""",
)
def q_resolve_windows(spark, sf):
    done = audit(spark, sf).where("status = 'match'")
    left = L.resolve_windows(pending(spark, sf), done)
    return dates_as_text(left.select("position", "date_from", "date_to"))


CANARY = 700


@query(
    "canary_limit",
    with_duck(MONTHS_DUCK, STORED_DUCK) + f"""select document_id, queue_key from (
      select cast(o_orderkey as varchar) as document_id, position as queue_key,
        row_number() over (order by position, day(o_orderdate), o_orderkey) as rn
      from months join orders on cast(o_orderdate as date) between date_from and date_to) a where rn <= {CANARY}""",
)
def q_canary_limit(spark, sf):
    return _canary(spark, sf)[0].select("document_id", "queue_key")


def _canary(spark, sf):
    placed = WN.range_window_join(archive(spark, sf), months(spark, sf).drop("position"))
    queued = placed.join(months(spark, sf).select("date_from", F.col("position").alias("queue_key")), "date_from")
    missing = queued.withColumn("page_key", F.dayofmonth("day").cast("bigint")).withColumn("pos", F.col("o_orderkey"))
    return ordered.canary_limit(missing, CANARY)


@query(
    "canary_progress",
    with_duck(MONTHS_DUCK) + f"""select position as queue_key, count(*) as missing, count(*) filter (rn <= {CANARY}) as selected,
      count(*) filter (rn <= {CANARY}) = count(*) as complete from (
      select position, row_number() over (order by position, day(o_orderdate), o_orderkey) as rn
      from months join orders on cast(o_orderdate as date) between date_from and date_to) a group by position""",
)
def q_canary_progress(spark, sf):
    return _canary(spark, sf)[1]
