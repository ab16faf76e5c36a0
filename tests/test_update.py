from __future__ import annotations

from datetime import date

import pytest
from payloads import FEBRUARY, JANUARY, MARCH, SITE, detail, details, page, pages, ref_ledger, summary, window_rows
from pyspark.sql import functions as F

from folioforge.operators.records import normalize_schema
from folioforge.plans import update as U
from folioforge.schema import SearchSpec
from folioforge.session import stage
from folioforge.sources.corpus import empty_corpus, scan_snapshot


class World:
    """A corpus with its ledgers, carried from run to run."""

    def __init__(self, spark, corpus=None):
        self.spark = spark
        self.corpus = empty_corpus(spark) if corpus is None else corpus
        self.windows = window_rows(spark)
        self.refs = ref_ledger(spark)

    def run(self, requested, landed, answers, search=SearchSpec(), **options):
        run = U.run_windows(
            self.corpus,
            pages(self.spark, *landed),
            details(self.spark, answers),
            window_rows(self.spark, *requested),
            self.windows,
            self.refs,
            SITE,
            search,
            scraped_at="fixed",
            **options,
        )
        self.corpus = stage(U.merged_corpus(self.corpus, run), "corpus")
        self.windows, self.refs = stage(run.window_ledger, "windows"), run.ref_ledger
        self.outcomes = {(r.date_from, r.date_to): (r.status, r.additions) for r in run.windows.collect()}
        return run.summary.first()

    def ids(self):
        return sorted(r.document_id for r in self.corpus.collect())

    def pending(self):
        return sorted((r.date_from, r.date_to) for r in self.windows.collect())

    def pending_refs(self):
        return sorted(r.reference for r in self.refs.collect())


def test_a_failed_window_is_queued_while_others_finish(spark):
    world = World(spark)
    answers = {"IP/20/1": detail("IP/20/1"), "IP/20/2": detail("IP/20/2", "2020-02-10")}
    february = page(FEBRUARY, [summary("IP/20/2", "2020-02-10")])
    first = world.run([FEBRUARY, JANUARY], [february, page(JANUARY, [], status=502)], answers)
    assert (first.new_documents, first.failed_window_attempts, first.pending_windows) == (1, 1, 1)
    assert first.partial and world.ids() == ["ip_20_2"] and world.pending() == [JANUARY]

    second = world.run([], [page(JANUARY, [summary("IP/20/1")])], answers)
    assert (second.new_documents, second.pending_windows, second.partial) == (1, 0, False)
    assert world.ids() == ["ip_20_1", "ip_20_2"]


def test_a_partial_row_is_replaced_when_its_detail_arrives(spark):
    world = World(spark)
    first = world.run([JANUARY], [page(JANUARY, [summary("IP/20/1")])], {"IP/20/1": (503, "")})
    assert first.pending_refs == 1 and world.pending_refs() == ["IP/20/1"]
    assert (world.corpus.first().detail_ok, world.corpus.first().full_text) == (False, "")

    second = world.run([], [], {"IP/20/1": detail("IP/20/1")})
    assert (second.recovered_details, second.pending_refs, second.new_documents) == (1, 0, 0)
    row = world.corpus.first()
    assert world.corpus.count() == 1 and row.detail_ok and row.full_text != ""


def test_a_permanently_empty_detail_needs_no_retry(spark):
    world = World(spark)
    got = world.run([JANUARY], [page(JANUARY, [summary("BIO/85/1")])], {"BIO/85/1": " "})
    assert (got.new_documents, got.permanently_empty_details, got.pending_refs, got.partial) == (1, 1, 0, False)
    assert world.corpus.first().detail_ok is False


def test_a_later_permanently_empty_answer_clears_the_retry(spark):
    world = World(spark)
    assert world.run([JANUARY], [page(JANUARY, [summary("BIO/85/1")])], {}).pending_refs == 1
    second = world.run([], [], {"BIO/85/1": "\n"})
    assert (second.permanently_empty_details, second.pending_refs) == (1, 0)
    assert world.pending_refs() == []


def test_a_limit_leaves_the_rest_queued(spark):
    world = World(spark)
    landed = [
        page(MARCH, []),
        page(FEBRUARY, [summary("IP/20/2", "2020-02-10"), summary("IP/20/3", "2020-02-11")]),
        page(JANUARY, [summary("IP/20/1")]),
    ]
    first = world.run([MARCH, FEBRUARY, JANUARY], landed, {}, limit=1)
    assert (first.new_documents, first.completed_windows, first.pending_windows) == (1, 1, 2)
    assert first.limit_reached
    assert world.ids() == ["ip_20_2"] and world.pending() == [JANUARY, FEBRUARY]

    second = world.run([], landed, {}, limit=1)
    assert (second.new_documents, world.pending()) == (1, [JANUARY])
    assert world.ids() == ["ip_20_2", "ip_20_3"]
    with pytest.raises(ValueError):
        world.run([], landed, {}, limit=0)


def test_search_values_are_united_and_the_first_copy_wins(spark):
    world = World(spark)
    landed = [
        page(JANUARY, [summary("IP/20/1", title="first")], variant=0),
        page(JANUARY, [summary(" ip/20/1", title="second"), summary("IP/20/2")], variant=1),
        page(JANUARY, [], variant=2),
    ]
    got = world.run([JANUARY], landed, {}, SearchSpec(keywords=("a", "b"), policy_areas=("c",)))
    assert got.new_documents == 2
    assert {r.document_id: r.title for r in world.corpus.collect()} == {"ip_20_1": "first", "ip_20_2": "Harbour plans"}


def test_a_document_in_two_windows_counts_for_the_first_in_the_queue(spark):
    world = World(spark)
    clipped = (date(2020, 1, 5), date(2020, 1, 31))
    landed = [page(JANUARY, [summary("IP/20/1")]), page(clipped, [summary("IP/20/1"), summary("IP/20/2")])]
    world.run([clipped, JANUARY], landed, {})
    assert world.outcomes == {clipped: ("complete", 2), JANUARY: ("complete", 0)}


def test_a_blank_reference_fails_its_window(spark):
    world = World(spark)
    got = world.run([JANUARY], [page(JANUARY, [summary("IP/20/1"), summary(" ")])], {})
    assert (got.new_documents, got.failed_window_attempts, world.pending()) == (0, 1, [JANUARY])


def test_stored_documents_are_not_refreshed(spark):
    stored = normalize_schema(
        spark.createDataFrame([("ip_20_1", "kept", True)], "document_id string, title string, detail_ok boolean")
    )
    world = World(spark, stored)
    got = world.run([JANUARY], [page(JANUARY, [summary("IP/20/1"), summary("IP/20/2")])], {"IP/20/1": detail("IP/20/1")})
    assert got.new_documents == 1
    assert {r.document_id: r.title for r in world.corpus.collect()}["ip_20_1"] == "kept"


def test_running_twice_changes_nothing(spark):
    world = World(spark)
    landed = [page(JANUARY, [summary("IP/20/1"), summary("IP/20/2")])]
    answers = {"IP/20/1": detail("IP/20/1"), "IP/20/2": detail("IP/20/2")}
    world.run([JANUARY], landed, answers)
    before = sorted(map(tuple, world.corpus.collect()))
    again = world.run([JANUARY], landed, answers)
    assert again.new_documents == 0
    assert sorted(map(tuple, world.corpus.collect())) == before


def test_retry_outcomes(spark):
    stored = normalize_schema(
        spark.createDataFrame(
            [("ip_1", True, "T1"), ("ip_2", None, "T2"), ("ip_3", False, "T3"), ("ip_5", False, "T5")],
            "document_id string, detail_ok boolean, title string",
        )
    )
    ledger = ref_ledger(spark, {f"IP/{n}": {} for n in range(1, 6)})
    answers = {"IP/1": detail("IP/1"), "IP/2": detail("IP/2"), "IP/3": "", "IP/4": (500, "")}
    batch = U.retry_pass(ledger, stored, details(spark, answers), SITE, scraped_at="fixed")
    assert {r.reference: r.outcome for r in batch.refs.collect()} == {
        "IP/1": "stale", "IP/2": "ok", "IP/3": "permanently_empty", "IP/4": "transient", "IP/5": "transient",
    }
    assert {r.document_id: r.title for r in batch.rows.collect()} == {"ip_2": "Harbour widened", "ip_3": "T3"}
    assert sorted(r.reference for r in U.ledger_after(ledger, batch.refs).collect()) == ["IP/4", "IP/5"]


def test_a_run_is_appended_unless_it_replaces_rows(spark, tmp_path):
    root = str(tmp_path / "corpus")

    def step(landed, answers, ledger):
        corpus = scan_snapshot(spark, root)
        run = U.run_windows(
            corpus, pages(spark, *landed), details(spark, answers), window_rows(spark, JANUARY),
            window_rows(spark), ledger, SITE, SearchSpec(), scraped_at="fixed",
        )
        path = U.save_run(corpus, run, root)
        rows = scan_snapshot(spark, root).collect()
        return path.rsplit("/", 1)[-1], {r.document_id: r.detail_ok for r in rows}, run.ref_ledger

    one, two = summary("IP/20/1"), summary("IP/20/2")
    first, rows, ledger = step([page(JANUARY, [one])], {}, ref_ledger(spark))
    assert (first, rows) == ("snapshot=1", {"ip_20_1": False})
    second, rows, ledger = step([page(JANUARY, [one, two])], {"IP/20/2": detail("IP/20/2")}, ledger)
    assert (second, rows) == ("snapshot=1", {"ip_20_1": False, "ip_20_2": True})
    third, rows, ledger = step([page(JANUARY, [one, two])], {"IP/20/1": detail("IP/20/1")}, ledger)
    assert (third, rows) == ("snapshot=1", {"ip_20_1": True, "ip_20_2": True})


def test_requested_windows_queue_up_behind_pending_ones_in_every_run(spark):
    from folioforge.operators import ledgers as L

    schema = "position bigint, date_from date, date_to date"
    nothing = spark.createDataFrame([], schema)
    first = L.window_ledger(nothing, spark.createDataFrame([(0, *JANUARY)], schema))
    second = L.window_ledger(first, spark.createDataFrame([(0, *FEBRUARY)], schema))
    third = L.window_queue(second, spark.createDataFrame([(0, *MARCH), (1, *JANUARY)], schema)).orderBy("queue_key")
    assert [(r.date_from, r.queue_key) for r in third.collect()] == [(JANUARY[0], 0), (FEBRUARY[0], 1), (MARCH[0], 2)]


def test_a_window_without_all_its_search_values_fails(spark):
    queue = spark.createDataFrame([(*JANUARY, 0), (*FEBRUARY, 1)], "date_from date, date_to date, queue_key bigint")
    landed = pages(spark, page(JANUARY, [summary("IP/20/1")], variant=0), page(JANUARY, [summary("IP/20/2")], variant=1),
                   page(FEBRUARY, [summary("IP/20/3")], variant=0))
    two, three = SearchSpec(keywords=("a", "b")), SearchSpec(commissioners=("x", "y"), policy_areas=("z",))
    for search, want, rows in ((SearchSpec(), ["complete", "complete"], 2), (two, ["complete", "failed"], 2), (three, ["failed", "failed"], 0)):
        placed, listed = U.search_queue(queue, landed, search)
        assert [r.status for r in placed.orderBy("queue_key").collect()] == want
        assert listed.count() == rows
    stray = pages(spark, page(JANUARY, [summary("IP/20/1")], variant=0), page(JANUARY, [summary("IP/20/2")], variant=7))
    placed, _ = U.search_queue(queue, stray, two)
    assert {r.status for r in placed.collect()} == {"failed"}


def test_only_the_types_asked_for_are_listed(spark):
    memo = {"docutype": {"code": "memo ", "description": "Memo"}}
    landed = [page(JANUARY, [summary("IP/20/1"), summary("MEMO/20/2", **memo)])]
    world = World(spark)
    got = world.run([JANUARY], landed, {}, SearchSpec(document_types=("ip",)))
    assert (got.new_documents, got.completed_windows, world.ids()) == (1, 1, ["ip_20_1"])
    assert world.run([JANUARY], landed, {}, SearchSpec(document_types=("MEMO",))).new_documents == 1


def test_fixed_references(spark):
    stored = normalize_schema(spark.createDataFrame([("ip_1",)], "document_id string"))
    wanted = spark.createDataFrame([(" ip/1",), ("ip/2 ",), ("IP/2",), ("IP/3",)], "reference string")
    batch = U.run_fixed(stored, wanted, details(spark, {"IP/2": detail("IP/2")}), SITE, scraped_at="fixed")
    assert {r.reference: (r.detail_ok, r.outcome) for r in batch.rows.collect()} == {
        "IP/2": (True, "ok"), "IP/3": (False, "transient"),
    }


def test_a_reference_changed_by_its_detail_keeps_the_requested_id(spark):
    world = World(spark)
    world.run([JANUARY], [page(JANUARY, [summary("IP/20/1")])], {"IP/20/1": detail("IP/20/9")})
    assert world.ids() == ["ip_20_9"]


def test_a_dataset_keeps_its_scope():
    assert U.update_scope(None, None, full=True) == "active"
    assert U.update_scope(None, "all", full=True) == "all"
    assert U.update_scope("all") == "all"
    for arguments in (("all", "active", True), ("all", None, True), ("all", "all", False), (None, None, False), (None, "x", True)):
        with pytest.raises(ValueError):
            U.update_scope(*arguments)


def test_of_two_requests_for_one_document_the_later_one_wins(spark):
    world = World(spark)
    landed = [page(FEBRUARY, [summary("IP/20/1"), summary("IP/20/2")]), page(JANUARY, [summary("IP/20/3")])]
    answers = {
        "IP/20/1": detail("IP/20/2", place="x", publishDate="first"),
        "IP/20/2": detail("IP/20/2", publishDate="second"),
        "IP/20/3": detail("IP/20/1", publishDate="third"),
    }
    world.run([FEBRUARY, JANUARY], landed, answers)
    assert {r.document_id: r.publish_datetime for r in world.corpus.collect()} == {
        "ip_20_2": "second", "ip_20_1": "third",
    }


def test_a_queue_is_cut_down_without_the_texts_of_its_summaries(spark, tmp_path):
    """Texts are neither staged with the pages, nor with what is listed for the first time."""
    import random
    import re
    from pathlib import Path

    from folioforge.session import shared_dir

    rng = random.Random(3)
    text = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=200_000))
    folder = Path(re.sub("^file:/*", "/", shared_dir(spark))) / "folioforge"
    before = set(folder.glob("*"))
    landed = [page(JANUARY, [summary("IP/20/1", leadText=text), summary("IP/20/2", title="b")])]
    queue = window_rows(spark, JANUARY)
    run = U.run_windows(
        empty_corpus(spark), pages(spark, *landed), details(spark, {"IP/20/1": detail("IP/20/1")}), queue, window_rows(spark),
        ref_ledger(spark), SITE, SearchSpec(), scraped_at="fixed",
    )
    assert {r.document_id: len(r.summary or "") for r in run.rows.collect()} == {"ip_20_1": 200_000, "ip_20_2": 28}
    sizes = {}
    for table in set(folder.glob("*")) - before:
        sizes[table.name.rsplit("-", 1)[0]] = sum(f.stat().st_size for f in table.glob("*.parquet"))
    assert sizes["batch"] > 100_000
    assert max(sizes[name] for name in ("pages", "unique", "selected")) < 50_000
    # The first document is settled: only the other one's summary is kept for a retry.
    assert {r.reference: r.summary_json is None for r in run.rows.select("reference", "summary_json").collect()} == {
        "IP/20/1": True, "IP/20/2": False}


@pytest.fixture
def without_broadcasts(spark):
    """Sizes at which Spark broadcasts nothing by its own choice."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _shuffled_joins(df):
    """How many joins of a frame's plan shuffle both of their sides."""
    return df._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin")


def test_bodies_are_told_apart_where_they_are_read(spark, without_broadcasts):
    """However many summaries ask: no details are shuffled to find the wanted ones."""
    landed = details(spark, {f"IP/20/{n}": detail(f"IP/20/{n}") for n in range(40)})
    keys = [(f"IP/20/{n}", "en" if n % 2 else None) for n in range(10, 60)]
    wanted = U.wanted_details(landed, stage(spark.createDataFrame(keys, "ref_code string, language_code string"), "keys"))
    assert sorted(r.reference for r in wanted.collect()) == [f"IP/20/{n}" for n in range(10, 40)]
    assert _shuffled_joins(wanted) == 0
    assert wanted.columns == landed.columns


def test_a_filter_of_keys_loses_none_and_passes_few_others(spark):
    from folioforge.operators.merge import may_match

    rows = spark.range(200_000).selectExpr("id", "date'2020-01-01' + cast(id % 9 as int) as day", "if(id % 1000 = 1, null, 'x') as part")
    keys = rows.where("id % 10 = 3").select("day", F.col("id").cast("int").alias("id"))
    left = stage(may_match(rows, stage(keys, "keys"), ["id", "day"]), "left")
    assert left.columns == rows.columns
    assert left.where("id % 10 = 3").count() == 20_000 == left.where("id % 10 = 3").distinct().count()
    assert 20_000 <= left.count() < 21_000
    assert may_match(rows, keys.limit(0), ["id", "day"]).count() == 0


def test_rows_of_a_run_aren_t_shuffled_for_those_that_occur_once(spark, without_broadcasts):
    world = World(spark)
    two = [summary("IP/20/1"), summary("IP/20/2")]
    world.run([JANUARY], [page(JANUARY, two)], {})
    answers = {"IP/20/1": detail("IP/20/1", publishDate="first"), "IP/20/2": detail("IP/20/2"), "IP/20/3": detail("IP/20/3")}

    def rows(answers):
        run = U.run_windows(
            world.corpus, pages(spark, page(JANUARY, [*two, summary("IP/20/3")])), details(spark, answers),
            window_rows(spark, JANUARY), window_rows(spark), world.refs, SITE, SearchSpec(), scraped_at="fixed",
        )
        return U.run_rows(run, U.touched_ids(run))

    once = rows(answers)
    assert {r.document_id for r in once.collect()} == {"ip_20_1", "ip_20_2", "ip_20_3"}
    assert _shuffled_joins(once) == 0
    # A new document whose detail names it like a retried one comes later, and wins.
    again = rows({**answers, "IP/20/3": detail("IP/20/1", publishDate="second")})
    assert {r.document_id: r.publish_datetime for r in again.collect()}["ip_20_1"] == "second" and again.count() == 2
