"""One query per operator over the supplied tables, next to SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from folioforge.llm.decontaminate import contamination
from folioforge.llm.extract import extract_pages
from folioforge.llm.jaccard import jaccard_components
from folioforge.llm.lines import line_digest
from folioforge.llm.mixing import TOPICS, mixed_decisions
from folioforge.llm.neighbours import near_vectors
from folioforge.llm.phrases import collocations
from folioforge.llm.quality import quality_scores
from folioforge.llm.repeats import repeat_digest
from folioforge.llm.secret_scan import duck_sql, secret_digest
from folioforge.llm.shards import shard_documents
from folioforge.llm.turns import damaged, repair_report
from folioforge.llm.warc import archive_round_trip

QUERIES = {}
ORACLES = {}
# The mixture that is asked for; sources have no named shares, theirs are tempered.
TARGETS = {"lang": {"en": 0.5, "fr": 0.2, "de": 0.15, "es": 0.15}, "topic": {f"topic{k}": 1 / TOPICS for k in range(TOPICS)}}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op8_ngram_jaccard_join", """
with recursive words as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') as w from documents),
grams as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as g from words),
sizes as (select doc_id, count(*) as n from grams group by 1),
links as (
  select a.doc_id as a, b.doc_id as b from grams a join grams b on a.g = b.g and a.doc_id <> b.doc_id
  join sizes x on x.doc_id = a.doc_id join sizes y on y.doc_id = b.doc_id
  group by 1, 2, x.n, y.n having 100 * count(*) >= 80 * (x.n + y.n - count(*))),
reach as (select doc_id as a, doc_id as b from documents union select r.a, l.b from reach r join links l on l.a = r.b)
select d.doc_id, cast(coalesce(n, 0) as bigint) as n_shingles, c.component_id
from documents d left join sizes s on s.doc_id = d.doc_id
join (select a, min(b) as component_id from reach group by 1) c on c.a = d.doc_id""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shingle count and the smallest id it reaches by links."""
    return jaccard_components(table(spark, sf_dir, "documents"))


@query("op10_embedding_near_duplicates", """
with units as (
  select vec_id, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings),
links as (
  select a.vec_id as a, b.vec_id as b from units a join units b on a.vec_id <> b.vec_id
  where list_cosine_similarity(a.v, b.v) >= 0.9),
reach as (select vec_id as a, vec_id as b from embeddings union select r.a, l.b from reach r join links l on l.a = r.b)
select e.vec_id, cast(coalesce(n, 0) as bigint) as n_links, component_id, e.vec_id = component_id as kept
from embeddings e left join (select a, count(distinct b) as n from links group by 1) l on l.a = e.vec_id
join (select a, min(b) as component_id from reach group by 1) c on c.a = e.vec_id""".replace("with", "with recursive", 1))
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's links at cosine 0.9 and the smallest id it reaches."""
    return near_vectors(table(spark, sf_dir, "embeddings"))


@query("op5_line_dedup", """
with lines as (
  select doc_id, unnest(x) as line, unnest(range(1, len(x) + 1)) as pos
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as x from documents) a),
keys as (
  select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines),
marked as (
  select *, length(key) >= 10 and doc_id > min(doc_id) over (partition by key) as goes from keys)
select doc_id, count(*) as n_lines, cast(sum(cast(goes as int)) as bigint) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not goes), '')) as kept_sha256
from marked group by doc_id""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines, those dropped, and the digest of what stays."""
    return line_digest(table(spark, sf_dir, "documents"))


@query("op1_proportional_interleaving")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot among 16."""
    return shard_documents(table(spark, sf_dir, "documents"), 16)


@query("op9_secret_scan", duck_sql())
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets, with the weak parts that others confirm."""
    return secret_digest(table(spark, sf_dir, "documents"))


@query("op6_quality_classifier")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score."""
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_benchmark_decontamination")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document holds, with its place and distance."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op7_mixing_to_target_weights")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's cell, weight and number of copies, for named shares of languages and topics."""
    return mixed_decisions(table(spark, sf_dir, "documents"), TARGETS)


@query("op3_warc_round_trip", """
with p as (select page_id, coalesce(html, '') as h, strlen(coalesce(html, '')) as n from pages),
f as (select *, sha1(h) as d, max(page_id) over (partition by h) as top from p)
select page_id, n as payload_bytes, d as payload_digest,
  case when n >= 1000 and page_id < top then 'revisit' else 'response' end as record_type,
  case when n >= 1000 and page_id < top then top end as refers_to from f""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's payload after a round trip through WARC archives."""
    return archive_round_trip(table(spark, sf_dir, "pages"))


@query("op2_html_main_text")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    return extract_pages(table(spark, sf_dir, "pages"))


@query("op13_phrase_collocations", """
with pieces as (
  select coalesce(lang, 'und') as lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[.,;:!?\\x0A-\\x0D]')) as p from documents),
words as (select lang, regexp_extract_all(p, '[^\\x20\\x09]+') as w from pieces),
grams as (
  select lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) as phrase
  from words, (select unnest([1, 2, 3, 4, 5]) as k) ks where len(w) >= k),
f as (select lang, k, phrase, count(*) as f from grams group by all),
n as (select lang, sum(f)::bigint as n from f where k = 1 group by 1),
c as (select *, string_split(phrase, ' ') as w from f where k >= 2 and f >= 100),
cuts as (
  select lang, phrase, k, f, j, array_to_string(w[1:j], ' ') as p, array_to_string(w[j + 1:], ' ') as q
  from c, (select unnest([1, 2, 3, 4]) as j) js where j < k),
scored as (
  select x.lang, x.phrase, x.k, x.f as a, l.f as l, r.f as r, n, j,
    ((1000::hugeint * x.f * n) // (l.f::hugeint * r.f))::bigint as score
  from cuts x join f l on l.lang = x.lang and l.phrase = p join f r on r.lang = x.lang and r.phrase = q
  join n on n.lang = x.lang
  qualify row_number() over (partition by x.lang, x.phrase order by score, j) = 1),
kept as (
  select * from scored s where not exists (
    select 1 from c where c.lang = s.lang and c.k > s.k and c.f >= s.a
      and contains(' ' || c.phrase || ' ', ' ' || s.phrase || ' ')))
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from kept qualify rank <= 2000""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 closest phrases of two to five words."""
    return collocations(table(spark, sf_dir, "documents"))


@query("op12_repeated_bytes", """
with d as (
  select doc_id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, ''))) as n from documents),
strings as (
  select doc_id, x, md5_number(substr(h, 2 * x + 1, 800)) as s
  from (select doc_id, h, unnest(range(0, n - 399)) as x from d where n >= 400) a),
repeated as (select doc_id, x from strings qualify count(*) over (partition by s) > 1),
marked as (
  select *, sum(cast(x > before + 400 as int)) over (partition by doc_id order by x) as run
  from (select *, lag(x, 1, -1000) over (partition by doc_id order by x) as before from repeated) a),
runs as (select doc_id, run, min(x) as low, max(x) + 400 as high from marked group by 1, 2),
pieces as (
  select r.doc_id, low, high, substr(h, 2 * before + 1, 2 * (low - before)) as piece,
    substr(h, 2 * high + 1) as rest, low = max(low) over (partition by r.doc_id) as final
  from (select *, lag(high, 1, 0) over (partition by doc_id order by low) as before from runs) r join d on d.doc_id = r.doc_id),
kept as (
  select doc_id, sum(high - low)::bigint as n_removed, count(*) as n_spans,
    string_agg(piece, '' order by low) || max(rest) filter (final) as kept from pieces group by 1)
select d.doc_id, n::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(unhex(coalesce(kept, h))) as kept_sha256
from d left join kept k on k.doc_id = d.doc_id""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes that strings of 400 bytes repeat, and the digest of what stays."""
    return repeat_digest(table(spark, sf_dir, "documents"))


@query("op11_conversation_repair")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults after the set damage, and its cheapest repair."""
    turns = table(spark, sf_dir, "conversations")
    return repair_report(turns, damaged(turns))
