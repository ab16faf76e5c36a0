"""Secrets in texts, and weak parts of credentials that other parts nearby confirm."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioforge.session import stage


@dataclass(frozen=True)
class Kind:
    """A pattern with the condition (SQL over ``m``) that a match has to meet, and its role."""

    name: str
    role: str
    pattern: str
    holds: str
    weak: bool = False


ASSIGN = ("([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
          "|[aA][pP][iI]_?[kK][eE][yY])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
USER = "([uU][sS][eE][rR]([nN][aA][mM][eE])?|[lL][oO][gG][iI][nN]|[cC][lL][iI][eE][nN][tT]_?[iI][dD])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.@=-]+)"

#: In the order in which spans of one start are listed. Strong kinds are reported always.
KINDS = (
    Kind("assign", "secret", ASSIGN, "length(regexp_extract(m, {ASSIGN}, 2)) >= 6"),
    Kind("access", "identifier", "AKIA[A-Z0-9]+", "length(m) >= 20"),
    # Runs shorter than 24 fail the condition anyway; leaving them out here keeps arrays short.
    Kind("hex", "secret", "[0-9a-f]{24,}", "length(m) >= 24"),
    Kind("user", "identifier", USER, "length(m) >= 8", weak=True),
    Kind("key", "secret", "[A-Za-z0-9/+=]{40,}",
         "length(m) = 40 and m not like '%=%' and regexp_extract(m, '[A-Z]', 0) <> '' and regexp_extract(m, '[a-z]', 0) <> ''"
         " and regexp_extract(m, '[0-9]', 0) <> ''", weak=True),
    Kind("endpoint", "endpoint", "(https?|s3|ftp|postgres|mysql)://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]+", "length(m) >= 10", weak=True),
)
SCOPE = 300  # code points between two spans of one scope, at most


def quoted(text: str) -> str:
    """A SQL literal that Spark (raw) reads as ``text``."""
    return 'r"' + text.replace('"', "\\x22") + '"'


def _condition(kind: Kind) -> str:
    return kind.holds.replace("{ASSIGN}", quoted(ASSIGN))


def spans_of(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, parts): one row (doc_id, text_key) per document, and every span, weak ones too.

    Parts are doc_id, text_key, kind (number), start, end in code points. SQL has no function
    for the positions of all matches, but the pieces between matches and the matches take
    turns, so positions are running sums of their lengths.
    """
    text = F.coalesce("text", F.lit(""))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    hits = texts.withColumns({f"m{k}": F.expr(f"regexp_extract_all(text, {quoted(kind.pattern)}, 0)") for k, kind in enumerate(KINDS)})
    found = F.array(*(
        F.struct(F.lit(k).alias("kind"),
                 F.when(F.size(f"m{k}") > 0, F.expr(f"transform(split(text, {quoted(kind.pattern)}, -1), x -> length(x))")).alias("gaps"),
                 F.expr(f"transform(m{k}, m -> struct(length(m) as size, {_condition(kind)} as holds))").alias("hits"))
        for k, kind in enumerate(KINDS)))
    rows = stage(hits.select("doc_id", "text_key", F.filter(found, lambda x: F.size(x["hits"]) > 0).alias("found")), "hits")
    one = (rows.where("size(found) > 0").dropDuplicates(["doc_id", "text_key"])
           .select("doc_id", "text_key", F.explode("found").alias("f"))
           .select("doc_id", "text_key", "f.kind", "f.gaps", F.posexplode("f.hits").alias("place", "hit"))
           .select("doc_id", "text_key", "kind", "place", F.expr("gaps[place]").alias("gap"), "hit.size", "hit.holds"))
    # A document's matches of one kind; repeated texts are sorted by themselves.
    upto = Window.partitionBy("doc_id", "text_key", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    parts = (one.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto))
             .where("holds").select("doc_id", "text_key", "kind", (F.col("end") - F.col("size")).alias("start"), "end"))
    return rows.select("doc_id", "text_key"), stage(parts, "parts")


def _numbers(test) -> str:
    return ", ".join(str(k) for k, kind in enumerate(KINDS) if test(kind))


def linked(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak parts that complementary parts confirm.

    A scope is a document's stretch of ``scope`` code points around a span. A weak secret needs
    an identifier in its scope, a weak identifier a secret, an endpoint both. Spans meet in
    stretches of the text that they touch, an equality join with a bounded number of spans a
    stretch; of the meetings only two flags a span are kept.
    """
    def touched(lo: str, hi: str):
        return F.explode(F.expr(f"sequence(greatest(0, {lo}) div {scope}, ({hi}) div {scope})"))

    keys = ["doc_id", "text_key"]
    weak = parts.where(f"kind in ({_numbers(lambda k: k.weak)})").withColumn("stretch", touched("start", "end"))
    others = (parts.where(f"kind not in ({_numbers(lambda k: k.role == 'endpoint')})")
              .select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_text"), F.col("start").alias("_start"),
                      F.col("end").alias("_end"), F.expr(f"kind in ({_numbers(lambda k: k.role == 'secret')})").alias("secret"),
                      touched(f"start - {scope}", f"end + {scope}").alias("_stretch")))
    near = ((weak["stretch"] == others["_stretch"]) & (weak["text_key"] == others["_text"]) & weak["doc_id"].eqNullSafe(others["_doc"])
            & (F.greatest(weak["start"], others["_start"]) - F.least(weak["end"], others["_end"]) <= scope))
    flags = (weak.join(others, near).groupBy(*keys, "kind", "start", "end")
             .agg(F.max("secret").alias("by_secret"), F.min("secret").alias("no_identifier")))
    return flags.where(
        f"(kind in ({_numbers(lambda k: k.weak and k.role == 'secret')}) and not no_identifier)"
        f" or (kind in ({_numbers(lambda k: k.weak and k.role == 'identifier')}) and by_secret)"
        f" or (kind in ({_numbers(lambda k: k.role == 'endpoint')}) and by_secret and not no_identifier)"
    ).select(*keys, "kind", "start", "end")


def scan_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(doc_id, text_key, spans) for every row of ``docs`` (doc_id, text).

    ``spans`` lists struct(start, number, end, kind, weak) by start, then kind; null and clean
    texts have an empty list. Rows that repeat a doc_id and text get the same list.
    """
    rows, parts = spans_of(docs)
    kind = F.element_at(F.array(*(F.lit(k.name) for k in KINDS)), F.col("number") + 1)
    reported = parts.where(f"kind in ({_numbers(lambda k: not k.weak)})").unionByName(linked(parts, scope))
    lists = (reported.withColumnRenamed("kind", "number")
             .withColumn("span", F.struct("start", "number", "end", kind.alias("kind"),
                                          F.expr(f"number in ({_numbers(lambda k: k.weak)})").alias("weak")))
             .groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_list("span")).alias("spans")))
    lists = lists.withColumnsRenamed({"doc_id": "_doc", "text_key": "_text"})
    match = (rows["text_key"] == lists["_text"]) & rows["doc_id"].eqNullSafe(lists["_doc"])
    none = F.expr("array()").cast(lists.schema["spans"].dataType)
    return rows.join(lists, match, "left").select("doc_id", "text_key", F.coalesce("spans", none).alias("spans"))


def secret_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans for every row of ``docs``."""
    def written(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    found = scan_secrets(docs)
    base = F.filter("spans", lambda s: ~s["weak"])
    numbers = (F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as long)").alias(f"n_{k}") for k in ("assign", "access", "hex"))
    return found.select("doc_id", *numbers,
                        F.sha2(F.encode(written(base), "UTF-8"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def duck_sql() -> str:
    """DuckDB SQL for the rows of ``secret_digest`` over ``documents``."""
    def lit(text):
        return "'" + text.replace("'", "''") + "'"

    kinds = " union all ".join(
        f"""select doc_id, {k} as kind, unnest(range(1, len(ms) + 1)) as place, unnest(gs[1:len(ms)]) as gap, unnest(ms) as m
        from (select doc_id, regexp_extract_all(text, {lit(kind.pattern)}) as ms, list_transform(string_split_regex(text, {lit(kind.pattern)}), lambda x: length(x)) as gs
              from (select doc_id, coalesce(text, '') as text from documents) a) b""" for k, kind in enumerate(KINDS))
    holds = " ".join(f"when {k} then {kind.holds.replace('{ASSIGN}', lit(ASSIGN))}" for k, kind in enumerate(KINDS))
    roles = " ".join(f"when {k} then '{kind.role}'" for k, kind in enumerate(KINDS))
    names = " ".join(f"when {k} then '{kind.name}'" for k, kind in enumerate(KINDS))
    return f"""
with hits as ({kinds}),
placed as (select doc_id, kind, m, cast(sum(gap + length(m)) over (partition by doc_id, kind order by place) as bigint) as stop from hits),
parts as (select doc_id, kind, case kind {roles} end as role, kind in ({_numbers(lambda k: k.weak)}) as weak,
  case kind {names} end || ':' || (stop - length(m)) || ':' || stop as name, stop - length(m) as start, stop
  from placed where case kind {holds} end),
flags as (select p.doc_id, p.kind, p.start, bool_or(o.role = 'secret') as s, bool_or(o.role = 'identifier') as i
  from parts p join parts o on o.doc_id = p.doc_id and o.role <> 'endpoint' and greatest(p.start, o.start) - least(p.stop, o.stop) <= {SCOPE}
  where p.weak group by 1, 2, 3),
kept as (select p.* from parts p left join flags f on f.doc_id = p.doc_id and f.kind = p.kind and f.start = p.start
  where not p.weak or (p.role = 'secret' and f.i) or (p.role = 'identifier' and f.s) or (p.role = 'endpoint' and f.i and f.s))
select d.doc_id, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access, count(*) filter (kind = 2) as n_hex,
  sha256(coalesce(string_agg(name, ',' order by start, kind) filter (not weak), '')) as base_sha256,
  coalesce(string_agg(name, ',' order by start, kind), '') as spans
from documents d left join kept k on k.doc_id = d.doc_id group by d.doc_id"""
