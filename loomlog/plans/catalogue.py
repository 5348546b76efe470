"""Queries of the log-analytics operators over the driver's tables, each with its DuckDB SQL.

conversations play the part of transcripts, events of tool calls and run records, orders of a change
log, documents of digests and benchmark of source texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomlog.functions import contamination, grounding, redaction, references, text
from loomlog.operators import blocks, changelog, digest, sessions, state, survey, trend
from loomlog.plans.registry import QUERIES, SQL, query, t

__all__ = ["QUERIES", "SQL"]


# --------------------------------------------------------------------------- sessions


def _turns(spark, d):
    return sessions.segment_turns(t(spark, d, "conversations"), "conv_id", ["turn"], F.col("role") == "user")


_TURNS = "SELECT *, greatest(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) - 1, 0)::BIGINT AS turn_ix FROM conversations"


@query(f"SELECT conv_id, turn, role, turn_ix FROM ({_TURNS})")
def turn_segmentation(spark, d):
    return _turns(spark, d).select("conv_id", "turn", "role", "turn_ix")


@query(f"""SELECT conv_id, turn_ix, count(*) FILTER (role = 'assistant') AS n_assistant, sum(length(text))::BIGINT AS chars,
  arg_min(sha256(text), turn) AS first_sha, arg_max(sha256(text), turn) AS last_sha FROM ({_TURNS}) GROUP BY ALL""")
def turn_rollup(spark, d):
    return _turns(spark, d).groupBy("conv_id", "turn_ix").agg(
        F.count_if(F.col("role") == "assistant").alias("n_assistant"), F.sum(F.length("text")).alias("chars"),
        F.min_by(F.sha2("text", 256), "turn").alias("first_sha"), F.max_by(F.sha2("text", 256), "turn").alias("last_sha"),
    )


@query(f"""SELECT conv_id, count(*) AS records, count(DISTINCT turn_ix) AS turns, sum(length(text))::BIGINT AS raw_chars, ((sum(length(text)) + 3) // 4)::BIGINT AS token_estimate
  FROM ({_TURNS}) GROUP BY conv_id""")
def session_counters(spark, d):
    chars = F.sum(F.length("text"))
    return _turns(spark, d).groupBy("conv_id").agg(F.count(F.lit(1)).alias("records"), F.countDistinct("turn_ix").alias("turns"), chars.alias("raw_chars"), text.token_estimate(chars).alias("token_estimate"))


@query("""SELECT event_id, event_type, CASE event_type WHEN 'click' THEN 'search' WHEN 'view' THEN 'file_read' WHEN 'purchase' THEN 'file_write' WHEN 'signup' THEN 'agent' ELSE 'other' END AS kind,
  coalesce(json_extract_string(props, '$.k'), '') AS target FROM events""")
def event_kind_classify(spark, d):
    tool = F.when(F.col("event_type") == "click", "Grep").when(F.col("event_type") == "view", "Read").when(F.col("event_type") == "purchase", "Write").when(F.col("event_type") == "signup", "Task").otherwise("Unknown")
    k = F.get_json_object("props", "$.k")
    args = F.create_map(*[x for key in ("pattern", "file_path", "description") for x in (F.lit(key), k)])
    c = sessions.classify_tool(tool, args)
    return t(spark, d, "events").select("event_id", "event_type", c["kind"].alias("kind"), F.coalesce(k, F.lit("")).alias("target"))


@query("SELECT event_id, user_id, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1)::BIGINT AS seq FROM events")
def event_seq(spark, d):
    return sessions.sequence(t(spark, d, "events"), "user_id", ["ts", "event_id"]).select("event_id", "user_id", "seq")


_PAIRS = """SELECT *, CASE WHEN opened > 0 AND nth <= 2 THEN opened END AS pair, opened > 0 AND nth <= 2 AND n >= 2 AS paired FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, opened ORDER BY CASE WHEN role = 'use' THEN 0 ELSE 1 END, ts, event_id) AS nth, count(*) OVER (PARTITION BY user_id, opened) AS n FROM (
  SELECT event_id, user_id, ts, role, sum(CASE WHEN role = 'use' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS opened FROM (
  SELECT *, CASE event_type WHEN 'view' THEN 'use' WHEN 'purchase' THEN 'result' END AS role FROM events) WHERE role IS NOT NULL))"""


def _pairs(spark, d):
    return sessions.pair_results(t(spark, d, "events"), ["user_id"], ["ts", "event_id"], F.col("event_type") == "view", F.col("event_type") == "purchase")


@query(f"SELECT event_id, role, pair, paired FROM ({_PAIRS})")
def tool_pairing(spark, d):
    return _pairs(spark, d).select("event_id", "role", "pair", "paired")


@query(f"SELECT event_id, user_id FROM ({_PAIRS}) WHERE role = 'use' AND NOT paired")
def pending_anti(spark, d):
    return _pairs(spark, d).where("role = 'use' AND NOT paired").select("event_id", "user_id")


@query(f"SELECT event_id, user_id FROM ({_PAIRS}) WHERE role = 'result' AND pair IS NULL")
def orphan_results(spark, d):
    return _pairs(spark, d).where("role = 'result' AND pair IS NULL").select("event_id", "user_id")


@query("""SELECT user_id, string_agg(event_type, ',' ORDER BY first_ts, first_id) AS kinds FROM (
  SELECT user_id, event_type, min(ts) AS first_ts, arg_min(event_id, (ts, event_id)) AS first_id FROM events GROUP BY ALL) GROUP BY user_id""")
def rollup_ordered_distinct(spark, d):
    e = t(spark, d, "events").withColumn("o", F.struct("ts", "event_id"))
    return sessions.first_seen(e, ["user_id"], "event_type", "o", "k").select("user_id", F.array_join("k", ",").alias("kinds"))


@query("""SELECT user_id, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS session_ix, event_id FROM (
  SELECT *, CASE WHEN epoch(ts)::BIGINT - epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))::BIGINT <= 1800 THEN 0 ELSE 1 END AS fresh FROM (SELECT event_id, user_id, date_trunc('second', ts) AS ts FROM events))""")
def session_by_inactivity(spark, d):
    e = t(spark, d, "events").withColumn("ts", F.date_trunc("second", "ts"))
    return sessions.inactive_sessions(e, "user_id", "ts", ["event_id"], 1800).select("user_id", "session_ix", "event_id")


@query(f"""SELECT conv_id, arg_max(last_sha, turn_ix) AS closing_sha FROM (SELECT conv_id, turn_ix, arg_max(sha256(text), turn) AS last_sha FROM ({_TURNS}) WHERE role = 'assistant' AND trim(text) <> '' GROUP BY ALL) AS a
  JOIN (SELECT conv_id, max(turn_ix) AS top FROM ({_TURNS}) GROUP BY conv_id) AS m USING (conv_id) WHERE turn_ix >= top - 1 GROUP BY conv_id""")
def closing_statement(spark, d):
    texts = F.transform(F.array_sort(F.collect_list(F.when(F.col("role") == "assistant", F.struct("turn", "text")))), lambda x: x["text"])
    x = sessions.closing_statement(_turns(spark, d).groupBy("conv_id", "turn_ix").agg(texts.alias("texts")), "conv_id")
    return x.where("closing is not null").select("conv_id", F.sha2("closing", 256).alias("closing_sha"))


@query("""SELECT conv_id, CASE WHEN s0 <= 4000 THEN 0 WHEN s1 <= 4000 THEN 1 WHEN s2 <= 4000 THEN 2 ELSE 3 END AS level FROM (
  SELECT conv_id, sum(length(text)) AS s0, sum(CASE WHEN role = 'system' THEN 0 ELSE length(text) END) AS s1, sum(CASE WHEN role = 'system' THEN 0 ELSE least(length(text), 201) END) AS s2 FROM conversations GROUP BY conv_id)""")
def degradation_ladder(spark, d):
    n, plain = F.length("text"), F.col("role") == "system"
    x = t(spark, d, "conversations").groupBy("conv_id").agg(F.sum(n).alias("s0"), F.sum(F.when(plain, 0).otherwise(n)).alias("s1"), F.sum(F.when(plain, 0).otherwise(F.least(n, F.lit(201)))).alias("s2"))
    return x.select("conv_id", sessions.degradation_level([F.col("s0"), F.col("s1"), F.col("s2"), F.lit(0)], 4000).cast("int").alias("level"))


# --------------------------------------------------------------------------- state

_CUT = "2024-01-16"
_SNAP = "SELECT user_id, max(ts) AS last_ts, count(*) AS size_bytes, arg_max(event_type, (ts, event_id)) AS label FROM events WHERE ts {} TIMESTAMP '2024-01-16' GROUP BY user_id"


def _snapshot(spark, d, before: bool):
    e = t(spark, d, "events")
    e = e.where(F.col("ts") < _CUT) if before else e.where(F.col("ts") >= _CUT)
    return e.groupBy("user_id").agg(F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("size_bytes"), F.max_by("event_type", F.struct("ts", "event_id")).alias("label"))


@query("""SELECT user_id, size_bytes, last_offset, (epoch(top) - epoch(last_ts))::BIGINT AS idle_seconds FROM (
  SELECT user_id, date_trunc('second', max(ts)) AS last_ts, count(*) AS size_bytes, count(*) FILTER (ts < TIMESTAMP '2024-01-16') AS last_offset FROM events GROUP BY user_id), (SELECT date_trunc('second', max(ts)) AS top FROM events)
  WHERE epoch(top) - epoch(last_ts) >= 3600 AND size_bytes > last_offset""")
def readiness_scan(spark, d):
    e = t(spark, d, "events")
    top = e.agg(F.date_trunc("second", F.max("ts")).alias("top"))
    found = e.groupBy(F.col("user_id").alias("path")).agg(F.date_trunc("second", F.max("ts")).alias("last_ts"), F.count(F.lit(1)).alias("size_bytes"))
    found = found.join(F.broadcast(top)).withColumn("idle_seconds", F.unix_timestamp("top") - F.unix_timestamp("last_ts"))  # one row
    known = e.groupBy(F.col("user_id").alias("path")).agg(F.count_if(F.col("ts") < _CUT).alias("last_offset")).withColumn("status", F.lit("complete")).withColumn("attempts", F.lit(0))
    return state.ready(found, known, 3600).select(F.col("path").alias("user_id"), "size_bytes", "last_offset", "idle_seconds")


@query(f"""SELECT coalesce(n.user_id, o.user_id) AS user_id, coalesce(nullif(nullif(n.label, 'view'), ''), nullif(o.label, 'view'), '') AS label, greatest(o.size_bytes, n.size_bytes) AS size_bytes, strftime(coalesce(n.last_ts, o.last_ts), '%Y-%m-%d %H:%M:%S') AS last_ts
  FROM ({_SNAP.format('<')}) AS o FULL JOIN ({_SNAP.format('>=')}) AS n ON o.user_id = n.user_id""")
def state_upsert(spark, d):
    def blank(df):
        return df.withColumn("label", F.when(F.col("label") == "view", "").otherwise(F.col("label")))

    out = state.upsert(blank(_snapshot(spark, d, True)), blank(_snapshot(spark, d, False)), "user_id", ["label"], ["size_bytes"])
    return out.select("user_id", F.coalesce("label", F.lit("")).alias("label"), "size_bytes", F.date_format("last_ts", "yyyy-MM-dd HH:mm:ss").alias("last_ts"))


@query("""SELECT event_id, user_id FROM events AS e WHERE ts >= TIMESTAMP '2024-01-16' AND NOT EXISTS (
  SELECT 1 FROM events AS o WHERE o.ts < TIMESTAMP '2024-01-16' AND o.user_id = e.user_id AND o.event_type = e.event_type AND o.ts >= TIMESTAMP '2024-01-12')""")
def unprocessed_anti(spark, d):
    e = t(spark, d, "events")
    done = e.where((F.col("ts") < _CUT) & (F.col("ts") >= "2024-01-12"))
    return state.unprocessed(e.where(F.col("ts") >= _CUT), done, ["user_id", "event_type"]).select("event_id", "user_id")


@query("SELECT c_custkey, c_nationkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') AND c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 1)")
def orphaned_semi_anti(spark, d):
    c = t(spark, d, "customer").withColumn("path", F.col("c_custkey")).withColumn("session_id", F.col("c_nationkey"))
    files = t(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("path"))
    out = state.orphaned(c, files, t(spark, d, "nation").where("n_regionkey <> 1").select(F.col("n_nationkey").alias("session_id")))
    return out.select("c_custkey", "c_nationkey")


@query("""SELECT user_id, CASE WHEN idle < 86400 THEN 'active' WHEN grown THEN 'complete' ELSE 'summarized' END AS status FROM (SELECT user_id, (SELECT epoch(date_trunc('second', max(ts))) FROM events) - epoch(date_trunc('second', max(ts))) AS idle,
  count(*) > count(*) FILTER (ts < TIMESTAMP '2024-01-16') AS grown FROM events GROUP BY user_id)""")
def status_machine(spark, d):
    e = t(spark, d, "events")
    top = e.agg(F.unix_timestamp(F.max("ts")).alias("top"))
    x = e.groupBy("user_id").agg(F.unix_timestamp(F.max("ts")).alias("last"), (F.count(F.lit(1)) > F.count_if(F.col("ts") < _CUT)).alias("grown")).join(F.broadcast(top))
    return x.select("user_id", state.status_after(F.col("top") - F.col("last"), 86400, F.lit("summarized"), F.col("grown")).alias("status"))


# --------------------------------------------------------------------------- change logs


@query("""SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1 AND o_orderstatus <> 'P'""")
def manifest_last_line_wins(spark, d):
    o = t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    return changelog.last_wins(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], F.col("o_orderstatus") == "P").select("o_custkey", "o_orderkey", "o_orderstatus")


@query("SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY o_custkey")
def first_per_key(spark, d):
    return changelog.first_wins(t(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS n FROM orders GROUP BY ALL HAVING count(*) >= 2")
def multi_block(spark, d):
    return changelog.repeated(t(spark, d, "orders").withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd")), ["o_custkey", "day"])


@query("""SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'missing' WHEN a.o_orderkey IS NULL THEN 'stale' ELSE 'changed' END AS status, CASE WHEN a.o_orderkey IS NOT NULL AND b.o_orderkey IS NOT NULL THEN 'total' ELSE '' END AS fields
  FROM (SELECT l_orderkey AS o_orderkey, floor(sum(l_extendedprice))::BIGINT AS total FROM lineitem WHERE l_linenumber <> 7 GROUP BY 1) AS a FULL JOIN (SELECT o_orderkey, floor(o_totalprice)::BIGINT AS total FROM orders) AS b ON a.o_orderkey = b.o_orderkey
  WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.total IS DISTINCT FROM b.total""")
def manifest_drift(spark, d):
    e = t(spark, d, "lineitem").where("l_linenumber <> 7").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.floor(F.sum("l_extendedprice")).cast("long").alias("total"))
    a = t(spark, d, "orders").select("o_orderkey", F.floor("o_totalprice").cast("long").alias("total"))
    return changelog.drift(e, a, ["o_orderkey"], ["total"])


@query("SELECT a.o_custkey, a.o_orderkey AS left_id, b.o_orderkey AS right_id FROM orders AS a JOIN orders AS b ON a.o_custkey = b.o_custkey AND CAST(b.o_orderdate AS DATE) = CAST(a.o_orderdate AS DATE) + 1")
def adjacent_day(spark, d):
    return changelog.adjacent_days(t(spark, d, "orders").withColumn("day", F.to_date("o_orderdate")), "o_custkey", "day", "o_orderkey")


# --------------------------------------------------------------------------- texts

_SECRET = r"(?i)\b((?:[a-z0-9_]*_)?token\s*=\s*)(\"[^\"\n«]*[0-9a-z][^\"\n]*\")"


@query(f"SELECT doc_id, sha256(regexp_replace(text, '{_SECRET}', '\\1«redacted»', 'g')) AS sha FROM documents")
def redact_documents(spark, d):
    return t(spark, d, "documents").select("doc_id", F.sha2(redaction.redact(F.col("text")), 256).alias("sha"))


@query(f"SELECT lang, count(*) FILTER (n > 0) AS documents, sum(n)::BIGINT AS n_redacted FROM (SELECT lang, len(regexp_extract_all(text, '{_SECRET}')) AS n FROM documents) GROUP BY lang")
def redaction_counts(spark, d):
    x = redaction.with_redaction(t(spark, d, "documents"), "text")
    return x.groupBy("lang").agg(F.count_if(F.col("n_redacted") > 0).alias("documents"), F.sum("n_redacted").alias("n_redacted"))


@query(r"SELECT page_id, sha256(regexp_replace(html, '(?i)\b((?:[a-z0-9_]*_)?token\s*=\s*)([^\s\"'',\]}«]*[0-9a-z][^\s\"'',\]}]*|\"[^\"\n«]*[0-9a-z][^\"\n]*\")', '\1«redacted»', 'g')) AS sha FROM pages")
def redact_pages(spark, d):
    return t(spark, d, "pages").select("page_id", F.sha2(redaction.redact(F.col("html")), 256).alias("sha"))


@query("SELECT doc_id, CASE WHEN length(text) > 400 THEN substr(text, 1, 400) || '…(+' || (length(text) - 400)::VARCHAR || ' chars)' ELSE text END AS digest FROM documents")
def digest_truncate(spark, d):
    return t(spark, d, "documents").select("doc_id", text.elide(F.col("text"), 400).alias("digest"))


@query("""SELECT p_partkey, CASE WHEN p_partkey < 1000000 AND p_partkey % 3 = 0 THEN '#' || p_partkey::VARCHAR ELSE '' END AS tickets, CASE WHEN p_partkey < 1000000 AND p_partkey % 3 = 1 THEN 'lib-x#' || p_partkey::VARCHAR WHEN p_partkey < 1000000 AND p_partkey % 3 = 2 THEN '#' || p_partkey::VARCHAR ELSE '' END AS prs
  FROM (SELECT p_partkey::BIGINT AS p_partkey FROM part WHERE p_partkey > 0)""")
def refs_extract(spark, d):
    p = t(spark, d, "part").where("p_partkey > 0").select(F.col("p_partkey").cast("long").alias("p_partkey"))
    n = F.col("p_partkey").cast("string")
    said = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("see #"), n)).when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("from lib-x#"), n)).otherwise(F.concat(F.lit("merged PR #"), n))
    r = references.tickets_and_prs(said)
    return p.select("p_partkey", F.array_join(r["tickets"], ",").alias("tickets"), F.array_join(r["prs"], ",").alias("prs"))


@query(r"""SELECT page_id, count(u) AS n_urls, count(DISTINCT u) AS n_distinct, sha256(coalesce(string_agg(DISTINCT u, ' ' ORDER BY u), '')) AS urls_sha FROM (
  SELECT page_id, unnest(CASE WHEN len(f) = 0 THEN [NULL] ELSE f END) AS u FROM (SELECT page_id, list_transform(regexp_extract_all(coalesce(html, '') || ' (' || url || ').', 'https?://[^\s''"<>)\]}]+'), lambda x: rtrim(x, '.,);')) AS f FROM pages)) GROUP BY page_id""")
def url_rollup(spark, d):
    u = references.urls(F.concat(F.coalesce("html", F.lit("")), F.lit(" ("), "url", F.lit(").")))
    own = t(spark, d, "pages").select("page_id", u.alias("u"))
    every = F.array_join(F.array_sort(F.array_distinct("u")), " ")
    return own.select("page_id", F.size("u").cast("long").alias("n_urls"), F.size(F.array_distinct("u")).cast("long").alias("n_distinct"), F.sha2(every, 256).alias("urls_sha"))


_LINES = "SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(regexp_replace(trim(x), '^[-*# ]+', ''))), lambda x: length(x) >= 20) AS ls FROM documents"
_THREES = f"SELECT DISTINCT doc_id, md5(array_to_string(list_slice(ls, k, k + 2), chr(10))) AS h FROM ({_LINES}), unnest(range(1, len(ls) - 1)) AS u(k)"


@query(f"SELECT doc_id, count(*) AS shared FROM ({_THREES}) WHERE h IN (SELECT h FROM ({_THREES}) GROUP BY h HAVING count(*) > 1) GROUP BY doc_id")
def line_overlap(spark, d):
    # 128 bits stand for the lines; a partial count keeps the ids of keys that one document holds from the shuffle
    key = F.explode(F.array_distinct(contamination.overlap_keys(F.col("text")))).alias("key")
    keys = t(spark, d, "documents").select("doc_id", key).select("doc_id", F.xxhash64("key").alias("a"), F.xxhash64(F.lit(1), "key").alias("b"))
    often = keys.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return keys.join(often.select("a", "b"), ["a", "b"], "left_semi").groupBy("doc_id").agg(F.count(F.lit(1)).alias("shared"))


_GRAMS = "SELECT DISTINCT {id}, md5(array_to_string(list_slice(w, k, k + 7), ' ')) AS h FROM (SELECT {id}, string_split(lower(text), ' ') AS w FROM {tab}), unnest(range(1, len(w) - 6)) AS u(k)"


def _grams(df: DataFrame, id_: str) -> DataFrame:
    """Distinct (id, a, b): 128 bits for each run of eight words."""
    w = df.select(id_, F.split(F.lower("text"), " ", -1).alias("w")).where(F.size("w") >= 8)
    at = F.sequence(F.lit(1), F.size("w") - 7)
    each = F.transform(at, lambda k: F.struct(F.xxhash64(F.slice("w", k, 8)).alias("a"), F.xxhash64(F.lit(1), F.slice("w", k, 8)).alias("b")))
    return w.select(id_, F.explode(each).alias("h")).select(id_, "h.a", "h.b")


@query(f"SELECT doc_id, count(DISTINCT item_id) AS items FROM ({_GRAMS.format(id='doc_id', tab='documents')}) JOIN ({_GRAMS.format(id='item_id', tab='benchmark')}) USING (h) GROUP BY doc_id")
def ngram_contamination(spark, d):
    # the benchmark's grams are counted before they are broadcast; then no document's grams are shuffled
    items = _grams(t(spark, d, "benchmark"), "item_id").distinct()
    small = items.count() <= 1_000_000  # three numbers a row
    hit = _grams(t(spark, d, "documents"), "doc_id").join(F.broadcast(items) if small else items, ["a", "b"])
    return hit.select("doc_id", "item_id").distinct().groupBy("doc_id").agg(F.count(F.lit(1)).alias("items"))


@query(r"""SELECT page_id, count(*) FILTER (regexp_matches(l, '<[a-zA-Z][a-zA-Z0-9 _./-]{0,40}>')) AS placeholder_lines, count(*) AS lines FROM (SELECT page_id, unnest(string_split(html, chr(10))) AS l FROM pages) GROUP BY page_id""")
def residue_lines(spark, d):
    x = t(spark, d, "pages").select("page_id", F.explode(F.split("html", "\n")).alias("l"))
    return x.groupBy("page_id").agg(F.count_if(F.col("l").rlike(contamination.PLACEHOLDER)).alias("placeholder_lines"), F.count(F.lit(1)).alias("lines"))


_NUMBERED = "SELECT doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents"


@query(f"""WITH l AS MATERIALIZED (SELECT doc_id, pos, md5(l) AS h FROM ({_NUMBERED}) WHERE length(l) >= 20), f AS (SELECT h FROM l GROUP BY h HAVING count(DISTINCT doc_id) > 1),
  x AS (SELECT doc_id, pos, h IN (SELECT h FROM f) AS hit FROM l), g AS (SELECT *, sum(CASE WHEN hit THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS g FROM x)
  SELECT doc_id, min(pos)::BIGINT AS first, max(pos)::BIGINT AS last, count(*) AS n FROM g WHERE hit GROUP BY doc_id, g HAVING count(*) >= 3""")
def echo_islands(spark, d):
    x = t(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "l")).where(F.length("l") >= 20).select("doc_id", F.col("pos").cast("long").alias("pos"), F.md5("l").alias("h"))
    often = x.select("h", "doc_id").distinct().groupBy("h").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("h", F.lit(True).alias("hit"))
    x = x.join(often, "h", "left").withColumn("hit", F.coalesce("hit", F.lit(False)))
    return blocks.islands(x, "doc_id", "pos", F.col("hit"), 3)


_CLASS = "CASE WHEN regexp_full_match(w, '[0-9]+') THEN 'number' WHEN regexp_matches(w, '[^a-zA-Z0-9.,]') THEN 'code' ELSE 'word' END"


@query("""WITH p AS (SELECT p_partkey::BIGINT AS k FROM part WHERE p_partkey > 0 AND p_partkey < 1000000)
  SELECT k AS p_partkey, 'path' AS kind, '/srv/p' || k || '/main.py' AS claim FROM p UNION ALL SELECT k, 'tool', 'Bash' FROM p UNION ALL SELECT k, 'ticket', '#' || k FROM p
  UNION ALL SELECT k, 'command', 'git log -n ' || k FROM p UNION ALL SELECT k, 'code', 'v' || k || '=f(x)' FROM p UNION ALL SELECT k, 'identifier', 'state_' || k FROM p""")
def claims_distinct(spark, d):
    k = F.col("p_partkey").cast("long").cast("string")
    said = F.concat(F.lit("Edited /srv/p"), k, F.lit("/main.py. Ran `git log -n "), k, F.lit("`, `v"), k, F.lit("=f(x)` and `state_"), k, F.lit("` twice: `state_"), k, F.lit("`; `ab` for #"), k, F.lit(" with Bash and Bash"))
    p = t(spark, d, "part").where("p_partkey > 0 AND p_partkey < 1000000")
    x = p.select(F.col("p_partkey").cast("long").alias("p_partkey"), F.explode(grounding.claims(said)).alias("c"))
    return x.select("p_partkey", "c.kind", "c.claim")


@query("""WITH c AS (SELECT conv_id, coalesce(list(lower(text) ORDER BY turn) FILTER (role = 'user'), []) AS terms, coalesce(list(lower(text) ORDER BY turn) FILTER (role <> 'user'), []) AS own FROM conversations GROUP BY conv_id),
  s AS (SELECT conv_id, terms, unnest(list_distinct(flatten(list_transform(own, lambda x: string_split(x, '. '))))) AS s FROM c)
  SELECT conv_id, count(*) AS claims, count(*) FILTER (len(list_filter(terms, lambda x: x <> '' AND (contains(x, s) OR contains(s, x)))) > 0) AS grounded FROM s GROUP BY conv_id""")
def ground_containment(spark, d):
    said = F.collect_list(F.struct("turn", "role", F.lower("text").alias("text")))
    x = t(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(said).alias("x"))
    of = lambda user: F.transform(F.filter("x", lambda s: (s["role"] == "user") == user), lambda s: s["text"])
    x = x.select("conv_id", of(F.lit(True)).alias("terms"), F.explode(F.array_distinct(F.flatten(F.transform(of(F.lit(False)), lambda s: F.split(s, r"\. ", -1))))).alias("s"))
    return x.groupBy("conv_id").agg(F.count(F.lit(1)).alias("claims"), F.count_if(grounding.contained(F.col("s"), F.col("terms"))).alias("grounded"))


@query("""WITH n AS (SELECT *, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS norm FROM conversations),
  g AS (SELECT conv_id, lower(trim(regexp_replace(coalesce(string_agg(text, ' ' ORDER BY turn) FILTER (role = 'assistant'), ''), '\\s+', ' ', 'g'))) AS own FROM conversations GROUP BY conv_id),
  c AS (SELECT conv_id, round_even(count(*) FILTER (norm <> '' AND contains(own, substr(norm, 1, 60))) / count(*), 4) AS coverage FROM n JOIN g USING (conv_id) GROUP BY conv_id)
  SELECT conv_id, coverage, coverage >= 0.1 AS covered FROM c""")
def coverage_floor(spark, d):
    # a conversation's turns are its events, what its assistant says is its digest; the operator looks for the first 60 characters of a target
    x = t(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("x"))
    own = F.array_join(F.transform(F.filter("x", lambda s: s["role"] == "assistant"), lambda s: s["text"]), " ")
    c = grounding.coverage(F.transform("x", lambda s: s["text"]), own)
    return x.select("conv_id", c.alias("coverage")).withColumn("covered", F.col("coverage") >= grounding.COVERAGE_FLOOR)


@query("""WITH s AS (SELECT conv_id, turn, string_split(text, ' en') AS a, string_split(text, 'de ') AS b FROM conversations),
  o AS (SELECT conv_id, turn, 0 AS token, unnest(list_transform(range(1, len(a)), lambda k: len(array_to_string(a[1:k], ' en')))) AS p, 3 AS n FROM s
    UNION ALL SELECT conv_id, turn, 1, unnest(list_transform(range(1, len(b)), lambda k: len(array_to_string(b[1:k], 'de ')))), 3 FROM s),
  w AS (SELECT *, max(CASE WHEN token = 0 THEN p END) OVER v AS x, max(CASE WHEN token = 1 THEN p END) OVER v AS y FROM o WINDOW v AS (PARTITION BY conv_id, turn ORDER BY p, p + n, token ROWS UNBOUNDED PRECEDING))
  SELECT c.conv_id, c.turn, CAST(min(CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN p + n - least(x, y) END) AS BIGINT) AS span FROM conversations AS c LEFT JOIN w ON w.conv_id = c.conv_id AND w.turn = c.turn GROUP BY ALL""")
def cooccurrence_span(spark, d):
    span = grounding.covering_span(F.array(F.lit(" en"), F.lit("de ")), F.col("text"))
    return t(spark, d, "conversations").select("conv_id", "turn", span.cast("long").alias("span"))


@query(r"""WITH l AS (SELECT lang, unnest(string_split(text, chr(10))) AS s FROM documents), w AS (SELECT lang, s, regexp_split_to_array(trim(s), '[ \t\n\f\r]+') AS w FROM l WHERE s <> '')
  SELECT lang, CASE WHEN contains(s, '|') OR contains(s, '&&') OR contains(s, '>') OR contains(s, '<') OR contains(s, ';') OR contains(s, '$(') OR list_contains(['""" + "', '".join(grounding.BINARIES) + r"""'], w[1])
    OR (coalesce(starts_with(w[2], '-'), false) AND regexp_full_match(w[1], '[A-Za-z_][0-9A-Za-z_.-]*')) THEN 'command' WHEN regexp_matches(s, '[()\[\]{}=]') THEN 'code' ELSE 'identifier' END AS kind, count(*) AS n FROM w GROUP BY ALL""")
def span_classes(spark, d):
    x = t(spark, d, "documents").select("lang", F.explode(F.split("text", "\n")).alias("s")).where("s <> ''")
    return x.groupBy("lang", grounding.classify_span(F.col("s")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


# --------------------------------------------------------------------------- trends

_WEEK = """SELECT {}, count(*) AS graded, count(*) FILTER (event_type <> 'error') AS passed, round_even(count(*) FILTER (event_type <> 'error') / count(*), 4) AS rate, round_even(avg(value), 4) AS mean_value FROM events WHERE ts < TIMESTAMP '2024-01-29' GROUP BY ALL"""
_INDEX = "floor((epoch(TIMESTAMP '2024-01-29')::BIGINT - epoch(date_trunc('second', ts))::BIGINT - 1) / 604800)::BIGINT AS window_ix"


def _run_records(spark, d):
    e = t(spark, d, "events").where("ts < '2024-01-29'")
    return e.withColumn("passed", F.col("event_type") != "error").withColumn("window_ix", trend.window_index(F.date_trunc("second", "ts"), "2024-01-29", 7))


@query(_WEEK.format(_INDEX))
def qc_window_stats(spark, d):
    return _run_records(spark, d).groupBy("window_ix").agg(*trend.pass_stats(F.col("passed"), F.col("value")))


@query(_WEEK.format("user_id % 7 AS bucket, nullif(event_type, 'view') AS model"))
def qc_group_stats(spark, d):
    x = _run_records(spark, d).withColumn("bucket", F.col("user_id") % 7).withColumn("model", F.nullif("event_type", F.lit("view")))
    return x.groupBy("bucket", "model").agg(*trend.pass_stats(F.col("passed"), F.col("value")))


@query(f"""WITH w AS ({_WEEK.format(_INDEX)}) SELECT a.window_ix, CASE WHEN a.graded < 20 THEN 3 WHEN a.rate < 0.75 THEN 1 WHEN b.graded >= 20 AND round_even(b.rate - a.rate, 4) > 0.01 THEN 1 WHEN b.graded IS NULL OR b.graded < 20 THEN 3 ELSE 0 END AS code
  FROM w AS a LEFT JOIN w AS b ON b.window_ix = a.window_ix + 1""")
def threshold_verdict(spark, d):
    w = qc_window_stats(spark, d)
    p = w.select((F.col("window_ix") - 1).alias("window_ix"), F.col("graded").alias("pg"), F.col("rate").alias("pr"))
    x = w.join(p, "window_ix", "left")
    return x.select("window_ix", trend.verdict(F.col("graded"), F.col("rate"), F.col("pg"), F.col("pr"), 20, 0.75, 0.01).alias("code"))


@query("SELECT lang, source, count(*) AS n, (2 * GROUPING(lang) + GROUPING(source))::BIGINT AS grain FROM documents JOIN labels USING (doc_id) GROUP BY ROLLUP (lang, source)")
def qc_by_bucket_rollup(spark, d):
    return survey.grains(t(spark, d, "documents").join(t(spark, d, "labels"), "doc_id"), "lang", "source")


@query("SELECT event_type, quantile_disc(value, 0.95) AS p95, quantile_disc(value, 0.5) AS p50 FROM events GROUP BY event_type")
def percentile_nearest_rank(spark, d):
    return trend.order_statistics(t(spark, d, "events"), ["event_type"], "value", {"p95": trend.nearest_rank(0.95), "p50": trend.nearest_rank(0.5)})


@query("SELECT l_returnflag, trunc(quantile_cont(l_extendedprice, 0.9))::BIGINT AS p90 FROM lineitem GROUP BY l_returnflag")
def percentile_interp(spark, d):
    return trend.interpolated(t(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice", 0.9, "p90")


@query("SELECT o_custkey, list_extract(list_sort(list(o_totalprice)), (count(*) // 2 + 1)::BIGINT) AS median FROM orders GROUP BY o_custkey")
def upper_median(spark, d):
    return trend.order_statistics(t(spark, d, "orders"), ["o_custkey"], "o_totalprice", {"median": trend.upper_median_rank()})


@query("SELECT l_orderkey, least(greatest(ceil(count(*) * 1.5)::BIGINT, 4), 40)::BIGINT AS cap FROM lineitem GROUP BY l_orderkey")
def cap_derivation(spark, d):
    return t(spark, d, "lineitem").groupBy("l_orderkey").agg(text.derived_cap(F.count(F.lit(1)), 1.5, 4).alias("cap"))


@query("""SELECT field, count(*) AS n, max(v) AS max, trunc(quantile_cont(v, 0.99))::BIGINT AS p99, trunc(quantile_cont(v, 0.5))::BIGINT AS median, count(*) FILTER (v > 3) AS over FROM (
  UNPIVOT (SELECT count(*)::DOUBLE AS lines, count(DISTINCT l_suppkey)::DOUBLE AS suppliers, count(DISTINCT l_partkey)::DOUBLE AS parts FROM lineitem GROUP BY l_orderkey) ON lines, suppliers, parts INTO NAME field VALUE v) GROUP BY field""")
def denominator_shares(spark, d):
    x = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"), F.countDistinct("l_suppkey").alias("suppliers"), F.countDistinct("l_partkey").alias("parts"))
    return survey.field_survey(x, ["lines", "suppliers", "parts"], 3)


@query("SELECT coalesce(nullif(event_type, 'view'), 'unrecorded') AS category, count(*) AS n FROM events GROUP BY 1")
def counter_by_default_bucket(spark, d):
    return t(spark, d, "events").groupBy(trend.category(F.nullif("event_type", F.lit("view"))).alias("category")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_type AS key, sum(json_extract_string(props, '$.k')::BIGINT)::BIGINT AS total FROM events GROUP BY 1")
def map_merge_sorted(spark, d):
    m = F.create_map("event_type", F.coalesce(F.get_json_object("props", "$.k").try_cast("long"), F.lit(0)))
    return trend.merge_maps(t(spark, d, "events").select(m.alias("m")), "m")


@query("""SELECT lang, count(quality) AS graded, count(*) FILTER (quality = 1) AS passed, CASE WHEN count(quality) > 0 THEN round_even(count(*) FILTER (quality = 1) / count(quality), 4) END AS rate, count(*) FILTER (quality IS NULL) AS missing
  FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang""")
def labels_pass_rate(spark, d):
    x = t(spark, d, "documents").select("doc_id", "lang").join(t(spark, d, "labels"), "doc_id", "left")
    g, p = F.count("quality"), F.count_if(F.col("quality") == 1)
    return x.groupBy("lang").agg(g.alias("graded"), p.alias("passed"), text.ratio(p, g).alias("rate"), F.count_if(F.col("quality").isNull()).alias("missing"))


@query("""SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY sha256(doc_id::VARCHAR || '|' || source || '|probe'), doc_id) AS n FROM documents) WHERE n <= 40""")
def sampled_controls(spark, d):
    return survey.sampled(t(spark, d, "documents").select("source", "doc_id"), "source", "doc_id", "probe", 40)


@query("SELECT doc_id, quality IS NOT NULL AS has_log FROM documents LEFT JOIN labels USING (doc_id)")
def quality_join_left(spark, d):
    return survey.with_logs(t(spark, d, "documents"), t(spark, d, "labels"), "doc_id").select("doc_id", "has_log")


@query("""SELECT conv_id, turn FROM (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS n FROM (SELECT *, max(role <> 'user') OVER (PARTITION BY conv_id, s) AS b FROM (
  SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS s FROM conversations)) WHERE b) WHERE n <= 3""")
def preview_lines(spark, d):
    c = t(spark, d, "conversations").withColumn("line", F.when(F.col("role") == "user", "## x").otherwise("- x"))
    return blocks.preview(c, "conv_id", "turn", "line", 3).select("conv_id", "turn")


@query("""SELECT conv_id, turn, sha256('- ' || trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS line_sha FROM conversations""")
def bullets(spark, d):
    return t(spark, d, "conversations").select("conv_id", "turn", F.sha2(text.bullet(F.col("text")), 256).alias("line_sha"))


@query("""SELECT o_orderkey, CASE WHEN regexp_full_match(o_clerk, '[A-Za-z0-9][A-Za-z0-9_-]{0,127}') THEN o_clerk ELSE 'unidentified-' || substr(sha256(o_orderkey::VARCHAR), 1, 16) END AS stem FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE replace(replace(o_orderpriority, ' ', ''), '.', '') END AS o_clerk FROM orders)""")
def safe_stems(spark, d):
    name = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority")).otherwise(F.translate("o_orderpriority", " .", ""))
    return t(spark, d, "orders").select("o_orderkey", text.safe_stem(name, F.col("o_orderkey").cast("string")).alias("stem"))


@query("""WITH a AS (SELECT conv_id, list(text ORDER BY turn) FILTER (role = 'assistant') AS x FROM conversations GROUP BY conv_id)
  SELECT conv_id, least(coalesce(len(x), 0), 2)::BIGINT AS done, greatest(coalesce(len(x), 0) - 2, 0)::BIGINT AS truncated, sha256(array_to_string(coalesce(x, [])[1:2], chr(10))) AS kept_sha FROM a""")
def digest_caps(spark, d):
    own = F.transform(F.array_sort(F.collect_list(F.when(F.col("role") == "assistant", F.struct("turn", "text")))), lambda s: s["text"])
    x = t(spark, d, "conversations").groupBy("conv_id").agg(own.alias("items")).withColumn("c", digest.apply_cap(F.col("items"), F.lit(2), bounded=False))
    return x.select("conv_id", F.size("c.items").cast("long").alias("done"), F.col("c.truncated").cast("long").alias("truncated"), F.sha2(F.array_join("c.items", "\n"), 256).alias("kept_sha"))


@query("SELECT p_partkey, count(*) AS n, p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R') AS returned FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY p_partkey")
def current_blocks(spark, d):
    li = t(spark, d, "lineitem").select(F.col("l_partkey").alias("session_id"), F.when(F.col("l_returnflag") == "R", "").otherwise("pending").alias("provisional"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("block_ord"))
    now = changelog.current_block(li).select("session_id", (F.col("provisional") == "").alias("returned"))
    n = li.groupBy("session_id").agg(F.count(F.lit(1)).alias("n"))
    part = t(spark, d, "part").select(F.col("p_partkey").alias("session_id"))
    return n.join(now, "session_id").join(part, "session_id", "left_semi").select(F.col("session_id").alias("p_partkey"), "n", "returned")


@query("""SELECT count(*) AS sessions, count(*) FILTER (event_type = 'error') AS failed, count(*) FILTER (event_type = 'signup') AS fresh, sum(user_id)::BIGINT AS user_id, count(*) AS graded, count(*) FILTER (event_type <> 'error') AS passed,
  round_even(count(*) FILTER (event_type <> 'error') / count(*), 4) AS rate, round_even(avg(value), 4) AS mean_value FROM events""")
def sweep_totals(spark, d):
    e = t(spark, d, "events").withColumn("failed", F.col("event_type") == "error").withColumn("fresh", F.col("event_type") == "signup").withColumn("ok", ~F.col("failed"))
    return trend.sweep_totals(e, ["failed", "fresh"], ["user_id"], "ok", "value")


@query("""SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS n_orders, coalesce((SELECT max(o_orderkey) FROM orders WHERE o_custkey = c_custkey), -1) AS last_order,
  (SELECT count(*) FROM nation WHERE n_nationkey = c_nationkey) AS n_nations FROM customer""")
def session_document(spark, d):
    c = t(spark, d, "customer").select("c_custkey", "c_nationkey")
    parts = {"orders": t(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey"), "nations": c.join(t(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_nationkey")}
    x = sessions.session_document(c, "c_custkey", parts)
    last = F.coalesce(F.try_element_at("orders", F.lit(-1))["o_orderkey"], F.lit(-1))
    return x.select("c_custkey", F.size("orders").cast("long").alias("n_orders"), last.cast("long").alias("last_order"), F.size("nations").cast("long").alias("n_nations"))


@query(r"""WITH s AS (SELECT text, '"' || unnest(string_split(text, ' ')) || ').' AS span FROM conversations), b AS (SELECT text, regexp_replace(span, '^[[:punct:] \t\n\f\r]+|[[:punct:] \t\n\f\r]+$', '', 'g') AS bare FROM s)
  SELECT least, count(*) AS spans, count(*) FILTER (length(bare) >= least AND bare <> '' AND contains(text, bare)) AS grounded FROM b, (SELECT unnest([0, 3, 4, 5, 6, 8, 10, 12]) AS least) GROUP BY least""")
def span_trim_probe(spark, d):
    x = t(spark, d, "conversations").select(F.explode(F.split("text", " ", -1)).alias("w"), F.col("text").alias("corpus"))
    return survey.trim_probe(x.select(F.concat(F.lit('"'), "w", F.lit(").")).alias("span"), "corpus"))


@query("SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events")
def stream_dedup(spark, d):
    """Events through a stream that keeps each id once, and its table read again."""
    import uuid

    from loomlog.plans.folders import shared_folder
    from loomlog.streaming.sessions import append_new

    e = t(spark, d, "events")
    root = f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"
    e.unionByName(e.where("event_type = 'view'")).write.parquet(f"{root}/in")
    append_new(spark.readStream.schema(e.schema).parquet(f"{root}/in"), "event_id", f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out").select("event_id", "user_id", "event_type", "value", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))