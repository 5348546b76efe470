import json
import math
import random

from pyspark.sql import functions as F

from loomlog.operators import blocks, changelog, digest, sessions, state, survey, trend
from loomlog.sources import transcripts
from loomlog.streaming import sessions as streams


def test_jsonl_scan(spark, tmp_path):
    (tmp_path / "a.jsonl").write_bytes(b'{"type":"user"}\r\n\n[1]\nnot json\n{"type":"assistant","n":1}\n\xff\n')
    rows = transcripts.records(spark, str(tmp_path / "*.jsonl")).orderBy("line_no").collect()
    assert [r.line_no for r in rows] == [1, 4, 5, 6, 7][: len(rows)] or [r.line_no for r in rows] == [1, 3, 4, 5, 6]
    assert [r.parsed for r in rows] == [True, False, False, True, False]
    found = transcripts.files(spark, str(tmp_path), exclude=("subagents",)).collect()
    assert len(found) == 1 and found[0].idle_seconds >= 0


def test_manifest_reasons(spark, tmp_path):
    good = dict.fromkeys(transcripts.MANIFEST, "v")
    (tmp_path / "index.jsonl").write_text("\n".join([json.dumps(good), "{", "[]", json.dumps(good | {"sha256": 1})]))
    got = [r.reason for r in transcripts.manifest(spark, str(tmp_path / "index.jsonl")).orderBy("line_no").collect()]
    assert got == [None, "not JSON", "not an object", "missing or not text: sha256"]


def test_ledgers_and_fallback(spark, tmp_path):
    out = str(tmp_path / "runs")
    transcripts.append(spark.createDataFrame([(1, "a")], "n int, s string"), out)
    transcripts.append(spark.createDataFrame([(2, "b")], "n int, s string"), out)
    good, size = transcripts.run_records(spark, out, "n int, s string")
    assert good.count() == 2 and size.first().bad_lines == 0
    fresh, logs = (spark.createDataFrame(x, "session_id string, v int") for x in ([("a", 1)], [("a", 0), ("b", 2)]))
    assert {(r.session_id, r.replayed) for r in transcripts.with_fallback(fresh, logs).collect()} == {("a", False), ("b", True)}


def test_turns_and_pairs(spark):
    rows = [(1, 0, "assistant"), (1, 1, "user"), (1, 2, "assistant"), (1, 3, "user")]
    df = spark.createDataFrame(rows, "s int, line int, role string")
    assert [r.turn_ix for r in sessions.segment_turns(df, "s", ["line"], F.col("role") == "user").orderBy("line").collect()] == [0, 0, 0, 1]
    rows = [(1, "r"), (2, "u"), (3, "u"), (4, "r"), (5, "r")]  # early result, use that another use replaces, second result
    df = spark.createDataFrame(rows, "line int, kind string").withColumn("id", F.lit("x"))
    got = {r.line: (r.pair, r.paired) for r in sessions.pair_results(df, ["id"], ["line"], F.col("kind") == "u", F.col("kind") == "r").collect()}
    assert got == {1: (None, False), 2: (1, False), 3: (2, True), 4: (2, True), 5: (None, False)}


def test_tools_and_arguments(spark):
    rows = [("Read", {"file_path": "/a"}), ("mcp__git__push", {"name": "n", "repo": "r"}), ("Odd", {"x": "y"})]
    got = [tuple(r.c) for r in spark.createDataFrame(rows, "tool string, args map<string,string>").select(sessions.classify_tool(F.col("tool"), F.col("args")).alias("c")).collect()]
    assert got == [("file_read", "/a"), ("mcp", "r"), ("other", "")]
    x = spark.createDataFrame([('{"b":1,"path":"p","a":{"k":[1]},"e":""}',)], "raw string")
    assert x.select(sessions.args_summary(F.col("raw"), F.lit("path"))).first()[0] == 'b=1 a={"k":[1]}'
    assert x.select(sessions.result_text(F.lit("t"), F.lit("o"), F.lit(""))).first()[0] == "t\n[stdout] o"


def test_rollup_is_in_first_seen_order(spark):
    df = spark.createDataFrame([("s", 3, "b"), ("s", 1, "b"), ("s", 2, "a"), ("s", 0, "")], "s string, o int, v string")
    assert sessions.first_seen(df, ["s"], "v", "o", "r").first().r == ["b", "a"]


def test_subagents(spark):
    calls = spark.createDataFrame([("t1",), ("t2",)], "tool_use_id string")
    results = spark.createDataFrame([("t1", "a1", "ok")], "tool_use_id string, agent_id string, status string")
    notices = spark.createDataFrame([("t1", 5, "done"), ("t1", 9, ""), ("t2", 1, "failed")], "tool_use_id string, line_no int, status string")
    assert {(r.tool_use_id, r.agent_id, r.status) for r in sessions.subagents(calls, results, notices).collect()} == {("t1", "a1", "done"), ("t2", None, "failed")}


def test_state(spark):
    s = spark.createDataFrame([("/p/a.jsonl", "", "summarized", 10, 1), ("/p/b.jsonl", "b", "provisional", 5, 2)], "path string, session_id string, status string, last_offset long, attempts int")
    assert [r.session_id for r in state.migrated(s).orderBy("path").collect()] == ["a", "b"]
    found = spark.createDataFrame([("/p/a.jsonl", 10, 9999), ("/p/b.jsonl", 5, 9999), ("/p/c.jsonl", 1, 5)], "path string, size_bytes long, idle_seconds long")
    assert [r.path for r in state.ready(found, s, 900).collect()] == ["/p/b.jsonl"]
    up = {r.path: r for r in state.upsert(s, s.where("path like '%a%'").withColumn("last_offset", F.lit(3).cast("long")), "path", ["session_id"], ["last_offset"]).collect()}
    assert up["/p/a.jsonl"].last_offset == 10 and len(up) == 2
    hit = F.col("session_id") == "b"
    p = {r.path: r for r in state.as_provisional(s, hit, F.lit(99)).collect()}["/p/b.jsonl"]
    assert (p.last_offset, p.attempts, p.status) == (99, 3, "provisional")
    done = spark.createDataFrame([("u1", "/p/b.jsonl"), ("u2", "/p/a.jsonl")], "turn_uuid string, transcript_path string")
    fresh, left = state.reset(s, done, hit)
    assert left.count() == 1 and {r.path: (r.last_offset, r.status) for r in fresh.collect()}["/p/b.jsonl"] == (0, "complete")
    assert state.forget(s, done, hit)[0].count() == 1
    turns = spark.createDataFrame([("u1",), ("u3",), ("u3",)], "turn_uuid string")
    assert [r.turn_uuid for r in state.insert_new(done, turns).collect()] == ["u3"]
    assert state.breaker(["ok", "deferred", "ok", "deferred", "skipped", "deferred", "ok"]) == ["ok", "ok", "ok", "deferred", "skipped", "deferred", "not_attempted"]
    assert state.breaker(["deferred", "skipped"]) == ["deferred", "skipped"] and state.breaker(["ok", "deferred", "skipped"]) == ["ok", "ok", "skipped"]
    outcomes = spark.createDataFrame([("/p/a.jsonl", "deferred", 99), ("/p/b.jsonl", "pending", 50)], "path string, outcome string, offset long")
    got = {r.path: (r.status, r.last_offset, r.attempts) for r in state.apply_outcomes(s, outcomes).collect()}
    assert got == {"/p/a.jsonl": ("summarized", 10, 1), "/p/b.jsonl": ("summarized", 50, 0)}
    assert {r.status for r in state.count_attempt(state.set_status(s, hit, "failed"), hit).where("attempts = 3").collect()} == {"failed"}
    assert [r.path for r in state.swept(found.limit(2), found.where("path like '%c%'"), 3).collect()] == ["/p/a.jsonl", "/p/b.jsonl", "/p/c.jsonl"]


def test_change_log(spark):
    df = spark.createDataFrame([("k", 1, "a", False), ("k", 2, "b", False), ("m", 3, "c", False), ("m", 4, None, True)], "key string, line int, v string, dead boolean")
    assert [(r.key, r.v) for r in changelog.last_wins(df, ["key"], ["line"], F.col("dead")).collect()] == [("k", "b")]
    e, a = (spark.createDataFrame(x, "k int, v string, w int") for x in ([(1, "a", 1), (2, "b", 1), (3, None, 1)], [(2, "x", 2), (3, None, 1), (4, "d", 1)]))
    assert {(r.k, r.status, r.fields) for r in changelog.drift(e, a, ["k"], ["v", "w"]).collect()} == {(1, "missing", ""), (2, "changed", "v,w"), (4, "stale", "")}
    edges, roots = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y")], "name string, needs string"), spark.createDataFrame([("a",)], "name string")
    assert {r.name for r in changelog.closure(edges, roots).collect()} == {"a", "b", "c"}
    assert {r.name for r in changelog.closure(edges.union(spark.createDataFrame([("c", "a"), ("b", "b"), ("c", None)], edges.schema)), roots).collect()} == {"a", "b", "c"}


BODY = "<!-- block session=s1 turn=u1 transcript=/t -->\nfirst\n<!-- /block turn=u1 -->\n<!-- block session=s2 turn=u2 transcript=/t provisional=pending -->\ntorn\n<!-- block session=s3 turn=u3 transcript=/t -->\nsays <!-- /block turn=u9 -->\n<!-- /block turn=u3 -->"


def test_blocks(spark):
    files = spark.createDataFrame([("f", BODY)], "file string, text string")
    got = blocks.blocks(files)
    assert [(r.session_id, r.turn_uuid, r.body) for r in got.orderBy("block_ord").collect()] == [("s1", "u1", "first"), ("s3", "u3", "says <!-- /block turn=u9 -->")]
    assert blocks.torn(files, got).first().torn == 1
    again = spark.range(1).select(blocks.compose(F.lit("s"), F.lit("u"), F.lit("/t"), F.lit("pending"), F.lit("b")).alias("text"), F.lit("f").alias("file"))
    assert blocks.blocks(again).first().provisional == "pending"
    head = spark.range(1).select(blocks.frontmatter(F.array(F.lit("a"), F.lit("a"), F.lit("b"))).alias("h")).first().h
    assert head == "---\nsessions: [a, b]\n---\n"
    assert spark.range(1).select(blocks.strip_frontmatter(F.lit(head + "x"))).first()[0] == "x"
    lines = spark.createDataFrame([("d", k, x) for k, x in enumerate(["- early", "## none", "text", "## some", "### sub", "- b1", "- b2"])], "doc string, pos int, line string")
    assert [r.line for r in blocks.preview(lines, "doc", "pos", "line", 4).orderBy("pos").collect()] == ["## some", "### sub", "- b1", "- b2"]
    old = spark.createDataFrame([("f", 0, "s1", ""), ("f", 3, "s1", "pending"), ("f", 1, "s2", "")], "file string, block_ord int, session_id string, provisional string")
    new = spark.createDataFrame([("f", "s1", ""), ("f", "s2", "pending")], "file string, session_id string, provisional string")
    assert {(r.session_id, r.block_ord, r.provisional) for r in changelog.supersede(old, new.select("file", "session_id", "provisional")).collect()} == {("s1", 0, ""), ("s2", 1, "")}


def test_digests(spark):
    raw = '```json\n{"asked": " q ", "done": ["a", " "], "found": "one", "tickets": [1, true]}\n```'
    d = spark.createDataFrame([(raw,), ("{",), ('{"asked":"q"}',)], "raw string").select(digest.parse(F.col("raw")).alias("d"))
    a, b, c = [r.d for r in d.collect()]
    assert (a.asked, a.done, a.found, a.tickets, a.error) == ("q", ["a"], ["one"], ["1", "true"], None) and b.error == "not JSON" and c.error == "done is empty"
    assert d.limit(1).select(digest.render(F.col("d"))).first()[0].startswith("**Asked:** q\n\n**Done**\n- a")
    assert digest.summarised(spark.createDataFrame([("t",)], "text string"), lambda xs: [x + "!" for x in xs]).first().reply == "t!"
    choice = spark.range(1).select(digest.choose(F.lit(False), F.lit("Done with all of it."), F.lit("")), digest.choose(F.lit(True), F.lit("x"), F.lit("")), digest.choose(F.lit(False), F.lit("wrote N docs"), F.lit(""))).first()
    assert tuple(choice) == ("verbatim", "pending", "fallback")


def test_trend(spark):
    w = spark.range(1).select(
        *[trend.verdict(*map(F.lit, x), 20, 0.8, 0.05).alias(f"c{k}") for k, x in enumerate([(5, 1.0, 30, 1.0), (30, 0.7, 30, 0.7), (30, 0.85, 30, 0.95), (30, 0.9, 3, 0.9), (30, 0.9, 30, 0.9)])]
    ).first()
    assert tuple(w) == (3, 1, 1, 3, 0)
    m = spark.range(1).select(F.create_map(F.lit("path"), F.create_map(F.lit("absent"), F.lit(2)), F.lit("tool"), F.create_map(F.lit("other"), F.lit(9))).alias("m"))
    assert m.select(trend.absent_count(F.col("m"))).first()[0] == 2
    probe = survey.foreign_probe(
        spark.createDataFrame([("a", "x1"), ("b", "x2")], "session_id string, claim string"), spark.createDataFrame([("a", "x2"), ("b", "q")], "session_id string, corpus string"), 40, "s", lambda c, t: F.contains(t, c)
    )
    assert probe.columns == ["session_id", "asked", "grounded"]


def test_order_statistics_equal_sorting(spark):
    rng = random.Random(5)
    rows = [(g, rng.choice([rng.random(), rng.randrange(5), None])) for g in ("a", "b", None) for _ in range(400)] + [("c", 1.0), ("d", None)]
    df = spark.createDataFrame([(g, v if v is None else float(v)) for g, v in rows], "g string, v double")
    got = {r.g: (r.p95, r.mid) for r in trend.order_statistics(df, ["g"], "v", {"p95": trend.nearest_rank(0.95), "mid": trend.upper_median_rank()}, cuts=8).collect()}
    for g in ("a", "b", None, "c"):
        own = sorted(v for x, v in rows if x == g and v is not None)
        assert got[g] == (own[math.ceil(0.95 * len(own)) - 1], own[len(own) // 2])
    assert "d" not in got
    whole = spark.createDataFrame([("a", 10.0 * k) for k in range(1, 8)], "g string, v double")
    assert trend.interpolated(whole, ["g"], "v", 0.9, "p90").first().p90 == 64


def test_tables_are_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (3, 5):
        transcripts.overwrite(spark.range(n), path)
        assert spark.read.parquet(path).count() == n
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    again = transcripts.backup(spark, path, str(tmp_path / "b")), transcripts.backup(spark, path, str(tmp_path / "b"))
    assert again[0] != again[1] and spark.read.parquet(again[0]).count() == 5
    one = spark.createDataFrame([('{"a":["b"]}', "/r/x/../y", None), ("plain", "/r/../etc", "denied")], "text string, path string, error string")
    got = one.select(transcripts.flattened_digest(F.col("text")).alias("f"), transcripts.contained(F.col("path"), "/r").alias("c"), transcripts.presence(F.lit(False), F.col("error")).alias("p")).collect()
    assert [(r.f, r.c, r.p) for r in got] == [("a\nb", True, "absent"), ("plain", False, "unreadable")]
    heads = spark.createDataFrame([("m", "Metadata-Version: 2.1\nName: A_b\nVersion: 1.0\n\nName: other"), ("n", "Name: x\n")], "path string, text string")
    assert [tuple(r) for r in transcripts.package_headers(heads).collect()] == [("m", "a-b", "1.0")]


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame([("a", 5), ("a", 9), ("b", 1)], "path string, size long")
    rows.write.parquet(str(tmp_path / "in"))
    out = streams.progress(streams.follow(spark, str(tmp_path / "in"), "path string, size long"), "path", "size")
    q = out.writeStream.format("memory").queryName("progress").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination()
    assert {(r.path, r.last_offset) for r in spark.table("progress").collect()} == {("a", 9), ("b", 1)}
