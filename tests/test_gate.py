import json

import pytest
from pyspark.sql import functions as F

from loomlog import config
from loomlog.functions import grounding, render
from loomlog.operators import digest, gate, merge, provider, recovery, report

SCHEMA = "session_id string, digest string, corpus string, terms struct<paths:array<string>,commands:array<string>,tools:array<string>,tickets:array<string>>, events array<struct<tool:string,target:string>>"
CORPUS = "read /srv/app/main.py then ran git log -n 3 and id 417 then id 608 about #525 and systemctl status nginx restart"
GOOD = "Edited /srv/app/main.py with `git log -n 3` for #525 using Bash"
BAD = "Edited /etc/other.conf for #417 and #608 (id 525) with `rm -rf thing` by Grep"


@pytest.fixture(scope="module")
def sessions(spark):
    terms = (["/srv/app/main.py"], ["git log -n 3"], ["bash"], ["#525"])
    events = [("Bash", "git log -n 3"), ("Read", "/srv/app/main.py"), ("Read", None)]
    rows = [("a", GOOD, CORPUS, terms, events), ("b", BAD, CORPUS, terms, events), ("c", "  ", CORPUS, terms, events), ("d", "nothing of it", CORPUS, terms, events), ("e", "x", CORPUS, terms, [])]
    return spark.createDataFrame(rows, SCHEMA)


def test_findings_and_verdicts(sessions):
    found = gate.findings(sessions).cache()
    got = {(r.session_id, r.check, r.claim): (r.id_conflation, r.swap_identifier) for r in found.collect()}
    assert got == {
        ("b", "groundedness", "/etc/other.conf"): (False, None), ("b", "groundedness", "#417"): (True, None), ("b", "groundedness", "#608"): (True, "525"), ("b", "groundedness", "rm -rf thing"): (False, None),
        ("b", "groundedness", "Grep"): (False, None), ("b", "event_coverage", None): (False, None), ("c", "coverage", None): (False, None), ("d", "event_coverage", None): (False, None),
    }
    assert {r.session_id: (r.ok, r.n_findings) for r in gate.verdicts(sessions, found).collect()} == {"a": (True, 0), "b": (False, 6), "c": (False, 1), "d": (False, 1), "e": (True, 0)}
    buckets = gate.attributed(found, sessions)
    assert {(r.kind, r.bucket, r.claim) for r in buckets.collect()} == {
        ("path", "absent", "/etc/other.conf"), ("ticket", "id-conflation", "#417"), ("ticket", "id-conflation", "#608"), ("command", "absent", "rm -rf thing"), ("tool", "absent", "Grep"),
    }
    fixed = gate.corrections(sessions, found).first()
    assert fixed.rewritten == "Edited /etc/other.conf for id 417 and #525 (id 608) with `rm -rf thing` by Grep"
    assert [tuple(e) for e in fixed.edits] == [(1, "#417", "id 417"), (1, "#608 (id 525)", "#525 (id 608)")]
    record = {r.session_id: r for r in gate.record_fields(found, buckets).collect()}
    assert record["b"].findings_by_check == {"groundedness": 5, "event_coverage": 1} and record["b"].findings_by_kind["ticket"] == 2 and len(record["b"].claims) == 5
    assert [r.claim for r in gate.rejected(found, "path").collect()] == ["/etc/other.conf"]
    totals = {(r.kind, r.bucket): (r.n, r.sessions) for r in gate.survey(sessions).collect()}
    assert totals[None, None] == (5, 1) and totals["ticket", "id-conflation"] == (2, 1)
    assert gate.disagreements(sessions, "literal").count() == 0
    assert [tuple(r) for r in merge.ledger(gate.corrections(sessions, found), "correct", "ids").collect()][0] == ("b", 1, "#417", "id 417", "correct", "ids")
    with pytest.raises(ValueError):
        merge.ledger(gate.corrections(sessions, found), "nobody", "ids")


def test_terms_and_freshness(spark):
    events = "array<struct<tool:string,kind:string,target:string>>"
    x = spark.createDataFrame([(["A"], None, ["Git  Log"], ["#1"], ["R#2"], [("Read", "file_read", "/B"), ("Bash", "bash", "x")])], f"r array<string>, w array<string>, c array<string>, t array<string>, p array<string>, e {events}")
    got = x.select(grounding.grounding_terms(*[F.col(k) for k in "rwctpe"]).alias("t")).first().t
    assert (got.paths, got.commands, got.tools, got.tickets) == (["a", "/b"], ["git log"], ["read", "bash"], ["#1", "r#2"])
    d = spark.createDataFrame([("a", 5), ("b", 1), ("d", None)], "session_id string, mtime long")
    t = spark.createDataFrame([("a", 4), ("b", 2), ("c", 1), ("d", 1)], "session_id string, mtime long")
    assert {(r.session_id, r.detail) for r in gate.freshness(d, t).collect()} == {("b", "digest is older than its transcript"), ("c", "no digest"), ("d", "cannot compare timestamps")}


def test_recovery(spark):
    blocks = spark.createDataFrame([("t1", "u1", "s1", digest.PLACEHOLDER), ("t1", "u2", "s1", "real"), ("t2", "u3", "s2", digest.SUPPRESSED), ("t3", "u4", "s3", digest.PLACEHOLDER), ("t4", "u5", "s4", digest.PLACEHOLDER)], "transcript_path string, turn_uuid string, session_id string, body string")
    done = spark.createDataFrame([("u1",), ("u3",)], "turn_uuid string")
    state = spark.createDataFrame([("t1",), ("t2",), ("t4",)], "path string")
    logs = spark.createDataFrame([("s1", True), ("s2", True), ("s4", False)], "session_id string, parsed boolean")
    planned = recovery.plan(blocks, done, state, logs)
    assert {(r.turn_uuid, r.kind, r.action) for r in planned.collect()} == {("u1", "placeholder", "superseded"), ("u3", "suppressed", "reset"), ("u4", "placeholder", "missing"), ("u5", "placeholder", "no-log")}
    total = recovery.totals(planned).first()
    assert (total.blocks, total.placeholder, total.superseded, total.missing, total.no_log, total.reset, total.exit) == (4, 3, 1, 1, 1, 1, 3)
    known = spark.createDataFrame([("s1", "u1")], "session_id string, turn_uuid string")
    assert {r.turn_uuid for r in recovery.backfill(blocks, known, logs).collect()} == {"u2", "u3"}
    modes = spark.createDataFrame([("pending", ""), ("", "x\n<!-- verbatim -->\ny"), ("", "says <!-- verbatim --> here")], "p string, b string")
    assert [r[0] for r in modes.select(recovery.render_mode(F.col("p"), F.col("b"))).collect()] == ["pending", "verbatim", "llm"]


def test_merges(spark):
    schema = "file string, block_ord int, turn_uuid string, provisional string, body string, session_id string"
    old = spark.createDataFrame([("f", 0, "u1", "", "final", "a"), ("f", 1, "u2", "pending", "wait", "b")], schema)
    new = spark.createDataFrame([("f", "u1", "", "again", "a"), ("f", "u2", "", "done", "b"), ("f", "u3", "", "more", "c"), ("g", "u9", "", "first", "d")], "file string, turn_uuid string, provisional string, body string, session_id string")
    got = {(r.file, r.block_ord): r.body for r in merge.merge_blocks(old, new).collect()}
    assert got == {("f", 0): "final", ("f", 1): "done", ("f", 2): "more", ("g", 0): "first"}
    kinds = spark.createDataFrame([("f", 0, "placeholder"), ("f", 1, "placeholder")], "file string, block_ord int, kind string")
    assert [r.provisional for r in merge.stamp(old, kinds).orderBy("block_ord").collect()] == ["placeholder", "pending"]
    assert [r.turn_uuid for r in merge.turns_of(old, True).collect()] == ["u2"]
    fixed = spark.createDataFrame([("b", "fixed")], "session_id string, rewritten string")
    assert [r.body for r in merge.apply_edits(old, fixed).orderBy("block_ord").collect()] == ["final", "fixed"]
    seen = []
    assert merge.after_write(old, [("one", lambda b: seen.append(b.count())), ("two", lambda b: None)]) == ["one", "two"] and seen == [2]
    with pytest.raises(RuntimeError, match="two failed after one"):
        merge.after_write(old, [("one", lambda b: None), ("two", lambda b: 1 / 0)])
    assert merge.run_hook(["/bin/cat"], "x", {}) == ("ok", "") and merge.run_hook(["/bin/sh", "-c", "echo no >&2; exit 3"], "", {"PATH": "/bin"}) == ("failed", "no\n") and merge.run_hook(["/bin/sleep", "9"], "", {}, 0.2)[0] == "timeout"
    lines = spark.createDataFrame([("a", "2024-01-01.md", 1, "- y"), ("a", "2024-01-01.md", 0, "## x"), ("a", "2024-01-02.md", 0, "- z")], "agent string, name string, pos int, line string")
    page = merge.journal(lines).first()
    assert page.context == "### 2024-01-02.md\n- z\n\n### 2024-01-01.md\n## x\n- y" and json.loads(page.payload)["hookSpecificOutput"]["additionalContext"] == page.context


RECORD = "ts timestamp, render_mode string, qc_ok boolean, qc_coverage double, placeholder boolean, suppressed boolean, discarded boolean, full_read boolean, truncated_items long, post_render_redactions long, input_tokens long, output_tokens long, model_resolved string, lag_s double, findings_by_check map<string,bigint>, findings_by_kind map<string,bigint>, findings_by_bucket map<string,map<string,bigint>>"


def test_report(spark):
    import datetime as dt

    def row(day, ok, coverage, model, placeholder=False, checks=None):
        return (dt.datetime(2024, 1, day), "llm", ok, coverage, placeholder, False, False, day % 2 == 0, 1, 2, 10, 5, model, float(day), checks or {}, {"path": 1}, {"path": {"absent": 2, "suffix": 1}})

    rows = [row(d, d % 4 != 0, d / 20, "m1", checks={"groundedness": 2} if d % 4 == 0 else {}) for d in range(1, 15)] + [row(12, None, None, "m2"), row(13, True, 0.9, None, placeholder=True)]
    records = spark.createDataFrame(rows, RECORD)
    p = report.population(records, []).first()
    assert (p.sessions, p.graded, p.passed, p.placeholders, p.blocks_failing, p.findings, p.absent) == (16, 14, 11, 1, 3, 6, 28) and p.by_check == {"groundedness": 6} and p.by_kind == {"path": 14}
    assert p.coverage_p10 == 0.1 and p.lag_s_p50 == 8.0 and (p.full_read_sessions, p.full_read_truncated, p.unknown_read) == (8, 8, 0) and p.models_resolved == ["m1", "m2"]
    r = report.report(records, "2024-01-15", 7, {"floor": 0.9, "drop": 0.01}, 3).first()
    assert (r.current_graded, r.previous_graded, r.code, r.new_models) == (7, 7, 1, ["m2"]) and "floor" in r.breaches
    assert report.report(records, "2030-01-01", 7, {}, 3).first().code == 3
    assert report.text_report(report.report(records, "2024-01-15", 7, {"floor": 0.9}, 3)).first().text.startswith("sessions  9 (before: 7)")
    assert report.valid_thresholds({"floor": 2, "x": 1, "drop": True}) and not report.valid_thresholds({"floor": 0.5})
    assert report.run_record(records, ["render_mode", "model_resolved", "nothing"]).columns == ["render_mode", "model_resolved", "nothing"]
    assert json.loads(report.sparse(spark.createDataFrame([("k", "", [], 1)], "k string, a string, b array<int>, c int"), "k").first().json) == {"c": 1}
    assert spark.range(1).select(report.artifacts(F.array(F.lit("a")), F.array(F.lit("a"), F.lit("b")), F.lit(None).cast("array<string>"))).first()[0] == 2
    logs = spark.range(1, 102).select(F.col("id").alias("done"), (F.col("id") * 2).alias("tickets"))
    got = {x.field: (x.n, x.median, x.p99, x.over) for x in report.corpus_survey(logs, {"done": F.col("done"), "tickets": F.col("tickets")}, {"done": 50, "tickets": 100}).collect()}
    assert got == {"done": (101, 51.0, 100.0, 51), "tickets": (101, 102.0, 200.0, 51)}


def test_sweep_totals(spark):
    cols = ", ".join([*[f"{f} boolean" for f in report.SWEEP_FLAGS], *[f"{c} long" for c in report.SWEEP_SUMS], "qc_ok boolean, qc_coverage double, render_mode string, eventlog_path string, hook string, degradation_level int"])
    flags, sums = len(report.SWEEP_FLAGS), len(report.SWEEP_SUMS)
    rows = [(*[True] * flags, *[2] * sums, True, 0.5, "verbatim", "/p", "ok", 1), (*[None] * flags, *[None] * sums, None, None, "llm", "", None, 0)]
    t = report.session_totals(spark.createDataFrame(rows, cols)).first()
    assert len(t) == 37
    assert (t.sessions, t.summarized, t.input_tokens, t.verbatim, t.truncated_full_read, t.qc_graded, t.groundedness_rate, t.mean_coverage) == (2, 1, 2, 1, 1, 1, 1.0, 0.5)


def test_providers(spark):
    waits, calls = [], []

    def call(reminder):
        calls.append(reminder)
        if len(calls) == 1:
            raise provider.ProviderError("busy", status=429)
        return provider.Completion("bad" if len(calls) == 2 else "good", 3, 4)

    out = provider.attempt(call, lambda t: None if t == "good" else "not good", sleep=waits.append)
    assert (out.reply, out.attempts, out.input_tokens, waits) == ("good", 3, 6, [6.0]) and "not good" in calls[2]
    down = provider.attempt(lambda r: (_ for _ in ()).throw(provider.Unreachable("no route")), lambda t: None, sleep=lambda s: None)
    assert down.reply is None and down.provider_unavailable and down.attempts == 3
    never = provider.attempt(lambda r: (_ for _ in ()).throw(provider.ProviderError("malformed", status=400)), lambda t: None)
    assert never.attempts == 1 and not never.provider_unavailable
    chat = provider.provider("chat", url="u", model="m", send=lambda url, body, timeout: (200, {"choices": [{"message": {"content": body["messages"][1]["content"]}}]}))
    assert chat.complete("s", "hello", 1).text == "hello"
    with pytest.raises(ValueError):
        provider.provider("other")
    got = provider.complete(spark.createDataFrame([(1, "t"), (2, None)], "id int, text string"), provider.Stub, "s", lambda t: None if "asked" in t else "no").orderBy("id").collect()
    assert [r.id for r in got] == [1, 2] and got[0].outcome.attempts == 1 and json.loads(got[0].outcome.reply)["asked"] == "t"


def test_rendering(spark):
    x = spark.createDataFrame([(["a", "b", "c"], [], "wrote N docs\nfine")], "files array<string>, none array<string>, t string")
    got = x.select(render.rollup([("Artifacts", F.col("files"), F.lit(2)), ("Tickets", F.col("none"), F.lit(2))]).alias("r"), render.detection(F.col("t")).alias("d")).first()
    assert got.r.text == "**Artifacts:**\n- a\n- b\n_1 more not shown (limit 2)._" and got.r.truncated == {"artifacts": 1}
    assert (got.d.signal, got.d.line, got.d.excerpt) == ("count_letter", "wrote N docs", "N")
    caps = dict.fromkeys(["done", "found", "decisions", "open_items", "artifacts", "tickets"], 40)
    one, two = render.contract(caps, "40 entries"), render.contract(caps | {"done": 41}, "40 entries")
    assert one[1] != two[1] and one == render.contract(caps, "40 entries")
    log = '{"session_id":"s","agent":"","started_at":"a","stats":{"turns":1,"tool_events":1,"extracted_chars":1234,"token_estimate":309,"raw_content_chars":5000,"secrets_redacted":0,"degradation_level":0},"turns":[{"turn_uuid":"0123456789","index":0,"user_text":"do\\nit","events":[{"tool":"Bash","target":"ls","ok":false}]}]}'
    from loomlog.sources.transcripts import EVENT_LOG

    text = spark.createDataFrame([(log,)], "j string").select(render.event_log_text(F.from_json("j", EVENT_LOG))).first()[0]
    assert text.startswith("session   s\nagent     (unknown)\nwindow    a -> ?") and "-- turn 0 [01234567] do\n   ! Bash" in text and "1,234 chars" in text


def test_configuration(tmp_path):
    path = tmp_path / "c.toml"
    path.write_text('[paths]\ntranscripts = "/a"\noutput = "/b"\n[provider]\ntype = "chat"\nkey = "${TOKEN}"\n')
    assert config.load(str(path))["paths"]["output"] == "/b"
    faults = config.check({"paths": {"transcripts": "/a", "output": "/a/b"}, "provider": {"key": "plain", "argv": "x y"}, "odd": {}, "hook": {"shell": 1}, "thresholds": {"floor": 2}})
    assert len(faults) == 6


def test_echoes(spark):
    from loomlog.functions import contamination

    steps = ["First read the whole manual", "Then open the lid slowly please", "Finally press the \"red\" button"]
    raw = "intro " + " ".join(steps).lower().replace('"', '\\"') + "\\n end"
    copy = "\n".join(f"{k}. **{s}**." for k, s in enumerate(steps, 1))
    mixed = "\n".join([steps[0], "My own line of enough length", "short", steps[1], "short", steps[2]])
    thin = "\n".join([steps[0], *[f"Line {k} of my own making entirely" for k in range(4)], steps[1], *[f"More {k} of my own making entirely" for k in range(4)], steps[2]])
    got = spark.createDataFrame([(copy,), (mixed,), (thin,), ("nothing of it at all here",)], "s string").select(contamination.echoes_source(F.col("s"), F.lit(raw)).alias("e")).collect()
    assert [r.e for r in got] == [True, True, False, False]


def test_block_tables(spark):
    from loomlog.operators import blocks, changelog, extract, trend

    one = spark.range(1)
    again = blocks.apply_frontmatter(blocks.apply_frontmatter(F.lit("x"), F.array(F.lit("a"))), F.array(F.lit("a"), F.lit("b")))
    assert one.select(again, blocks.apply_frontmatter(F.lit("---\ntitle: t\n---\nx"), F.array(F.lit("a")))).first()[:] == ("---\nsessions: [a, b]\n---\nx", "---\ntitle: t\n---\nx")
    text = one.select(F.concat_ws("\n", blocks.compose(F.lit("s1"), F.lit("u1"), F.lit("/t"), F.lit(""), F.lit("b")), blocks.compose(F.lit("s2"), F.lit("u2"), F.lit("/t"), F.lit("pending"), F.lit("b")), blocks.anchor(F.lit("s3"), F.lit("u3"), F.lit("/t"), F.lit(""))).alias("t")).first().t
    files = spark.createDataFrame([("/r/me/2024-01-01.md", text), ("/r/me/bad.md", None)], "file string, text string")
    logs = spark.createDataFrame([("s1", True)], "session_id string, parsed boolean")
    assert tuple(blocks.correction_scan(files, logs).first()) == (1, 1, 1, 0, 0, 1)
    rows = blocks.records(blocks.blocks(files.where("text is not null"))).orderBy("turn_uuid").collect()
    assert [(r.agent, r.date, r.session_id, r.eventlog_path) for r in rows] == [("me", "2024-01-01", "s1", ""), ("me", "2024-01-01", "s2", "")]
    e, a = (spark.createDataFrame(x, "k int, v string") for x in ([(1, "a"), (2, "b")], [(2, "c"), (3, "d")]))
    found = json.loads(changelog.drift_json(changelog.drift(e, a, ["k"], ["v"]), ["k"]).first().json)
    assert found == {"missing": [{"k": 1, "fields": ""}], "stale": [{"k": 3, "fields": ""}], "changed": [{"k": 2, "fields": "v"}]}
    assert one.select(trend.other_modes(F.array(F.lit("verbatim"), F.lit("llm")))).first()[0] == ["verbatim"]
    project = spark.createDataFrame([("/h/.claude/projects/me",)], "p string")
    assert project.select(extract.agent_folder(F.col("p"), "/digests", [])).first()[0] == "/digests/me"
    with pytest.raises(Exception, match="no agent"):
        spark.createDataFrame([("/h/other",)], "p string").select(extract.agent_folder(F.col("p"), "/digests", [])).collect()
