import json

from pyspark.sql import functions as F

from loomlog.operators import extract
from loomlog.sources import transcripts

T = "2024-01-01T10:00:{:02d}Z"


def record(n, kind, content=None, **more):
    return {"type": kind, "timestamp": T.format(n), "uuid": f"u{n}", "sessionId": "s1", "cwd": "/home/x/.claude/projects/doc-health"} | ({"message": {"content": content}} if content is not None else {}) | more


def use(id_, name, **args):
    return {"type": "tool_use", "id": id_, "name": name, "input": args}


def result(id_, content, **more):
    return {"type": "tool_result", "tool_use_id": id_, "content": content} | more


ROWS = [
    record(0, "assistant", [{"type": "text", "text": "resumed"}]), record(1, "user", "Base directory for this skill: x"), record(2, "user", "m", isMeta=True), record(3, "user", "fix #12\nplease, password: hunter2"),
    record(4, "assistant", [{"type": "thinking"}, {"type": "text", "text": " ok "}, use("t1", "Bash", command="git commit -m x", status="s"), use("t2", "Read", file_path="/a/b.py")]),
    record(5, "user", [result("t1", [{"type": "text", "text": "done"}], is_error=True), result("t9", "orphan")], toolUseResult={"stdout": "out", "stderr": ""}),
    record(6, "attachment", attachment={"type": "queued_command", "prompt": "also this"}), record(7, "system", subtype="compact_boundary", compactMetadata={"trigger": "auto", "preTokens": 9, "postTokens": 3}),
    record(8, "user", "summary", isCompactSummary=True), record(9, "user", [{"type": "text", "text": "next: see https://a.b/c."}]),
    record(10, "assistant", [use("t3", "Agent", description="look", subagent_type="scout", run_in_background=True), use("t4", "Bash", command="sleep", run_in_background=True), use("t5", "mcp__tracker__update_task", task_id="7", status="open")]),
    record(11, "user", [result("t3", "agentId: abc")], toolUseResult={"isAsync": True, "agentId": "abc"}), record(12, "user", [result("t4", "bg")], toolUseResult={"backgroundTaskId": "b1"}),
    record(13, "user", "<task-notification><task-id>abc</task-id><tool-use-id>t3</tool-use-id><status>completed</status></task-notification>", origin={"kind": "task-notification"}),
    record(14, "user", "<task-notification><task-id>b1</task-id></task-notification>"),
]


def logs(spark, tmp_path, **options):
    folder = tmp_path / "-home-x--claude-projects-doc-health"
    folder.mkdir(exist_ok=True)
    (folder / "s1.jsonl").write_text("\n".join([*map(json.dumps, ROWS), "not json", "[1]"]))
    return extract.event_logs(transcripts.records(spark, str(folder / "*.jsonl")), **options)


def test_a_transcript_becomes_an_event_log(spark, tmp_path):
    x = logs(spark, tmp_path).first()
    assert (x.session_id, x.agent, x.started_at, x.ended_at, x.records, x.records_unparsable) == ("s1", "doc-health", T.format(0), T.format(14), 15, 2)
    assert (x.skipped_meta, x.skipped_compact, x.skipped_injected, x.queued_commands, x.tool_results, x.orphan_results, x.tool_events, x.failures) == (1, 1, 1, 1, 4, 1, 5, 1)
    assert [t.turn_uuid for t in x.turns] == ["u0", "u3", "u9", "u13", "u14"]
    first, fix, later = x.turns[0], x.turns[1], x.turns[2]
    assert first.assistant_text == ["resumed"] and first.user_text == "" and fix.user_text == "fix #12\nplease, password: hunter2"
    assert fix.queued_input == ["also this"] and fix.assistant_text == ["ok"] and fix.thinking_blocks == 1 and fix.ended_at == T.format(4)
    bash, read = fix.events
    assert (bash.seq, bash.kind, bash.target, bash.args_digest, bash.ok, bash.error, bash.result_digest, bash.result_chars) == (0, "bash", "git commit -m x", "status=s", False, "done\n[stdout] out", "done\n[stdout] out", 17)
    assert (read.kind, read.target, read.ok) == ("file_read", "/a/b.py", None)
    r = fix.rollup
    assert (r.commands, r.files_read, r.git_refs, r.tickets, r.failures) == (["git commit -m x"], ["/a/b.py"], ["commit"], ["#12"], ["Bash: done\n[stdout] out"])
    assert later.rollup.urls == ["https://a.b/c"] and later.rollup.mcp_tools == ["mcp__tracker__update_task"] and later.events[2].task_status == "open" and later.events[2].target == "7"
    assert x.rollup.tickets == ["#12"] and x.rollup.agents == ["look"]
    sub = x.subagents[0]
    assert (sub.subagent_type, sub.description, sub.background, sub.agent_id, sub.status) == ("scout", "look", True, "abc", "completed")
    assert [tuple(c) for c in x.compactions] == [(T.format(7), 1, "auto", 9, 3)]
    assert x.degradation_level == 0 and not x.budget_exceeded and x.extracted_chars > 0 and x.token_estimate == (x.extracted_chars + 3) // 4


def test_the_budget_takes_results_first(spark, tmp_path):
    whole = logs(spark, tmp_path).first()
    less = logs(spark, tmp_path, budget=whole.extracted_chars - 1).first()
    assert less.degradation_level == 1 and less.turns[1].events[0].result_digest == "" and less.turns[1].events[0].args_digest == "status=s" and less.turns[1].user_text
    least = logs(spark, tmp_path, budget=10).first()
    assert least.degradation_level == 4 and least.budget_exceeded and least.turns[1].events[0].target == "git commit -m x"


def test_empty_and_agents(spark, tmp_path):
    (tmp_path / "e.jsonl").write_text("nothing\n")
    assert extract.event_logs(transcripts.records(spark, str(tmp_path / "e.jsonl"))).count() == 0
    paths = spark.createDataFrame([("/p/-home-u--claude-projects-doc-health-x/s.jsonl", ""), ("/p/-home-u--claude-projects-alpha-beta/s.jsonl", ""), ("/p/other/s.jsonl", "/w"), ("/p/x/s.jsonl", "/h/.claude/projects/me")], "path string, cwd string")
    got = [r[0] for r in paths.select(extract.agent_of(F.col("path"), F.col("cwd"), ["doc", "doc-health"])).collect()]
    assert got == ["doc-health", "alpha", "", "me"]
