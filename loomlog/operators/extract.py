"""Session extraction: the records of transcripts (path, line_no, raw, v, parsed) as event logs.

Every step is a table keyed by path: entries (one row for each record that counts), uses and results
paired by their id, turns, and one log a path. A record's order is its line, a block's its place in it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomlog.functions import redaction, references, text
from loomlog.operators import sessions
from loomlog.plans.folders import shared_folder

# Record and block types, field names, and where projects live.
#: Characters that a log keeps of a text, a target, arguments and a result.
LIMITS = {"text": 4000, "target": 500, "args": 300, "result": 600}
_STRINGS = "array<string>"


def _get(path: str, kind: str = "string") -> Column:
    return F.try_variant_get("v", path, kind)


def _blocks(kind: str) -> Column:
    """The blocks of a kind in a message's content, as variants in order."""
    return F.filter(F.coalesce(_get("$.message.content", "array<variant>"), F.array().cast("array<variant>")), lambda b: F.try_variant_get(b, "$.type", "string") == kind)


def _joined(values: Column) -> Column:
    return F.array_join(F.filter(values, lambda x: F.coalesce(x, F.lit("")) != ""), "\n")


def kept(value: Column, limit: str, limits: dict[str, int]) -> Column:
    """A text as a log holds it: redacted whole, then cut."""
    return cut(value, limits[limit])


def cut(value: Column, limit: int) -> Column:
    return text.bound(redaction.redact(value), lambda x: text.elide(x, limit))


def entries(records: DataFrame) -> DataFrame:
    """Records that count, with what they are (role: user, assistant, results, queued, boundary), their turn
    from 0 and their texts. A turn opens with a user's text, or with the first work before any."""
    is_text = F.schema_of_variant(_get("$.message.content", "variant")) == "STRING"
    said = F.when(is_text, _get("$.message.content")).otherwise(F.array_join(F.transform(_blocks("text"), lambda b: F.coalesce(F.try_variant_get(b, "$.text", "string"), F.lit(""))), "\n"))
    kind, queued = _get("$.type"), _get("$.attachment.type") == "queued_command"
    x = records.where("parsed").select(
        "path", "line_no", "v", kind.alias("kind"), F.coalesce(_get("$.timestamp"), F.lit("")).alias("ts"), F.coalesce(_get("$.uuid"), F.lit("")).alias("uuid"), F.coalesce(_get("$.isMeta", "boolean"), F.lit(False)).alias("meta"),
        F.coalesce(_get("$.isCompactSummary", "boolean"), F.lit(False)).alias("compact"), said.alias("said"), is_text.alias("is_text"), F.size(_blocks("tool_result")).alias("n_results"),
        F.when((kind == "attachment") & queued, F.coalesce(_get("$.attachment.prompt"), F.lit(""))).alias("prompt"), sessions.from_harness(_get("$.origin.kind"), _get("$.attachment.commandMode")).alias("harness"),
        ((kind == "system") & (_get("$.subtype") == "compact_boundary")).alias("boundary"),
    )
    way = sessions.disposition(F.col("kind"), F.col("meta"), F.col("compact"), F.when(F.col("n_results") == 0, F.col("said")).otherwise(""))
    x = x.withColumn("way", way)
    keep = F.col("way") == "keep"
    role = (
        F.when(F.trim("prompt") != "", "queued").when(F.col("boundary"), "boundary").when(keep & (F.col("kind") == "user") & (F.col("n_results") > 0), "results")
        .when(keep & (F.col("kind") == "user") & (F.trim("said") != ""), "user").when(keep & (F.col("kind") == "assistant") & ~F.coalesce("is_text", F.lit(False)), "assistant")
    )
    x = x.withColumn("role", role)
    before = Window.partitionBy("path").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    works = F.col("role").isin("user", "assistant", "queued")
    first = F.coalesce(F.sum(F.coalesce(works, F.lit(False)).cast("int")).over(before), F.lit(0)) == 0
    return sessions.segment_turns(x.withColumn("opens", (F.col("role") == "user") | (F.col("role").isin("assistant", "queued") & first)), "path", ["line_no"], F.col("opens"), "turn_ix")


def tool_events(found: DataFrame, limits: dict[str, int] = LIMITS) -> DataFrame:
    """Tool calls (path, turn_ix, seq, tool, kind, target, args_digest, ok, error, result_digest, result_chars,
    task_status, tool_use_id, ...), each with the first result after it that has its id; ok is null where
    none came."""
    uses = found.where("role = 'assistant'").select("path", "line_no", "turn_ix", F.posexplode(_blocks("tool_use")).alias("pos", "b"))
    uses = uses.select("path", "line_no", "turn_ix", "pos", F.coalesce(F.try_variant_get("b", "$.id", "string"), F.lit("")).alias("id"), F.coalesce(F.nullif(F.try_variant_get("b", "$.name", "string"), F.lit("")), F.lit("unknown")).alias("tool"), F.coalesce(F.to_json(F.try_variant_get("b", "$.input", "variant")), F.lit("{}")).alias("args"))
    uses = sessions.sequence(uses, "path", ["line_no", "pos"])
    results = found.where("role = 'results'").select("path", "line_no", "v", F.posexplode(_blocks("tool_result")).alias("pos", "b"))
    body = F.try_variant_get("b", "$.content", "variant")
    parts = F.transform(F.filter(F.coalesce(F.try_variant_get("b", "$.content", "array<variant>"), F.array().cast("array<variant>")), lambda p: F.try_variant_get(p, "$.type", "string") == "text"), lambda p: F.try_variant_get(p, "$.text", "string"))
    plain = F.when(F.schema_of_variant(body) == "STRING", F.try_variant_get("b", "$.content", "string")).otherwise(_joined(parts))
    results = results.select(
        "path", "line_no", "pos", F.coalesce(F.try_variant_get("b", "$.tool_use_id", "string"), F.lit("")).alias("id"), F.coalesce(F.try_variant_get("b", "$.is_error", "boolean"), F.lit(False)).alias("failed"),
        sessions.result_text(plain, _get("$.toolUseResult.stdout"), _get("$.toolUseResult.stderr")).alias("body"), plain.alias("plain"), _get("$.toolUseResult.agentId").alias("agent_id"), _get("$.toolUseResult.status").alias("own_status"),
        (F.coalesce(_get("$.toolUseResult.isAsync", "boolean"), F.lit(False)) | (_get("$.toolUseResult.status") == "async_launched")).alias("background"), _get("$.toolUseResult.backgroundTaskId").alias("task_id"),
    )
    both = uses.select("path", "line_no", "pos", "id", F.lit("use").alias("what")).unionByName(results.select("path", "line_no", "pos", "id", F.lit("result").alias("what")))
    pairs = sessions.pair_results(both, ["path", "id"], ["line_no", "pos"], F.col("what") == "use", F.col("what") == "result").select("path", "line_no", "pos", "id", "role", "pair")
    key = ["path", "line_no", "pos", "id"]
    uses = uses.join(pairs.where("role = 'use'").select(*key, "pair"), key)
    results = results.join(pairs.where("role = 'result' AND pair IS NOT NULL").select(*key, "pair"), key).drop("line_no", "pos")
    x = uses.join(results, ["path", "id", "pair"], "left")
    c = sessions.classify_tool(F.col("tool"), F.from_json("args", "map<string,string>"))
    x = x.withColumn("c", c)
    shown = F.lit("")
    for name, _, arg in sessions.TOOLS:
        shown = F.when((F.col("tool") == name) & (F.col("c.target") != ""), arg).otherwise(shown)
    status = F.get_json_object("args", "$.status")
    task_status = F.when((F.col("tool").endswith("update_task") | F.col("tool").endswith("submit_task")) & status.rlike("^[a-z_-]{1,32}$"), status)
    ended = F.col("body").isNotNull()
    return x.select(
        "path", "line_no", "turn_ix", "seq", "tool", F.col("c.kind").alias("kind"), F.col("c.target").alias("raw_target"), kept(F.col("c.target"), "target", limits).alias("target"), kept(sessions.args_summary(F.col("args"), shown), "args", limits).alias("args_digest"),
        F.when(ended, ~F.col("failed")).alias("ok"), F.when(F.col("failed"), cut(F.col("body"), 300)).otherwise("").alias("error"), F.coalesce(kept(F.col("body"), "result", limits), F.lit("")).alias("result_digest"),
        F.coalesce(F.length("body"), F.lit(0)).cast("long").alias("result_chars"), F.coalesce(task_status, F.lit("")).alias("task_status"), F.col("id").alias("tool_use_id"), "args", "plain", "agent_id", "own_status", F.coalesce("background", F.lit(False)).alias("background"), "task_id",
    )


def subagents(found: DataFrame, events: DataFrame) -> DataFrame:
    """Agent calls (path, turn_ix, seq, subagent_type, description, background, agent_id, status): the status is
    that of the last notification of the harness, else what the call's result said."""
    calls = events.where("tool IN ('Agent', 'Task')")
    agent = F.coalesce(F.nullif("agent_id", F.lit("")), references.last_agent_id(F.coalesce("plain", F.lit(""))))
    calls = calls.select(
        "path", "turn_ix", "seq", "tool_use_id", F.coalesce(F.get_json_object("args", "$.subagent_type"), F.lit("")).alias("subagent_type"), cut(F.coalesce(F.get_json_object("args", "$.description"), F.lit("")), 300).alias("description"),
        (F.coalesce(F.get_json_object("args", "$.run_in_background") == "true", F.lit(False)) | F.col("background")).alias("background"), F.coalesce(agent, F.lit("")).alias("agent_id"), F.when(F.col("background"), "running").otherwise(F.coalesce("own_status", F.lit(""))).alias("own"),
    )
    last = notices(found).where("status <> ''").groupBy("path", "tool_use_id").agg(F.max_by("status", "line_no").alias("notified"))
    x = calls.join(last, ["path", "tool_use_id"], "left")
    return x.withColumn("status", F.coalesce("notified", "own")).drop("notified", "own", "tool_use_id")


def notices(found: DataFrame) -> DataFrame:
    """Task notifications that the harness wrote (path, line_no, task_id, tool_use_id, status): text alone that
    looks like one says nothing."""
    x = found.where("harness AND role IN ('user', 'queued')").withColumn("t", F.coalesce("prompt", "said")).where(F.contains("t", F.lit("<task-notification>")))
    n = references.notification(F.col("t"))
    return x.select("path", "line_no", *[F.coalesce(n[c], F.lit("")).alias(c) for c in ("task_id", "tool_use_id", "status")])


def _distinct(value: Column, when: Column, order: Column) -> Column:
    return sessions.ordered_distinct(F.when(when, value), order)


def _rollup(lists: dict[str, Column]) -> Column:
    return F.struct(*[F.coalesce(c, F.array().cast(_STRINGS)).alias(k) for k, c in lists.items()])


def turns(found: DataFrame, events: DataFrame, limits: dict[str, int] = LIMITS) -> DataFrame:
    """Turns (path, turn_ix, turn_uuid, started_at, ended_at, user_text, queued_input, assistant_text, events,
    thinking_blocks, rollup)."""
    own = found.where("role IN ('user', 'assistant', 'queued')")
    at = F.col("line_no")
    spoken = F.filter(F.transform(_blocks("text"), lambda b: F.trim(F.coalesce(F.try_variant_get(b, "$.text", "string"), F.lit("")))), lambda x: x != "")
    said = F.transform(spoken, lambda x: kept(x, "text", limits))
    head = own.groupBy("path", "turn_ix").agg(
        F.min_by("uuid", "line_no").alias("turn_uuid"), F.min_by("ts", "line_no").alias("started_at"), F.max_by("ts", F.when((F.col("role") == "assistant") & (F.col("ts") != ""), at)).alias("last"),
        F.max(F.when(F.col("role") == "user", kept(F.col("said"), "text", limits))).alias("user_text"),
        F.transform(F.array_sort(F.collect_list(F.when(F.col("role") == "queued", F.struct(at.alias("o"), kept(F.col("prompt"), "text", limits).alias("x"))))), lambda s: s["x"]).alias("queued_input"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.when(F.col("role") == "assistant", F.struct(at.alias("o"), said.alias("x"))))), lambda s: s["x"])).alias("assistant_text"),
        F.sum(F.when(F.col("role") == "assistant", F.size(_blocks("thinking"))).otherwise(0)).cast("int").alias("thinking_blocks"),
    )
    cols = "seq tool kind target args_digest ok error result_digest result_chars task_status".split()
    e, o = F.col, F.col("seq")
    lists = {
        "commands": _distinct(F.substring(F.split("target", "\n")[0], 1, 300), e("kind") == "bash", o), "files_read": _distinct(e("target"), e("kind") == "file_read", o), "files_written": _distinct(e("target"), e("kind") == "file_write", o),
        "agents": _distinct(F.substring("target", 1, 120), e("kind") == "agent", o), "mcp_tools": _distinct(e("tool"), e("tool").startswith("mcp__"), o),
        "failures": _distinct(F.concat(e("tool"), F.lit(": "), F.coalesce(F.nullif(F.substring("error", 1, 200), F.lit("")), F.lit("failed"))), ~e("ok"), o), "web": _distinct(e("target"), e("kind") == "web", o),
    }
    refs = F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.when(e("kind") == "bash", F.struct(o.alias("o"), references.git_refs(e("target")).alias("x"))))), lambda s: s["x"])))
    acted = events.groupBy("path", "turn_ix").agg(F.array_sort(F.collect_list(F.struct(*cols))).alias("events"), *[c.alias(k) for k, c in lists.items()], F.slice(refs, 1, sessions.ROLLUP_CAP).alias("git_refs"))
    x = head.join(acted, ["path", "turn_ix"], "left")
    empty = events.groupBy().agg(F.collect_list(F.struct(*cols)).alias("e")).schema["e"].dataType
    x = x.withColumn("events", F.coalesce("events", F.array().cast(empty)))
    pool = F.concat(F.array(F.coalesce("user_text", F.lit(""))), "assistant_text", F.flatten(F.transform("events", lambda v: F.array(v["target"], v["result_digest"]))))
    x = x.withColumn("_pool", F.array_join(F.filter(pool, lambda p: p != ""), "\n"))
    x = x.withColumn("_refs", references.tickets_and_prs(F.col("_pool")))
    none = F.array().cast(_STRINGS)
    urls = F.array_distinct(F.concat(F.coalesce("web", none), references.urls(F.col("_pool"))))
    rollup = _rollup({k: F.col(k) for k in lists if k != "web"} | {"git_refs": F.col("git_refs"), "tickets": F.slice("_refs.tickets", 1, sessions.ROLLUP_CAP), "prs": F.slice("_refs.prs", 1, sessions.ROLLUP_CAP), "urls": F.slice(urls, 1, sessions.ROLLUP_CAP)})
    return x.select(
        "path", "turn_ix", F.coalesce(F.nullif("turn_uuid", F.lit("")), F.concat(F.lit("turn-"), F.col("turn_ix").cast("string"))).alias("turn_uuid"), "started_at", F.coalesce("last", "started_at").alias("ended_at"), F.coalesce("user_text", F.lit("")).alias("user_text"),
        "queued_input", "assistant_text", "events", "thinking_blocks", rollup.alias("rollup"),
    )


def agent_of(path: Column, cwd: Column, known: list[str]) -> Column:
    """The agent that a session belongs to: the directory below .claude/projects of its working directory, else
    the longest known name that the transcript's flattened directory can mean, else its first part."""
    direct = F.nullif(F.regexp_extract(cwd, r"/\.claude/projects/([^/]+)/?$", 1), F.lit(""))
    tail = F.regexp_extract(path, r"-claude-projects-([^/]+)/[^/]*$", 1)
    names = F.filter(F.array(*[F.lit(k) for k in sorted(known, key=len, reverse=True)]) if known else F.array().cast(_STRINGS), lambda k: (tail == k) | tail.startswith(F.concat(k, F.lit("-"))))
    return F.coalesce(direct, F.get(names, F.lit(0)), F.nullif(F.split(tail, "-")[0], F.lit("")), F.lit(""))


def agent_folder(project: Column, root: str, known: list[str]) -> Column:
    """Where a reader finds an agent's digests; unlike the writer, which falls back to `unknown`, it fails on
    a project without an agent or with one whose name would leave the root."""
    agent = agent_of(F.concat(project, F.lit("/x")), project, known)
    return F.when(text.valid_name(agent), F.concat(F.lit(root.rstrip("/") + "/"), agent)).otherwise(F.raise_error(F.lit("no agent for this project")).cast("string"))


def event_logs(records: DataFrame, budget: int = 200_000, known_agents: list[str] = (), limits: dict[str, int] = LIMITS) -> DataFrame:
    """One log for each transcript: who and where, its turns, subagents, compactions, what still runs, the
    rollup over all turns, and its figures. A log over the budget loses results, then arguments, then
    the ends of targets, and never what was said; sizes are those of Spark's own serialisation. Entries,
    events and turns are kept in the shared folder, so that transcripts are parsed once."""
    shared_folder(records.sparkSession)
    found = entries(records).checkpoint()  # read by every part below, as are the next two
    events = tool_events(found, limits).checkpoint()
    each = turns(found, events, limits).checkpoint()
    w = "line_no"

    def first(path: str) -> Column:
        value = F.nullif(F.try_variant_get("v", path, "string"), F.lit(""))
        return F.coalesce(F.min_by(value, F.when(value.isNotNull(), F.col(w))), F.lit(""))

    good = records.where("parsed")
    ts = F.nullif(F.try_variant_get("v", "$.timestamp", "string"), F.lit(""))
    head = good.groupBy("path").agg(
        first("$.sessionId").alias("session_id"), first("$.cwd").alias("cwd"), first("$.gitBranch").alias("git_branch"), first("$.version").alias("version"), first("$.entrypoint").alias("entrypoint"),
        F.min_by(ts, F.when(ts.isNotNull(), F.col(w))).alias("started_at"), F.max_by(ts, F.when(ts.isNotNull(), F.col(w))).alias("ended_at"), F.count(F.lit(1)).alias("records"),
    )
    bad = records.groupBy("path").agg(F.count_if(~F.col("parsed")).alias("records_unparsable"))
    ways = found.groupBy("path").agg(
        *[F.count_if(F.col("way") == k).alias(f"skipped_{k}") for k in ("meta", "compact", "injected")], F.count_if(F.col("role") == "queued").alias("queued_commands"), F.sum(F.when(F.col("role") == "results", F.col("n_results")).otherwise(0)).alias("tool_results"),
        F.sum(F.when(F.col("role") == "user", F.length("said")).when(F.col("role") == "queued", F.length("prompt")).otherwise(0)).alias("_typed"),
    )
    per_event = events.groupBy("path").agg(F.count(F.lit(1)).alias("tool_events"), F.count_if(~F.col("ok")).alias("failures"), F.count_if(F.col("ok").isNotNull()).alias("_ended"), F.sum(F.col("result_chars") + F.length("args") + F.length("tool")).alias("_raw"))
    boundary = found.where("role = 'boundary'").select(
        "path", F.struct("line_no", "ts", F.col("turn_ix").cast("int").alias("turn_index"), F.coalesce(_get("$.compactMetadata.trigger"), F.lit("")).alias("trigger"), F.coalesce(_get("$.compactMetadata.preTokens", "bigint"), F.lit(0)).alias("pre_tokens"), F.coalesce(_get("$.compactMetadata.postTokens", "bigint"), F.lit(0)).alias("post_tokens")).alias("c")
    ).groupBy("path").agg(F.transform(F.array_sort(F.collect_list("c")), lambda c: c.dropFields("line_no")).alias("compactions"))
    subs = subagents(found, events)
    agents = subs.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("seq", *[c for c in subs.columns if c not in ("path", "seq")]))).alias("subagents"))
    launched = subs.where("background AND agent_id <> ''").select("path", "turn_ix", F.col("agent_id").alias("task")).unionByName(events.where("tool = 'Bash' AND get_json_object(args, '$.run_in_background') = 'true' AND task_id <> ''").select("path", "turn_ix", F.col("task_id").alias("task")))
    final = each.groupBy("path").agg(F.max("turn_ix").alias("turn_ix"))
    running = launched.groupBy("path", "task").agg(F.min("turn_ix").alias("turn_ix")).join(final, ["path", "turn_ix"]).join(notices(found).select("path", F.col("task_id").alias("task")).distinct(), ["path", "task"], "left_anti")
    running = running.groupBy("path").agg(F.array_sort(F.collect_list("task")).alias("background_pending"))
    body = [c for c in each.columns if c != "path"]
    lists = [f.name for f in each.schema["rollup"].dataType.fields]
    whole = each.groupBy("path").agg(F.array_sort(F.collect_list(F.struct(*body))).alias("turns"))
    whole = whole.withColumn("rollup", F.struct(*[_over(k).alias(k) for k in lists]))
    x = head.join(bad, "path").join(ways, "path", "left").join(per_event, "path", "left").join(whole, "path", "left").join(boundary, "path", "left").join(agents, "path", "left").join(running, "path", "left")
    x = x.withColumn("agent", agent_of(F.col("path"), F.col("cwd"), list(known_agents)))
    return degrade(x, budget)


def _over(name: str) -> Column:
    return sessions.merged_rollup(F.transform("turns", lambda t: t["rollup"][name]))


def degrade(logs: DataFrame, budget: int) -> DataFrame:
    """Logs with degradation_level, extracted_chars and token_estimate, their turns as that level leaves them:
    the first of whole, without results, without arguments too, targets cut to 200 and to 80 characters
    that fits the budget; 0 or less means no budget."""
    def event(e: Column, level: int) -> Column:
        out = e.withField("result_digest", F.lit("")) if level >= 1 else e
        out = out.withField("args_digest", F.lit("")) if level >= 2 else out
        return out.withField("target", sessions.rung_target(e["target"], F.lit(level))) if level >= 3 else out

    def at(level: int) -> Column:
        return F.transform("turns", lambda t: t.withField("events", F.transform(t["events"], lambda e: event(e, level))))

    rungs = len(sessions.LADDER) + 3
    sizes = F.array(*[F.length(F.to_json(at(k))) for k in range(rungs)])
    x = logs.withColumn("_sizes", sizes)
    fits = sessions.degradation_level([F.get("_sizes", F.lit(k)) for k in range(rungs)], budget) if budget > 0 else F.lit(0)
    x = x.withColumn("degradation_level", fits.cast("int"))
    turns_ = F.col("turns")
    for k in range(1, rungs):
        turns_ = F.when(F.col("degradation_level") == k, at(k)).otherwise(turns_)
    size = F.get("_sizes", F.col("degradation_level")).cast("long")
    raw = F.coalesce("_typed", F.lit(0)) + F.coalesce("_raw", F.lit(0)) + F.coalesce(F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + F.aggregate(t["assistant_text"], F.lit(0).cast("long"), lambda b, s: b + F.length(s))), F.lit(0))
    x = x.withColumn("turns", turns_).withColumn("extracted_chars", F.coalesce(size, F.lit(0))).withColumn("raw_content_chars", raw.cast("long"))
    x = x.withColumn("token_estimate", text.token_estimate(F.col("extracted_chars"))).withColumn("compression_ratio", text.ratio(F.col("extracted_chars"), F.col("raw_content_chars"), 0.0))
    x = x.withColumn("budget_exceeded", F.lit(budget > 0) & (F.col("extracted_chars") > budget)).withColumn("orphan_results", (F.coalesce("tool_results", F.lit(0)) - F.coalesce("_ended", F.lit(0))).cast("long"))
    marks = F.regexp_count(F.to_json("turns"), F.lit(redaction.MARK))
    return x.withColumn("secrets_redacted", F.coalesce(marks, F.lit(0)).cast("long")).drop("_sizes", "_typed", "_raw", "_ended")
