"""Run records in aggregate: the figures of a population, a sweep's totals, the report and its verdict."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomlog.functions.text import ratio
from loomlog.operators import trend

#: Flags of a sweep's results that are counted, and numbers that are summed.
SWEEP_FLAGS = "summarized written suppressed placeholder discarded pending full_read manifest_appended manifest_error run_record_error correction_error deferred not_attempted".split()
SWEEP_SUMS = "superseded_blocks truncated_items withheld_items events secrets_redacted post_render_redactions ticket_refs_rewritten input_tokens output_tokens errors".split()


def _flag(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


def _number(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def session_totals(results: DataFrame) -> DataFrame:
    """One row of a sweep's results: sessions, each flag, each sum, what was cut short, and how the graded
    ones passed. Rates and means are null where nothing was graded."""
    graded, passed = F.count("qc_ok"), F.count_if(_flag("qc_ok"))
    return results.agg(
        F.count(F.lit(1)).alias("sessions"), *[F.count_if(_flag(f)).alias(f) for f in SWEEP_FLAGS], *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SWEEP_SUMS],
        F.count_if(F.col("render_mode") == "verbatim").alias("verbatim"), F.count_if(F.col("render_mode") == "verbatim-fallback-llm").alias("verbatim_fallback"),
        F.count_if(_number("truncated_items") > 0).alias("truncated"), F.count_if((_number("truncated_items") > 0) & _flag("full_read")).alias("truncated_full_read"),
        F.count_if(_number("withheld_items") > 0).alias("withheld"), F.count_if(F.coalesce(F.col("eventlog_path"), F.lit("")) != "").alias("eventlogs_written"),
        F.count_if(F.col("hook") == "ok").alias("hook_ok"), F.count_if(F.col("hook") == "failed").alias("hook_failed"), F.count_if(_number("degradation_level") > 0).alias("degraded"),
        graded.alias("qc_graded"), passed.alias("qc_passed"), ratio(passed, graded).alias("groundedness_rate"), F.bround(F.avg(F.when(F.col("qc_ok").isNotNull(), F.col("qc_coverage"))), 4).alias("mean_coverage"),
    )


def _merged(df: DataFrame, maps: str, by: list[str], out: str) -> DataFrame:
    """Sums of the maps' values by key, as one map sorted by key."""
    n = df.select(*by, F.explode(maps).alias("k", "v")).groupBy(*by, "k").agg(F.sum("v").alias("v"))
    return n.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias(out))


def population(records: DataFrame, by: list[str]) -> DataFrame:
    """Every figure of each population of run records. Placeholders are lost summaries: they are counted
    and then left out of every rate. Rates are null where there is nothing to divide by."""
    lost = _flag("placeholder")
    x = records.withColumn("_graded", ~lost & F.col("qc_ok").isNotNull())
    ok, g = F.col("_graded") & _flag("qc_ok"), F.col("_graded")
    checks = F.coalesce(F.col("findings_by_check"), F.create_map().cast("map<string,bigint>"))

    def failing(check: str) -> Column:
        return F.count_if(g & (F.coalesce(F.try_element_at(checks, F.lit(check)), F.lit(0)) > 0))

    n, cut = F.count_if(g), _number("truncated_items") > 0
    total = F.coalesce(F.sum(F.when(g, F.aggregate(F.map_values(checks), F.lit(0).cast("long"), lambda a, v: a + v))), F.lit(0))
    absent = F.coalesce(F.sum(F.when(g, trend.absent_count(F.coalesce(F.col("findings_by_bucket"), F.create_map().cast("map<string,map<string,bigint>>"))))), F.lit(0))
    out = x.groupBy(*by).agg(
        F.count(F.lit(1)).alias("sessions"), n.alias("graded"), F.count_if(ok).alias("passed"), ratio(F.count_if(ok), n).alias("pass_rate"), F.bround(F.avg(F.when(g, F.col("qc_coverage"))), 4).alias("coverage_mean"),
        failing("event_coverage").alias("coverage_floor_failed"), ratio(failing("event_coverage"), n).alias("coverage_floor_failed_share"), failing("groundedness").alias("blocks_failing"),
        ratio(failing("groundedness"), n).alias("failure_rate"), total.alias("findings"), ratio(total, n).alias("findings_per_session"), absent.alias("absent"), ratio(absent, n).alias("absent_per_session"),
        *[F.count_if(F.col("full_read") == full).alias(f"{name}_sessions") for name, full in (("full_read", True), ("incremental", False))],
        *[F.count_if((F.col("full_read") == full) & cut).alias(f"{name}_truncated") for name, full in (("full_read", True), ("incremental", False))],
        F.count_if(F.col("full_read").isNull()).alias("unknown_read"), F.count_if(lost).alias("placeholders"), F.count_if(_flag("suppressed")).alias("suppressed"), F.count_if(_flag("discarded")).alias("discarded"),
        F.coalesce(F.sum("post_render_redactions"), F.lit(0)).alias("post_render_redactions"), F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("input_tokens"), F.coalesce(F.sum("output_tokens"), F.lit(0)).alias("output_tokens"),
        F.array_sort(F.collect_set("model_resolved")).alias("models_resolved"),
    )
    key = F.struct(*[F.col(c) for c in by]) if by else F.lit(1)
    out = out.withColumn("_k", key)
    graded = x.where("_graded").withColumn("_k", key)
    extras = [_merged(graded, c, ["_k"], c.replace("findings_", "")) for c in ("findings_by_check", "findings_by_kind")]
    for df, value, ranks in ((x.where("_graded"), "qc_coverage", {"coverage_p10": 0.10}), (records, "lag_s", {"lag_s_p50": 0.50, "lag_s_p95": 0.95})):
        own = df.withColumn("_k", F.struct(*[F.col(c) for c in by]) if by else F.lit(1))
        extras.append(trend.order_statistics(own, ["_k"], value, {k: trend.nearest_rank(q) for k, q in ranks.items()}))
    return reduce(lambda a, b: a.join(b, "_k", "left"), extras, out).drop("_k")


def report(records: DataFrame, end: str, days: int, thresholds: dict[str, float], min_sessions: int, source: str | None = None) -> DataFrame:
    """One row: the figures of the last `days` before end and of as many before them, of what a model
    wrote; models that are new, the breaches (array), and the verdict's code."""
    x = records if source is None else records.where(F.col("source") == source)
    x = x.where(trend.model_written(F.col("render_mode"))).withColumn("window_ix", trend.window_index(F.col("ts"), end, days)).where("window_ix in (0, 1)")
    both = population(x, ["window_ix"])
    empty = records.sparkSession.range(2).select(F.col("id").alias("window_ix"))
    both = empty.join(both, "window_ix", "left")
    cols = ["sessions", "graded", "passed", "pass_rate", "coverage_mean", "failure_rate", "findings_per_session", "absent_per_session", "models_resolved", "lag_s_p95"]
    now, before = (both.where(f"window_ix = {k}").select(*[F.col(c).alias(f"{name}_{c}") for c in cols]) for k, name in ((0, "current"), (1, "previous")))
    y = now.join(before)  # one row each
    none = F.array().cast("array<string>")
    fresh = F.when(F.coalesce(F.col("previous_sessions"), F.lit(0)) > 0, trend.new_values(F.coalesce("current_models_resolved", none), F.coalesce("previous_models_resolved", none))).otherwise(none)
    floor, drop = thresholds.get("floor", 0.0), thresholds.get("drop", 1.0)
    code = trend.verdict(F.col("current_graded"), F.col("current_pass_rate"), F.col("previous_graded"), F.col("previous_pass_rate"), min_sessions, floor, drop)
    return y.withColumn("new_models", fresh).withColumn("breaches", trend.breaches(F.col("current_pass_rate"), F.col("previous_pass_rate"), floor, drop)).withColumn("code", code)


def valid_thresholds(thresholds: dict[str, float]) -> list[str]:
    """What is wrong with thresholds: unknown names, and values that are no share from 0 to 1."""
    known = {"floor", "drop"}
    return [f"unknown threshold {k}" for k in thresholds if k not in known] + [f"{k} must be from 0 to 1" for k, v in thresholds.items() if k in known and (isinstance(v, bool) or not isinstance(v, int | float) or not 0 <= v <= 1)]


def text_report(report_rows: DataFrame) -> DataFrame:
    """The report as lines of text, for people."""
    def rate(c: str) -> Column:
        return F.coalesce(F.format_string("%.1f%%", F.col(c) * 100), F.lit("n/a"))

    lines = [
        F.format_string("sessions  %s (before: %s)", F.coalesce("current_sessions", F.lit(0)), F.coalesce("previous_sessions", F.lit(0))), F.concat(F.lit("passed    "), rate("current_pass_rate"), F.lit(" (before: "), rate("previous_pass_rate"), F.lit(")")),
        F.concat(F.lit("breaches  "), F.coalesce(F.nullif(F.array_join("breaches", ", "), F.lit("")), F.lit("none"))), F.format_string("verdict   %s", F.col("code")),
    ]
    return report_rows.select(F.concat_ws("\n", *lines).alias("text"))


def run_record(results: DataFrame, fields: list[str]) -> DataFrame:
    """The allow-listed fields of results, in that order; the provider and model are null where no model
    wrote the text, and fields that a result lacks are null."""
    written = trend.model_written(F.col("render_mode"))
    cols = []
    for f in fields:
        value = F.col(f) if f in results.columns else F.lit(None).cast("string")
        cols.append((F.when(written, value) if f in ("provider", "model_requested", "model_resolved") else value).alias(f))
    return results.select(*cols)


def sparse(df: DataFrame, *key: str) -> DataFrame:
    """(key..., json) of rows without their nulls, empty texts and empty lists."""
    def filled(name: str, kind: str) -> Column:
        c = F.col(name)
        return F.when(F.size(c) > 0, c) if kind.startswith(("array", "map")) else F.nullif(c, F.lit("")) if kind == "string" else c

    return df.select(*key, F.to_json(F.struct(*[filled(n, k).alias(n) for n, k in df.dtypes if n not in key])).alias("json"))


def corpus_survey(logs: DataFrame, fields: dict[str, Column], floors: dict[str, float]) -> DataFrame:
    """For each denominator of event logs: how many, the largest, percentiles and how many are over the
    floor at which a derived cap governs. Artifacts are the distinct union of their lists."""
    long = logs.select(F.explode(F.create_map(*[x for k, c in fields.items() for x in (F.lit(k), c.cast("double"))])).alias("field", "value"))
    floor = F.create_map(*[x for k, v in floors.items() for x in (F.lit(k), F.lit(float(v)))])
    n = long.groupBy("field").agg(F.count("value").alias("n"), F.max("value").alias("max"), F.count_if(F.col("value") > F.try_element_at(floor, F.col("field"))).alias("over"))
    return n.join(trend.order_statistics(long, ["field"], "value", {"median": trend.upper_median_rank(), "p99": trend.nearest_rank(0.99)}), "field")


def artifacts(*lists: Column) -> Column:
    """How many distinct values lists hold together."""
    return F.size(reduce(F.array_union, [F.coalesce(x, F.array().cast("array<string>")) for x in lists]))
