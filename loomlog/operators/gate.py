"""The gate over summaries: findings of a claims table, verdicts, attribution and corrections.

A row of sessions holds a summary and what grounds it: session_id, digest, corpus (lower-cased), terms
(struct<paths, commands, tools, tickets>) and events (array<struct<tool, target>>). Claims explode from
their own row and are compared with it alone, so no side is ever crossed with another session's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomlog.functions import grounding
from loomlog.functions.text import home_swap
from loomlog.operators.blocks import without_markers

#: Claims that a run record keeps.
MAX_CLAIMS = 20


def claims(sessions: DataFrame) -> DataFrame:
    """Each session's distinct claims (kind, claim), compared as they are graded: without markers."""
    own = F.explode(grounding.claims(without_markers(F.col("digest")))).alias("c")
    return sessions.withColumn("c", own).select("*", F.col("c.kind").alias("kind"), F.col("c.claim").alias("claim")).drop("c")


def findings(sessions: DataFrame, rule: str = "current", floor: float = grounding.COVERAGE_FLOOR) -> DataFrame:
    """(session_id, check, kind, claim, detail, id_conflation, swap_identifier) of every claim that is
    not grounded, of sessions whose summary is empty, and of those that cover too few events."""
    x = claims(sessions.where(F.trim("digest") != ""))
    graded = grounding.GRADING[rule](F.col("kind"), F.col("claim"), F.col("terms.paths"), F.col("terms.tickets"), F.col("terms.tools"), F.col("corpus"), F.col("terms.commands"))
    x = x.where(~F.coalesce(graded, F.lit(False)))
    conflated = F.coalesce((F.col("kind") == "ticket") & grounding.id_conflation(F.col("claim"), F.col("corpus")), F.lit(False))
    x = x.withColumn("id_conflation", conflated)
    swap = F.when(F.col("id_conflation"), F.try_element_at(grounding.annotated_numbers(without_markers(F.col("digest"))), F.col("claim")))
    x = x.withColumn("swap", swap)
    right = grounding.ticket_grounded(F.concat(F.lit("#"), F.col("swap")), F.col("terms.tickets"), F.col("corpus"))
    ungrounded = x.select(
        "session_id", F.lit("groundedness").alias("check"), "kind", "claim", grounding.message(F.col("kind"), F.col("claim"), F.col("id_conflation")).alias("detail"), "id_conflation",
        F.when(F.coalesce(right, F.lit(False)), F.col("swap")).alias("swap_identifier"),
    )

    def other(df: DataFrame, check: str, detail: Column) -> DataFrame:
        none = F.lit(None).cast("string")
        return df.select("session_id", F.lit(check).alias("check"), none.alias("kind"), none.alias("claim"), detail.alias("detail"), F.lit(False).alias("id_conflation"), none.alias("swap_identifier"))

    covered = covering(sessions.where(F.trim("digest") != "")).where(F.col("coverage") < floor)
    few = other(covered, "event_coverage", F.format_string("digest references too few of %d events", F.col("events_total")))
    empty = other(sessions.where(F.coalesce(F.trim("digest"), F.lit("")) == ""), "coverage", F.lit("digest is empty"))
    return ungrounded.unionByName(few).unionByName(empty)


def covering(sessions: DataFrame) -> DataFrame:
    """(session_id, events_total, coverage): events without a target don't count."""
    events = F.filter("events", lambda e: F.coalesce(e["target"], F.lit("")) != "")
    x = sessions.select("session_id", "digest", events.alias("e"))
    share = grounding.coverage(F.transform("e", lambda e: e["target"]), F.col("digest"), F.transform("e", lambda e: e["tool"]))
    return x.select("session_id", F.size("e").alias("events_total"), share.alias("coverage"))


def verdicts(sessions: DataFrame, found: DataFrame) -> DataFrame:
    """(session_id, ok, n_findings): a summary passes without findings."""
    n = found.groupBy("session_id").agg(F.count(F.lit(1)).alias("n_findings"))
    x = sessions.select("session_id").join(n, "session_id", "left").withColumn("n_findings", F.coalesce("n_findings", F.lit(0)))
    return x.select("session_id", (F.col("n_findings") == 0).alias("ok"), "n_findings")


def freshness(digests: DataFrame, transcripts: DataFrame, key: str = "session_id") -> DataFrame:
    """Transcripts without a digest, or with one older than they are: (key, detail). Both sides have
    mtime, null where it could not be read."""
    x = transcripts.select(key, F.col("mtime").alias("t")).join(digests.select(key, F.col("mtime").alias("d"), F.lit(True).alias("have")), key, "left")
    detail = F.when(F.col("have").isNull(), "no digest").when(F.col("d").isNull() | F.col("t").isNull(), "cannot compare timestamps").when(F.col("d") < F.col("t"), "digest is older than its transcript")
    return x.select(key, detail.alias("detail")).where("detail is not null")


def rejected(found: DataFrame, kind: str) -> DataFrame:
    """Claims of a kind, read off the findings and never graded again."""
    return found.where((F.col("check") == "groundedness") & (F.col("kind") == kind)).select("session_id", "claim")


def attributed(found: DataFrame, sessions: DataFrame, home: str = "/home/user") -> DataFrame:
    """(session_id, kind, bucket, claim, suffix_segments): why each claim was rejected."""
    x = found.where("check = 'groundedness'").select("session_id", "kind", "claim").join(sessions.select("session_id", "corpus", "digest"), "session_id")
    x = x.withColumn("desynced", grounding.desynced_spans(without_markers(F.col("digest")))).withColumn("low", F.lower("claim"))
    low, corpus = F.col("low"), F.col("corpus")
    bucket = (
        F.when(F.col("kind") == "path", grounding.path_bucket(low, corpus, home_swap(low, home))).when(F.col("kind") == "ticket", grounding.ticket_bucket(low, corpus)).when(F.col("kind") == "tool", "absent")
        .otherwise(grounding.span_bucket(low, corpus, F.col("desynced")))
    )
    n = F.when(F.col("kind") == "path", grounding.suffix_segments(low, corpus)).otherwise(0)
    return x.select("session_id", "kind", bucket.alias("bucket"), "claim", n.cast("long").alias("suffix_segments"))


def corrections(sessions: DataFrame, found: DataFrame) -> DataFrame:
    """(session_id, rewritten, edits) of summaries with tickets that are ids; strictly after grading, as
    the findings judge what the model wrote."""
    bad = found.where("id_conflation").groupBy("session_id").agg(
        F.transform(F.array_sort(F.collect_set("claim")), lambda c: F.substring(c, 2, 16)).alias("numbers"),
        F.map_from_entries(F.collect_list(F.when(F.col("swap_identifier").isNotNull(), F.struct("claim", "swap_identifier")))).alias("swaps"),
    )
    x = sessions.select("session_id", "digest").join(bad, "session_id")
    return x.select("session_id", grounding.rewrite_conflations(F.col("digest"), F.col("numbers"), F.col("swaps")).alias("rewritten"), grounding.edits(F.col("digest"), F.col("numbers"), F.col("swaps")).alias("edits"))


def shown(edits: DataFrame, most: int = 20) -> DataFrame:
    """The first edits by session and line, as a preview of a correction."""
    return edits.select("session_id", F.explode("edits").alias("e")).select("session_id", "e.*").orderBy("session_id", "line", "before").limit(most)


def record_fields(found: DataFrame, buckets: DataFrame) -> DataFrame:
    """What a run record keeps of a session's findings: counts by check and by kind, and its first claims
    by kind, bucket and text."""
    def counts(df: DataFrame, col: str, name: str) -> DataFrame:
        n = df.where(F.col(col).isNotNull()).groupBy("session_id", col).agg(F.count(F.lit(1)).alias("n"))
        return n.groupBy("session_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(col, "n")))).alias(name))

    first = buckets.groupBy("session_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("kind", "bucket", "claim"))), 1, MAX_CLAIMS).alias("claims"))
    return counts(found, "check", "findings_by_check").join(counts(found, "kind", "findings_by_kind"), "session_id", "left").join(first, "session_id", "left")


def survey(sessions: DataFrame, rule: str = "current", home: str = "/home/user", limit: int | None = None) -> DataFrame:
    """Findings by kind and bucket (kind, bucket, n, sessions), the totals of a kind with a null bucket and
    those of all with a null kind; limit: so many sessions by id, where a survey samples."""
    some = sessions if limit is None else sessions.orderBy("session_id").limit(limit)
    x = attributed(findings(some, rule), some, home)
    return x.rollup("kind", "bucket").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("session_id").alias("sessions"))


def disagreements(sessions: DataFrame, rule: str) -> DataFrame:
    """Claims (session_id, kind, claim, only) that the current rule and another one judge differently."""
    a, b = (findings(sessions, r).where("check = 'groundedness'").select("session_id", "kind", "claim") for r in ("current", rule))
    return a.exceptAll(b).withColumn("only", F.lit("current")).unionByName(b.exceptAll(a).withColumn("only", F.lit(rule)))
