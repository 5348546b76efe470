"""Texts for people and prompts: rollup sections, notes, event logs, contracts."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .contamination import RESIDUE, excused, residue
from .text import bullet

#: Fields of a digest and what they hold, as a contract tells it.
FIELDS = {"asked": "what was asked", "done": "what was done", "found": "what was found", "decisions": "what was decided", "open_items": "what is open", "artifacts": "files written", "tickets": "tickets named"}


def truncation_note(more: Column, cap: Column | int) -> Column:
    """A note that is no bullet, so that the gate never grades it."""
    return F.format_string("_%d more not shown (limit %s)._", more, (F.lit(cap) if isinstance(cap, int) else cap).cast("string"))


def withheld_note(n: Column) -> Column:
    return F.format_string("_%d items withheld._", n)


def rollup(sections: list[tuple[str, Column, Column]], scrub: Callable[[Column], Column] = lambda x: x) -> Column:
    """struct<text, truncated>: labelled sections of (label, items, cap) in order, without empty ones. Each
    item is scrubbed before it becomes a bullet, as rules that begin at a line's start would miss it
    behind one; truncated maps labels to how many items were left out."""
    parts, lost = [], []
    for label, items, cap in sections:
        own = F.coalesce(items, F.array().cast("array<string>"))
        more = F.greatest(F.size(own) - cap, F.lit(0))
        lines = F.concat(F.array(F.lit(f"**{label}:**")), F.transform(F.slice(own, F.lit(1), cap.cast("int")), lambda x: bullet(scrub(x))), F.when(more > 0, F.array(truncation_note(more, cap))).otherwise(F.array().cast("array<string>")))
        parts.append(F.when(F.size(own) > 0, F.array_join(lines, "\n")))
        lost.append(F.struct(F.lit(label.lower()).alias("key"), more.alias("value")))
    return F.struct(F.concat_ws("\n\n", *parts).alias("text"), F.map_from_entries(F.filter(F.array(*lost), lambda x: x["value"] > 0)).alias("truncated"))


def event_log_text(log: Column) -> Column:
    """An event log (struct) as text: a head of counts, then each turn with its events."""
    st = log["stats"]

    def head(text: Column, n: int, none: str = "") -> Column:
        return F.substring(F.split(F.coalesce(F.nullif(text, F.lit("")), F.lit(none)), "\n")[0], 1, n)

    def turn(t: Column) -> Column:
        events = F.transform(t["events"], lambda e: F.format_string("   %s %-44s %s", F.when(F.coalesce(e["ok"], F.lit(True)), " ").otherwise("!"), e["tool"], head(e["target"], 80)))
        title = F.concat(F.lit("-- turn "), t["index"].cast("string"), F.lit(" ["), F.substring(t["turn_uuid"], 1, 8), F.lit("] "), head(t["user_text"], 100, "(no user text)"))
        return F.array_join(F.concat(F.array(title), events), "\n")

    # The heads of the lines.
    top = F.concat_ws(
        "\n", F.concat(F.lit("session   "), F.coalesce(F.nullif(log["session_id"], F.lit("")), F.lit("(unknown)"))), F.concat(F.lit("agent     "), F.coalesce(F.nullif(log["agent"], F.lit("")), F.lit("(unknown)"))),
        F.concat(F.lit("window    "), F.coalesce(log["started_at"], F.lit("?")), F.lit(" -> "), F.coalesce(log["ended_at"], F.lit("?"))), F.format_string("turns     %d   events %d", st["turns"], st["tool_events"]),
        F.concat(F.lit("size      "), F.format_number(st["extracted_chars"], 0), F.lit(" chars (~"), F.format_number(st["token_estimate"], 0), F.lit(" tok) from "), F.format_number(st["raw_content_chars"], 0), F.lit(" raw")),
        F.format_string("redacted  %d secret-shaped values", st["secrets_redacted"]), F.format_string("budget    level %d", st["degradation_level"]),
    )
    return F.concat(top, F.lit("\n\n"), F.array_join(F.transform(log["turns"], turn), "\n\n"))


def schema_of(caps: dict[str, int]) -> dict:
    """The JSON schema of a digest under the caps that its reply is judged by."""
    lists = {k: {"type": "array", "items": {"type": "string"}, "maxItems": caps[k]} for k in FIELDS if k != "asked"}
    return {"type": "object", "properties": {"asked": {"type": "string"}} | lists, "required": ["asked", "done"], "additionalProperties": False}


def contract(caps: dict[str, int], clause: str) -> tuple[str, str]:
    """The system prompt of a contract and its hash, which a run record keeps."""
    about = "\n".join(f"- {k}: {v}" for k, v in FIELDS.items())
    text = f"Summarise one session from its event log. Reply with one JSON object of these fields and nothing else.\n{about}\nLimits: {clause}.\nName only what the log holds.\n{json.dumps(schema_of(caps), sort_keys=True)}"
    return text, hashlib.sha256(text.encode()).hexdigest()


def detection(text: Column) -> Column:
    """struct<signal, line, excerpt> of a text's first residue, null for none: the line that holds it, with
    its white space as single spaces, and how it reads there."""
    lines = F.split(text, "\n")
    hit = F.filter(lines, lambda x: residue(x).isNotNull())

    def of(line: Column) -> Column:
        cleaned = excused(line)
        found = F.coalesce(*[F.nullif(F.regexp_extract(cleaned, p, 0), F.lit("")) for _, p in RESIDUE])
        return F.struct(residue(line).alias("signal"), F.trim(F.regexp_replace(line, r"\s+", " ")).alias("line"), found.alias("excerpt"))

    return F.when(F.size(hit) > 0, of(F.get(hit, F.lit(0))))
