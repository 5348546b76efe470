"""References in texts: tickets, pull requests, URLs, git refs, notifications."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shapes of references.
TASK_URL = r"(?i)(?<![\w.-])vikunja\.[a-z0-9.-]+/tasks/(\d+)"
QUALIFIED = r"(?i)\b((?:[\w.-]+/)?[a-z][\w.-]*[a-z0-9])#(\d{1,6})\b"
PR_WORD = r"(?i)\b(?:PRs?|pull(?:\s+request)?s?|issues?)\s+\[?#(\d{1,6})\b"
PR_PAREN = r"\(#(\d{1,6})\)"
PR_LINK = r"\[#(\d{1,6})\]\("
BARE_TICKET = r"(?<![/\w\d])#([1-9]\d{0,5})\b"
URL = r"https?://[^\s'\"<>)\]}]+"
GIT = r"\bgit\s+(?:-C\s+\S+\s+)?([a-z][a-z-]*)"
SHA = r"\b[0-9a-f]{7,40}\b"
TRACKER = "vikunja"


def _all(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _hash(numbers: Column) -> Column:
    return F.transform(numbers, lambda n: F.concat(F.lit("#"), n))


def tickets_and_prs(text: Column) -> Column:
    """struct<tickets, prs>, each in order of its patterns and of the text, distinct."""
    text = F.coalesce(text, F.lit(""))
    pairs = F.arrays_zip(_all(text, QUALIFIED, 1).alias("name"), _all(text, QUALIFIED, 2).alias("number"))
    ours = F.filter(pairs, lambda p: F.lower(p["name"]).endswith(TRACKER))
    others = F.filter(pairs, lambda p: ~F.lower(p["name"]).endswith(TRACKER))
    masked = text
    for pattern in (QUALIFIED, PR_WORD, PR_PAREN, PR_LINK):
        masked = F.regexp_replace(masked, pattern, " ")
    tickets = F.concat(_hash(_all(text, TASK_URL)), F.transform(ours, lambda p: F.concat(F.lit("#"), p["number"])), _hash(_all(masked, BARE_TICKET)))
    prs = F.concat(F.transform(others, lambda p: F.concat_ws("#", p["name"], p["number"])), *[_hash(_all(text, p)) for p in (PR_WORD, PR_PAREN, PR_LINK)])
    return F.struct(F.array_distinct(tickets).alias("tickets"), F.array_distinct(prs).alias("prs"))


def urls(text: Column) -> Column:
    return F.transform(_all(text, URL, 0), lambda u: F.rtrim(u, F.lit(".,);")))


def git_refs(command: Column) -> Column:
    """Sub-commands of git in a command line, each with the hashes in the 200 characters after it."""
    tails = F.split(F.regexp_replace(command, GIT, "\u0001$1\u0002"), "\u0001")
    each = F.transform(
        F.slice(tails, 2, F.greatest(F.size(tails) - 1, F.lit(0))),
        lambda t: F.concat(F.array(F.substring_index(t, "\u0002", 1)), _all(F.substring(F.substring_index(t, "\u0002", -1), 1, 200), SHA, 0)),
    )
    return F.when(F.contains(command, F.lit("git")), F.array_distinct(F.flatten(each))).otherwise(F.array().cast("array<string>"))


def notification(text: Column) -> Column:
    """struct<task_id, tool_use_id, status> of a task notification, null where absent."""

    def one(name: str, shape: str) -> Column:
        return F.nullif(F.regexp_extract(text, f"<{name}>({shape})</{name}>", 1), F.lit(""))

    return F.struct(one("task-id", "[A-Za-z0-9_-]{1,64}").alias("task_id"), one("tool-use-id", "[A-Za-z0-9_-]{1,128}").alias("tool_use_id"), one("status", "[a-z_-]{1,32}").alias("status"))


def last_agent_id(text: Column) -> Column:
    found = _all(text, r"\bagentId:\s*([A-Za-z0-9]{1,64})\b")
    return F.when(F.size(found) > 0, F.element_at(found, -1))
