"""Claims of a summary and how they are grounded in a session's text, as array expressions over
columns of one row: neither side is ever crossed with another session's."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .references import BARE_TICKET
from .text import bound, normalise, occurrences, segments

# Shapes of claims, tool names, binaries, limits.
PATH = r"(?:(?<=\s)|^)(?:~|\.{0,2})/[\w./~-]{2,}(?:[\w~/-]|(?<=/)\.{1,2})"
SPAN = r"`([^`\n]*)`"
AMBIGUOUS_TOOLS = ["Read", "Write", "Edit", "Task", "Skill", "Agent"]
DISTINCT_TOOLS = ["WebFetch", "WebSearch", "ToolSearch", "NotebookEdit", "NotebookRead", "AskUserQuestion", "MultiEdit", "Bash", "Glob", "Grep"]
TOOL = r"\bmcp__[\w-]+\b|`(?:" + "|".join(AMBIGUOUS_TOOLS) + r")`|\b(?:" + "|".join(DISTINCT_TOOLS) + r")\b"
SHELL_META = ["|", "&&", "||", ">", "<", ";", "$("]
BINARIES = (
    "apt awk bash cat chmod chown cp curl df docker du echo find git grep head jq kill ln ls make mkdir mv node npm pip pkill pm2 pnpm python python3 pytest rg rm rsync ruff sed sort ssh sudo systemctl tail tar uv wc"
).split()
ID_CONTEXT = r"(?:\\?\"\w{0,32}id\\?\"\s*:\s*\\?\"?|\bid(?:\s*[:=])?\s*|_id\s*[:=]\s*\"?|\"target\"\s*:\s*\"|/)"
MIN_SPAN, MAX_SPAN, WINDOW, SCAN_CAP = 3, 200, 120, 262_144
COVERAGE_FLOOR = 0.10
TOKEN = r"[A-Za-z_][A-Za-z0-9_-]{2,}|\d{2,}"
ANNOTATION = r"[ \t]*\(id[ \t]+([1-9]\d{0,5})\)"
WRAPPING = "\"'`.,;:()[]{}<>* "
LOOSE_SPAN = r"`([^`\n]{3,200})`"
KINDS = ["path", "tool", "ticket", "command", "code", "identifier"]


def _all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def quoted(text: Column) -> Column:
    """A text as a literal of a regular expression."""
    return F.concat(F.lit("\\Q"), F.replace(text, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))


def classify_span(span: Column) -> Column:
    head, second = F.split(F.trim(span), r"\s+")[0], F.try_element_at(F.split(F.trim(span), r"\s+"), F.lit(2))
    meta = F.exists(F.array(*map(F.lit, SHELL_META)), lambda m: F.contains(span, m))
    flagged = F.coalesce(second.startswith("-"), F.lit(False)) & head.rlike(r"^[A-Za-z_][\w.-]*$")
    return F.when(meta | head.isin(BINARIES) | flagged, "command").when(span.rlike(r"[()\[\]{}=]"), "code").otherwise("identifier")


def claims(text: Column) -> Column:
    """array<struct<kind, claim>> of a summary, distinct, in order of kind and code point."""
    spans = F.filter(_all(text, SPAN, 1), lambda s: F.length(s).between(MIN_SPAN, MAX_SPAN))

    def of(kind: Column | str, found: Column) -> Column:
        return F.transform(F.array_sort(F.array_distinct(found)), lambda c: F.struct((F.lit(kind) if isinstance(kind, str) else kind).alias("kind"), c.alias("claim")))

    tools = F.transform(_all(text, TOOL), lambda t: F.replace(t, F.lit("`"), F.lit("")))
    tickets = F.transform(_all(text, BARE_TICKET, 1), lambda n: F.concat(F.lit("#"), n))
    in_spans = F.transform(F.array_sort(F.array_distinct(spans)), lambda s: F.struct(classify_span(s).alias("kind"), s.alias("claim")))
    return F.concat(of("path", _all(text, PATH)), of("tool", tools), of("ticket", tickets), in_spans)


def contained(claim: Column, terms: Column) -> Column:
    """Some term holds the claim or is held by it."""
    return F.exists(terms, lambda t: (t != "") & (F.contains(t, claim) | F.contains(claim, t)))


def adjacent(before: Column, after: Column, corpus: Column, window: int = WINDOW) -> Column:
    """Some occurrence of one text is followed by the other, wholly within the window."""
    gap = F.greatest(F.lit(window) - F.length(after), F.lit(0))
    pattern = F.concat(F.lit("(?s)"), quoted(before), F.lit(".{0,"), gap.cast("string"), F.lit("}?"), quoted(after))
    return F.regexp_like(F.substring(corpus, 1, SCAN_CAP + window), pattern)


def composed(path: Column, corpus: Column, least_prefix: int = 2, least_tail: int = 2, window: int = WINDOW) -> Column:
    """The first cut (longest tail) at which both halves stand in the corpus, and the tail is long
    enough or near its prefix; null where there is none."""
    parts = segments(path)
    n = F.size(parts)
    lead = F.when(path.startswith("/"), F.lit("/")).otherwise(F.lit(""))

    def works(cut: Column) -> Column:
        prefix = F.concat(lead, F.array_join(F.slice(parts, 1, cut), "/"))
        tail = F.array_join(F.slice(parts, cut + 1, n), "/")
        return F.contains(corpus, prefix) & F.contains(corpus, tail) & ((n - cut >= least_tail) | adjacent(prefix, tail, corpus, window))

    cuts = F.when(n > least_prefix, F.filter(F.sequence(F.lit(least_prefix), F.greatest(n - 1, F.lit(least_prefix))), works))
    return F.when(F.size(cuts) > 0, cuts[0])


def tilde_anchored(path: Column, corpus: Column) -> Column:
    parts = segments(path)
    cuts = F.sequence(F.lit(1), F.greatest(F.size(parts) - 2, F.lit(1)))
    return path.startswith("/") & (F.size(parts) > 2) & F.exists(cuts, lambda k: F.contains(corpus, F.concat(F.lit("~/"), F.array_join(F.slice(parts, k + 1, F.size(parts)), "/"))))


def path_grounded(path: Column, terms: Column, corpus: Column) -> Column:
    return contained(path, terms) | F.contains(corpus, path) | F.coalesce(composed(path, corpus) > 0, F.lit(False)) | tilde_anchored(path, corpus)


def suffix_segments(path: Column, corpus: Column) -> Column:
    """Segments in the longest end of the path that the corpus holds."""
    parts = segments(path)
    n = F.size(parts)
    held = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda k: (k <= n) & F.contains(corpus, F.array_join(F.slice(parts, n - k + 1, k), "/")))
    return F.coalesce(F.array_max(held), F.lit(0))


def path_bucket(path: Column, corpus: Column, swapped: Column) -> Column:
    return (
        F.when(F.contains(corpus, path), "verbatim").when(F.coalesce(F.contains(corpus, swapped), F.lit(False)), "home-expansion")
        .when(F.coalesce(composed(path, corpus) > 0, F.lit(False)), "composed").when(suffix_segments(path, corpus) > 0, "suffix").otherwise("absent")
    )


def ticket_grounded(ticket: Column, tickets: Column, corpus: Column) -> Column:
    return F.array_contains(tickets, ticket) | F.regexp_like(corpus, F.concat(quoted(ticket), F.lit(r"\b")))


def id_conflation(ticket: Column, corpus: Column) -> Column:
    """The ticket's number is known only as an id."""
    return F.regexp_like(corpus, F.concat(F.lit(ID_CONTEXT), F.substring(ticket, 2, 16), F.lit(r"\b")))


def ticket_bucket(ticket: Column, corpus: Column) -> Column:
    number = F.substring(ticket, 2, 16)
    plain = F.regexp_like(corpus, F.concat(F.lit(r"(?<!\d)"), number, F.lit(r"(?!\d)")))
    return F.when(id_conflation(ticket, corpus), "id-conflation").when(plain, "coincidental-number").otherwise("absent")


def tokens_of(span: Column) -> Column:
    """Distinct significant tokens of a span, lower-cased."""
    return F.array_distinct(F.transform(_all(span, TOKEN), F.lower))


def covering_span(tokens: Column, corpus: Column) -> Column:
    """Length of the shortest stretch of the corpus that holds every token, null where one is missing.
    A token's occurrences don't overlap each other; one pass over all of them in order of their start
    keeps the last start of each token, and a stretch ends where the current occurrence does."""
    each = F.transform(tokens, lambda t, i: F.transform(occurrences(t, corpus), lambda p: F.struct(p.alias("start"), (p + F.length(t)).alias("end"), i.alias("token"))))
    none = F.transform(tokens, lambda t: F.lit(-1).cast("long"))

    def step(acc: Column, x: Column) -> Column:
        last = F.transform(acc["last"], lambda p, i: F.when(i == x["token"], x["start"]).otherwise(p))
        return bound(last, lambda ls: F.struct(ls.alias("last"), F.least(acc["best"], bound(F.array_min(ls), lambda m: F.when(m >= 0, x["end"] - m))).alias("best")))

    start = F.struct(none.alias("last"), F.lit(None).cast("long").alias("best"))
    return F.when(F.size(tokens) > 0, F.aggregate(F.array_sort(F.flatten(each)), start, step, lambda acc: acc["best"]))


def co_occur(tokens: Column, corpus: Column, window: int = WINDOW) -> Column:
    return (F.size(tokens) >= 2) & F.coalesce(covering_span(tokens, corpus) <= window, F.lit(False))


def strip_chars(text: Column, chars: str) -> Column:
    """A text without any of the characters at its ends."""
    return F.rtrim(F.ltrim(text, F.lit(chars)), F.lit(chars))


def span_bucket(span: Column, corpus: Column, desynced: Column | None = None) -> Column:
    """Why a span was rejected; desynced: spans that only a looser pairing of backticks finds."""
    tokens = tokens_of(span)
    bare = strip_chars(span, WRAPPING)
    lost = F.filter(tokens, lambda t: ~F.contains(corpus, t))
    odd = F.lit(False) if desynced is None else F.coalesce(F.array_contains(desynced, span), F.lit(False))
    return (
        F.when(odd, "desync-artefact").when(F.contains(corpus, bare) & (bare != span) & (bare != ""), "punctuation-wrapped").when(F.size(lost) == F.size(tokens), "absent")
        .when(F.size(lost) > 0, "token-missing").when(F.size(tokens) < 2, "single-token").otherwise("token-spread")
    )


def desynced_spans(text: Column) -> Column:
    """Spans that a pattern which may begin at a closing backtick finds, and claims() does not."""
    loose = F.transform(_all(text, LOOSE_SPAN, 1), normalise)
    live = F.transform(F.filter(_all(text, SPAN, 1), lambda s: F.length(s).between(MIN_SPAN, MAX_SPAN)), normalise)
    return F.array_except(loose, live)


def path_root(path: Column) -> Column:
    """The first two segments of a path, which say which tree it is in."""
    return F.concat(F.when(path.startswith("/"), F.lit("/")).otherwise(F.lit("")), F.array_join(F.slice(segments(path), 1, 2), "/"))


def span_grounded(kind: Column, span: Column, commands: Column, corpus: Column) -> Column:
    """A span stands in the corpus, or its tokens stand there together; a command may be one of the
    session's, and a path only counts by its tokens if its root is there as written."""
    rooted = ~F.regexp_like(span, F.lit(rf"^(?:{PATH})$")) | F.contains(corpus, path_root(span))
    return ((kind == "command") & contained(span, commands)) | F.contains(corpus, span) | (rooted & bound(tokens_of(span), lambda ts: co_occur(ts, corpus)))


def grounding_terms(read: Column, written: Column, commands: Column, tickets: Column, prs: Column, events: Column) -> Column:
    """struct<paths, commands, tools, tickets> of what a session's summary may assert, lower-cased, from
    its rollup's lists and its events (array<struct<tool, kind, target>>)."""
    def low(*lists: Column) -> Column:
        return F.array_distinct(F.transform(F.concat(*[F.coalesce(x, F.array().cast("array<string>")) for x in lists]), F.lower))

    touched = F.filter(events, lambda e: e["kind"].isin("file_read", "file_write") & (F.coalesce(e["target"], F.lit("")) != ""))
    return F.struct(
        low(read, written, F.transform(touched, lambda e: e["target"])).alias("paths"), F.array_distinct(F.transform(F.coalesce(commands, F.array().cast("array<string>")), normalise)).alias("commands"),
        low(F.transform(events, lambda e: e["tool"])).alias("tools"), low(tickets, prs).alias("tickets"),
    )


def annotated_numbers(text: Column) -> Column:
    """map<#N, M>: for each `#N (id M)` with another M, the first M in the text."""
    pattern = BARE_TICKET + "(?i:" + ANNOTATION + ")"
    pairs = F.arrays_zip(F.transform(_all(text, pattern, 1), lambda n: F.concat(F.lit("#"), n)).alias("key"), _all(text, pattern, 2).alias("value"))
    pairs = F.filter(pairs, lambda p: F.substring(p["key"], 2, 16) != p["value"])

    def firsts(ps: Column) -> Column:
        keys = F.array_distinct(F.transform(ps, lambda p: p["key"]))
        return F.map_from_arrays(keys, F.transform(keys, lambda k: F.get(F.filter(ps, lambda p: p["key"] == k), F.lit(0))["value"]))

    return bound(pairs, firsts)


def grounded(kind: Column, claim: Column, terms: Column, tickets: Column, tools: Column, corpus: Column, commands: Column | None = None) -> Column:
    """Whether a claim of any kind is grounded; texts are compared without regard to case."""
    low, none = F.lower(claim), F.array().cast("array<string>")
    return (
        F.when(kind == "path", path_grounded(low, terms, corpus)).when(kind == "tool", contained(low, tools) | F.contains(corpus, low))
        .when(kind == "ticket", ticket_grounded(low, tickets, corpus)).otherwise(span_grounded(kind, low, none if commands is None else commands, corpus))
    )


def literally_grounded(kind: Column, claim: Column, terms: Column, tickets: Column, tools: Column, corpus: Column, commands: Column | None = None) -> Column:
    """The rule before composition: a path stands in a category or in the corpus; else as now."""
    low = F.lower(claim)
    return F.when(kind == "path", contained(low, terms) | F.contains(corpus, low)).otherwise(grounded(kind, claim, terms, tickets, tools, corpus, commands))


#: Grading rules by name.
GRADING = {"current": grounded, "literal": literally_grounded}


def message(kind: Column, claim: Column, conflated: Column) -> Column:
    """What a finding says; a ticket known only as an id is named as such."""
    number = F.substring(claim, 2, 16)
    as_id = F.format_string("ticket '%s' is not in the event log, which contains '%s' only as an internal id", claim, number)
    return F.when((kind == "ticket") & conflated, as_id).otherwise(F.format_string("%s not in the event log: '%s'", kind, claim))


def rewrite_conflations(text: Column, numbers: Column, swaps: Column | None = None) -> Column:
    """`#N` as `id N` for the numbers that are ids, `#N (id N)` as `id N`, and, where swaps (map<#N, M>)
    says that M is the ticket, `#N (id M)` as `#M (id N)`. Comment markers are left alone."""
    outside = r"(?![^<]*?-->)(?<![/\w])#("

    def plain(t: Column) -> Column:
        one = F.concat(F.lit(outside), F.array_join(numbers, "|"), F.lit(r")\b(?:[ \t]*(?i:\(id[ \t]+\1\)))?"))
        return F.when(F.size(numbers) > 0, F.regexp_replace(t, one, F.lit("id $1"))).otherwise(t)

    if swaps is None:
        return plain(text)
    marked = F.aggregate(
        F.map_entries(swaps), text,
        lambda acc, s: F.regexp_replace(acc, F.concat(F.lit(outside), F.substring(s["key"], 2, 16), F.lit(r")\b[ \t]*(?i:\(id[ \t]+"), s["value"], F.lit(r"\))")), F.concat(F.lit("\u0001"), s["value"], F.lit(" (id $1)"))),
    )
    return F.translate(plain(marked), "\u0001", "#")


def edits(text: Column, numbers: Column, swaps: Column, first_line: int = 1) -> Column:
    """array<struct<line, before, after>> of the references that rewrite_conflations changes, in order;
    tokens alone, never the line around them."""
    def of_line(line: Column, k: Column) -> Column:
        found = _all(line, r"(?<![/\w\d])#[1-9]\d{0,5}\b(?:[ \t]*(?i:\(id[ \t]+[1-9]\d{0,5}\)))?")
        pairs = F.transform(found, lambda x: F.struct((k + first_line).alias("line"), x.alias("before"), rewrite_conflations(x, numbers, swaps).alias("after")))
        trimmed = F.transform(pairs, lambda p: F.when(
            p["after"].endswith(F.regexp_extract(p["before"], ANNOTATION + "$", 0)) & p["after"].startswith("id ") & p["before"].contains("("),
            F.struct(p["line"], F.regexp_extract(p["before"], r"^#\d+", 0).alias("before"), F.regexp_extract(p["after"], r"^id \d+", 0).alias("after")),
        ).otherwise(p))
        return F.filter(trimmed, lambda p: p["before"] != p["after"])

    lines = F.split(F.regexp_replace(text, r"<!--[^\n]*?-->", ""), "\n")
    return F.flatten(F.transform(lines, of_line))


def coverage(targets: Column, digest: Column, tools: Column | None = None) -> Column:
    """Share of the events whose target's first 60 characters, or whose tool, stand in the digest; 1 for
    none. tools: the events' tools, in the targets' order."""
    def share(text: Column) -> Column:
        def hit(t: Column, i: Column) -> Column:
            head = bound(normalise(t), lambda n: F.substring(n, 1, 60))
            named = F.lit(False) if tools is None else F.contains(text, F.lower(F.get(tools, i)))
            return bound(head, lambda h: (h != "") & F.contains(text, h)) | named

        hits = F.size(F.filter(F.transform(targets, hit), lambda h: h))
        return F.when(F.size(targets) == 0, F.lit(1.0)).otherwise(F.bround(hits / F.size(targets), 4))

    return bound(normalise(digest), share)
