"""Signs that a summary reproduces a template or its source instead of describing it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import LINE_BREAK, bound, plain_line

# Placeholders, template signatures, residue patterns, limits.
PLACEHOLDER = r"<[a-zA-Z][a-zA-Z0-9 _./-]{0,40}>"
SIGNATURES = [r"(?md)^\s*#{1,6}\s+Phase\s+\d", r"(?md)^\s*#{1,6}\s+Configuration\s*$", r"<specific step>", r"<Env vars", r"(?md)^\s*Base directory for this skill:"]
RESIDUE = [
    ("count_letter", r"\b(?:[NM]|XX)\b(?=\s+[A-Za-z])"),
    ("ratio", r"\b[NM]/[NM0-9]\b|\b\d+/[NM]\b"),
    ("date", r"\bYYYY(?:-MM(?:-(?:DD|XX))?)?\b|\b\d{4}-\d{2}-XX\b"),
]
LEAST_WORDS, OVERLAP_LINES, OVERLAP_LENGTH = 3, 3, 20
NOTATION = r"(?<!\w)(?<!\w\s)#[NM]\b|#[NM](?=\s*\(id\b)|\bid\s{1,8}\(?[NM]\b"


def is_scaffold(line: Column) -> Column:
    """A line with a placeholder and fewer than three words besides."""
    rest = F.regexp_replace(F.regexp_replace(line, PLACEHOLDER, " "), r"[*_`#>|\-]+", " ")
    return line.rlike(PLACEHOLDER) & (F.size(F.filter(F.split(rest, r"\s+"), lambda w: w.rlike(r"\w"))) < LEAST_WORDS)


def placeholder_token(text: Column) -> Column:
    return F.exists(F.split(text, "\n"), is_scaffold)


def excused(line: Column) -> Column:
    """A line as the residue rules read it: without ticket notation, inline code and the bare
    letters after a notation on that line."""
    plain = F.regexp_replace(line, r"`[^`\n]*`", " ")
    anchored = F.regexp_replace(plain, rf"((?:{NOTATION}).*?)\b[NM]\b(?=\s+[A-Za-z])", "$1 ")
    return F.regexp_replace(anchored, r"(?:#|\bid\s{1,8}\(?)[NM]\b(?:/[NM0-9]\b)?", " ")


def residue(text: Column) -> Column:
    """The rule of the earliest residue in a text, the longer of two at one place; null for none."""
    cleaned = F.array_join(F.transform(F.split(text, "\n"), excused), "\n")

    def hit(name: str, pattern: str) -> Column:
        at = F.regexp_instr(cleaned, F.lit(pattern))
        return F.when(at > 0, F.struct(at.alias("at"), (-F.length(F.regexp_substr(cleaned, F.lit(pattern)))).alias("n"), F.lit(name).alias("rule")))

    return F.array_min(F.array_compact(F.array(*[hit(*r) for r in RESIDUE])))["rule"]


def template_signature(text: Column) -> Column:
    out = F.lit(False)
    for pattern in SIGNATURES:
        out = out | text.rlike(pattern)
    return out


def overlap_keys(text: Column) -> Column:
    """Three consecutive lines of at least twenty characters each, as one key."""
    def threes(lines: Column) -> Column:
        n = F.size(lines)
        at = F.when(n >= OVERLAP_LINES, F.sequence(F.lit(1), F.greatest(n - OVERLAP_LINES + 1, F.lit(1)))).otherwise(F.array().cast("array<int>"))
        return F.transform(at, lambda k: F.array_join(F.slice(lines, k, OVERLAP_LINES), "\n"))

    return bound(F.filter(F.transform(F.split(text, "\n"), plain_line), lambda x: F.length(x) >= OVERLAP_LENGTH), threes)


def signal(text: Column, overlaps: Column | None = None) -> Column:
    """The first sign in fixed order, null for none."""
    out = (
        F.when(F.trim(F.coalesce(text, F.lit(""))) == "", "empty").when(placeholder_token(text), "placeholder_token")
        .when(residue(text).isNotNull(), "residue_token").when(template_signature(text), "template_signature")
    )
    return out if overlaps is None else out.when(overlaps, "verbatim_overlap")


def echo_form(line: Column) -> Column:
    """A line for comparison with its source: no emphasis, list number or end punctuation."""
    low = F.lower(F.regexp_replace(line, r"[*`]", ""))
    low = F.regexp_replace(F.trim(F.regexp_replace(low, r"\s+", " ")), r"^(?:\d+[.)]|[-*#]+)\s*", "")
    return F.regexp_replace(low, r"[\s.,;:!?]+$", "")


def echo_norm(text: Column) -> Column:
    """A text without emphasis, lower-cased, its white space as single spaces."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(text, r"[*`]+", "")), r"(?U)\s+", " "))


def echo_line(line: Column) -> Column:
    """A summary's line as it is looked for: no list sign, emphasis, number or end punctuation."""
    plain = F.trim(F.regexp_replace(plain_line(line), r"[*`]+", ""))
    return F.regexp_replace(F.regexp_replace(plain, r"^\d{1,3}[.)]\s+", ""), r"[.,;:!? ]+$", "")


def echoes_source(summary: Column, raw: Column) -> Column:
    """Whether a summary copies its source: three lines in a row that stand in it, or three such lines that
    are half of the lines without residue. Lines under 20 characters neither extend nor end a run; a
    line counts as written or as JSON escapes it."""
    def judged(corpus: Column, lines: Column) -> Column:
        def hit(line: Column) -> Column:
            n = echo_line(line)
            quoted = F.to_json(F.struct(n.alias("x")))
            return F.contains(corpus, echo_norm(n)) | F.contains(corpus, echo_norm(F.substring(quoted, F.lit(7), F.length(quoted) - 8)))

        def decide(marks: Column) -> Column:
            start = F.struct(F.lit(0).alias("run"), F.lit(0).alias("best"))
            longest = F.aggregate(marks, start, lambda a, m: bound(F.when(m["hit"], a["run"] + 1).otherwise(0), lambda r: F.struct(r.alias("run"), F.greatest(a["best"], r).alias("best"))), lambda a: a["best"])
            plain = F.filter(marks, lambda m: ~m["residue"])
            copied = F.size(F.filter(plain, lambda m: m["hit"]))
            return (longest >= OVERLAP_LINES) | ((copied >= OVERLAP_LINES) & (copied * 2 >= F.size(plain)))

        return bound(F.transform(lines, lambda x: F.struct(hit(x).alias("hit"), residue(x).isNotNull().alias("residue"))), decide)

    long = F.filter(F.split(summary, LINE_BREAK), lambda x: F.length(plain_line(x)) >= OVERLAP_LENGTH)
    return bound(echo_norm(F.regexp_replace(raw, r"\\[tnr]", " ")), lambda c: bound(long, lambda ls: judged(c, ls)))


def degrade(items: Column, asked: Column) -> Column:
    """Items without residue; null where the question holds residue, or more than half or all would
    go: then the whole is given up."""
    kept = F.filter(items, lambda i: residue(i).isNull())
    lost = F.size(items) - F.size(kept)
    return F.when(residue(asked).isNull() & (lost * 2 <= F.size(items)) & (F.size(kept) > 0), kept)


def fallback_note(raw: Column) -> Column:
    first = F.try_element_at(F.filter(F.split(raw, "\n"), lambda x: F.ltrim(x).startswith("[User]:")), F.lit(1))
    note = F.substring(F.trim(first), 1, 200)
    return F.when(signal(note).isNull(), note)
