"""Scalar text, time and number functions as column expressions."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

#: Everything str.splitlines() breaks at, as one pattern.
LINE_BREAK = "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def first_line(text: Column, limit: int = 300) -> Column:
    return F.substring(F.split(text, "\n")[0], 1, limit)


def normalise(text: Column) -> Column:
    """White space collapsed, trimmed and lower-cased."""
    return F.lower(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")))


def elide(text: Column, limit: int) -> Column:
    """The text, or its first `limit` characters and how many more there were."""
    more = F.length(text) - limit
    return F.when(more > 0, F.concat(F.substring(text, 1, limit), F.lit("…(+"), more.cast("string"), F.lit(" chars)"))).otherwise(text)


def escape_structure(text: Column) -> Column:
    """Lines that markdown would read as structure, escaped."""
    return F.regexp_replace(text, r"(?md)^([ \t]*)(#|<!--|={3,}[ \t]*$|-{3,}[ \t]*$)", r"$1\\$2")


def quote_lines(text: Column) -> Column:
    return F.array_join(F.transform(F.split(text, LINE_BREAK), lambda line: F.rtrim(F.concat(F.lit("> "), line))), "\n")


def bullet(text: Column) -> Column:
    return F.concat(F.lit("- "), F.trim(F.regexp_replace(text, r"(?U)\s+", " ")))


def plain_line(text: Column) -> Column:
    """A line without white space around it and list or heading signs before it."""
    return F.trim(F.regexp_replace(F.trim(text), r"^[-*# ]+", ""))


def segments(path: Column) -> Column:
    return F.filter(F.split(path, "/"), lambda s: s != "")


def home_swap(path: Column, home: str) -> Column:
    """~/x for home/x and the other way round; null for any other path."""
    return F.when(path.startswith("~/"), F.concat(F.lit(home), F.substring(path, 2, 1 << 30))).when(
        path.startswith(home + "/"), F.concat(F.lit("~"), F.substring(path, len(home) + 1, 1 << 30))
    )


def package_name(name: Column) -> Column:
    return F.lower(F.regexp_replace(name, "[-_.]+", "-"))


def mask_digits(text: Column) -> Column:
    return F.substring(F.regexp_replace(text, r"\d{5,}", "#"), 1, 16)


def instant(text: Column) -> Column:
    """ISO-8601 text as a UTC timestamp; null where it is none."""
    return F.try_to_timestamp(text)


def lag_seconds(now: Column, mtime_ns: Column) -> Column:
    return F.bround(F.unix_micros(now) / 1e6 - mtime_ns / 1e9, 1)


def expires(mtime: Column, days: int) -> Column:
    return F.date_add(F.to_date(mtime), days)


def token_estimate(chars: Column) -> Column:
    return F.floor((chars + 3) / 4).cast("long")


def ratio(part: Column, whole: Column, empty: float | None = None) -> Column:
    """part / whole to four places, half to even; `empty` where whole is 0."""
    out = F.bround(F.try_divide(part.cast("double"), whole.cast("double")), 4)
    return out if empty is None else F.coalesce(out, F.lit(empty))


def derived_cap(count: Column, headroom: float, floor: int) -> Column:
    return F.least(F.greatest(F.ceil(count * headroom).cast("long"), F.lit(floor).cast("long")), F.lit(10 * floor).cast("long"))


def lenient_int(text: Column) -> Column:
    """A whole number, or 0 for what is none; the words true and false are none."""
    return F.coalesce(F.when(F.lower(text).isin("true", "false"), F.lit(0)).otherwise(F.expr("null")), text.try_cast("long"), F.lit(0)).cast("long")


def safe_stem(session: Column, path: Column) -> Column:
    """The id where it is a bare identifier, else a digest of the path."""
    return F.when(session.rlike(r"^[A-Za-z0-9][A-Za-z0-9_-]{0,127}$"), session).otherwise(F.concat(F.lit("unidentified-"), F.substring(F.sha2(path, 256), 1, 16)))


def valid_name(name: Column) -> Column:
    return name.rlike(r"^[A-Za-z0-9._-]+$") & ~name.isin(".", "..")


def agent_of(cwd: Column) -> Column:
    """The last directory of a working directory, or `unknown` for one that is no valid name."""
    last = F.element_at(segments(cwd), -1)
    return F.when(valid_name(last), last).otherwise(F.lit("unknown"))


def spill(left: Column, cap: int) -> Column:
    """How many entries of an array stand beyond a cap."""
    return F.greatest(F.size(left) - cap, F.lit(0))


def json_body(text: Column) -> Column:
    """A JSON text without a fenced block's marks around it."""
    return F.regexp_replace(F.trim(text), r"(?s)^```(?:json)?\s*(.*?)\s*```$", "$1")


def fold(parts: list[Column], both) -> Column:
    return reduce(both, parts)


def bound(value: Column, use) -> Column:
    """use(value) with the value evaluated once, however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running_starts(sizes: Column) -> Column:
    """Where each of an array of sizes begins if they stand one behind the other. Sums run within
    chunks of about the root of the array's length and over the chunks, as appending copies."""
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))

    def sums(xs: Column) -> Column:
        return F.aggregate(xs, empty, lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.array_append(acc["out"], acc["at"]).alias("out")), lambda acc: acc["out"])

    def over(xs: Column) -> Column:
        width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(xs)))).cast("int")

        def cut(w: Column) -> Column:
            chunks = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(xs) - 1) / w).cast("int"))), lambda k: F.slice(xs, k * w + 1, w))
            return bound(chunks, lambda cs: F.flatten(F.zip_with(cs, sums(F.transform(cs, lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, n: a + n))), lambda c, at: F.transform(sums(c), lambda k: k + at))))

        return bound(width, cut)

    return bound(F.transform(sizes, lambda n: n.cast("long")), over)


def occurrences(needle: Column, text: Column) -> Column:
    """Where a literal stands in a text, from 0 on, one occurrence not overlapping the next."""
    literal = F.concat(F.lit("\\Q"), F.replace(needle, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))

    def places(cuts: Column) -> Column:
        between = F.slice(cuts, F.lit(1), F.size(cuts) - 1)
        return F.zip_with(running_starts(F.transform(between, lambda c: F.length(c) + F.length(needle))), between, lambda at, c: at + F.length(c))

    return F.when(F.length(needle) > 0, bound(F.split(text, literal, -1), lambda cuts: F.when(F.size(cuts) > 1, places(cuts)).otherwise(F.array().cast("array<bigint>"))))


def peel(text: Column) -> Column:
    """A value without matching quotes and edge backticks around it, layer by layer: the quotes and
    backticks at either end pair from the outside, and peeling ends where a pair does not match."""
    def bare(x: Column) -> Column:
        return F.regexp_replace(x, "^`+|`+$", "")

    ends = F.struct(F.regexp_extract(text, "^[\"'`]*", 0).alias("a"), F.reverse(F.regexp_extract(text, "[\"'`]*$", 0)).alias("z"))

    def cut(e: Column) -> Column:
        a, z = F.regexp_extract_all(e["a"], F.lit("[\"']`*"), F.lit(0)), F.regexp_extract_all(e["z"], F.lit("[\"']`*"), F.lit(0))
        pairs = F.zip_with(a, z, lambda p, q: F.struct(F.coalesce(F.substring(p, 1, 1) == F.substring(q, 1, 1), F.lit(False)).alias("ok"), F.length(p).alias("p"), F.length(q).alias("q")))
        first = F.length(F.regexp_extract(e["a"], "^`*", 0)), F.length(F.regexp_extract(e["z"], "^`*", 0))

        def apart(ps: Column) -> Column:
            n = F.array_position(F.transform(ps, lambda x: x["ok"]), F.lit(False))
            kept = F.when(n > 0, F.slice(ps, F.lit(1), (n - 1).cast("int"))).otherwise(ps)

            def of(name: str, lead: Column) -> Column:
                return lead + F.aggregate(kept, F.lit(0), lambda acc, x: acc + x[name])

            lo, hi = of("p", first[0]), of("q", first[1])
            return bare(F.substring(text, lo + 1, F.greatest(F.length(text) - lo - hi, F.lit(0))))

        return bound(pairs, apart)

    # nothing but quotes and backticks: both ends are one run
    inner = F.regexp_replace(text, "`", "")
    half = F.floor(F.length(inner) / 2).cast("int")

    def sides(half: Column) -> Column:
        same = F.zip_with(F.split(F.substring(inner, F.lit(1), half), ""), F.split(F.substring(F.reverse(inner), F.lit(1), half), ""), lambda p, q: p == q)
        return bound(F.array_position(same, F.lit(False)).cast("int"), lambda n: F.when(n > 0, n - 1).otherwise(half))

    middle = bound(bound(half, sides), lambda k: F.substring(inner, k + 1, F.length(inner) - 2 * k))
    return F.when(text.rlike("^[\"'`]*$"), middle).otherwise(bound(ends, cut))


def without_surrogates(raw: Column) -> Column:
    """A JSON text whose lone surrogate escapes are the replacement character's; pairs and escaped
    backslashes stay. Goes before parsing, as a parser turns them into question marks."""
    high, low = r"\\u[dD][89abAB][0-9a-fA-F]{2}", r"\\u[dD][c-fC-F][0-9a-fA-F]{2}"
    even = r"(?<!\\)((?:\\\\)*)"
    text = F.regexp_replace(raw, rf"{even}{high}(?!{low})", r"$1\\ufffd")
    return F.regexp_replace(text, rf"(?<!{high}){even}{low}", r"$1\\ufffd")


def session_when(started: Column, ended: Column, clock: Column) -> Column:
    """When a session was: its start, else its end, else the clock; unreadable times are none."""
    return F.coalesce(instant(started), instant(ended), clock)


def day(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def minute(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm")


def percent(rate: Column, places: int = 1) -> Column:
    """A rate as a percentage, n/a for none."""
    return F.coalesce(F.concat(F.format_number(F.bround(rate * 100, places), places), F.lit("%")), F.lit("n/a"))


def number_or_zero(value: Column) -> Column:
    """A JSON value (variant) as a number; 0 for texts, booleans and what else is none."""
    kind = F.schema_of_variant(value)
    return F.when(kind.isin("BIGINT", "DOUBLE") | kind.startswith("DECIMAL"), F.try_variant_get(value, "$", "double")).otherwise(0.0)


def whole_words(line: Column, start: Column, end: Column, width: int = 80) -> Column:
    """At most `width` characters of a line around [start, end), from 0 on, cut between words; the
    stretch itself where its own word is longer."""
    def window(lo: Column, hi: Column) -> Column:
        gap = F.instr(F.substring(line, lo + 1, F.length(line)), " ")  # to the first space from lo on
        left = F.when((lo > 0) & (F.substring(line, lo, F.lit(1)) != " "), F.when(gap == 0, F.length(line)).otherwise(lo + gap)).otherwise(lo)
        head = F.substring(line, F.lit(1), hi)
        back = F.length(head) - F.instr(F.reverse(head), " ")  # the last space before hi
        right = F.when((hi < F.length(line)) & (F.substring(line, hi + 1, F.lit(1)) != " "), F.when(F.contains(head, F.lit(" ")), back).otherwise(0)).otherwise(hi)
        own = F.substring(F.substring(line, start + 1, end - start), 1, width)
        return F.when((left > start) | (right < end), own).otherwise(F.trim(F.substring(line, left + 1, F.greatest(right - left, F.lit(0)))))

    lo = F.greatest(F.lit(0), F.floor((start + end) / 2).cast("int") - width // 2)
    hi = F.least(F.length(line), lo + width)
    return F.when(F.length(line) <= width, line).otherwise(window(F.greatest(F.lit(0), hi - width), hi))


@F.pandas_udf(ArrayType(StringType()))
def string_leaves(raw: pd.Series) -> pd.Series:
    """Every key and text of a JSON value, depth first; null for what is no JSON. The serialised text
    is never searched, as escapes would hide values. Recursion is what no built-in function has."""

    def leaves(x: object) -> Iterator[str]:
        todo = [x]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                yield x
            elif isinstance(x, dict):
                todo += [y for k, v in reversed(x.items()) for y in (v, k)]
            elif isinstance(x, list):
                todo += reversed(x)

    def read(text: str | None) -> list[str] | None:
        try:
            return list(leaves(json.loads(text))) if text is not None else None
        except ValueError:
            return None

    return raw.map(read)


def grounding_text(document: Column, *without: str) -> Column:
    """A document (struct) as the text that claims are grounded in: JSON without the named fields,
    lower-cased. Separators are those of Spark's own serialisation."""
    return F.lower(F.to_json(document.dropFields(*without) if without else document))


def caps_clause(caps: dict[str, int]) -> str:
    """The declared limits as prose, fields of one limit together, the smallest limit first."""
    groups: dict[int, list[str]] = {}
    for name, cap in caps.items():
        groups.setdefault(cap, []).append(name)
    return "; ".join(f"{cap} entries for " + (names[0] if len(names) == 1 else ", ".join(names[:-1]) + " and " + names[-1]) for cap, names in sorted(groups.items()))
