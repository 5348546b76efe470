"""Blocks of digest files: pairing of anchors and ends, markers, previews, frontmatter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ANCHOR = r"^<!-- block session=(\S*) turn=(\S+) transcript=(\S*)(?: provisional=(\S+))? -->$"
FINISH = r"^<!-- /block turn=(\S+) -->$"


def anchor(session: Column, turn: Column, transcript: Column, provisional: Column) -> Column:
    kind = F.when(provisional != "", F.concat(F.lit(" provisional="), provisional)).otherwise("")
    return F.concat(F.lit("<!-- block session="), session, F.lit(" turn="), turn, F.lit(" transcript="), transcript, kind, F.lit(" -->"))


def compose(session: Column, turn: Column, transcript: Column, provisional: Column, body: Column) -> Column:
    return F.concat_ws("\n", anchor(session, turn, transcript, provisional), body, F.concat(F.lit("<!-- /block turn="), turn, F.lit(" -->")))


def blocks(files: DataFrame, file: str = "file", text: str = "text") -> DataFrame:
    """Complete blocks (file, block_ord, session_id, turn_uuid, transcript_path, provisional, body,
    sha256): an anchor with the first end of its turn before the next anchor; torn ones are left out."""
    x = files.select(file, F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    w = Window.partitionBy(file).orderBy("pos")
    x = x.withColumn("is_anchor", F.col("line").rlike(ANCHOR)).withColumn("end_of", F.nullif(F.regexp_extract("line", FINISH, 1), F.lit("")))
    x = x.withColumn("block_ord", F.sum(F.col("is_anchor").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1).where("block_ord >= 0")
    own = Window.partitionBy(file, "block_ord")
    x = x.withColumn("head", F.first("line").over(own.orderBy("pos"))).withColumn("turn_uuid", F.regexp_extract("head", ANCHOR, 2))
    x = x.withColumn("stop", F.min(F.when(F.col("end_of") == F.col("turn_uuid"), F.col("pos"))).over(own)).where("stop is not null and pos <= stop")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~F.col("is_anchor") & (F.col("pos") < F.col("stop")), F.struct("pos", "line")))), lambda p: p["line"]), "\n")
    x = x.groupBy(file, "block_ord", "head", "turn_uuid").agg(body.alias("body"))
    return x.select(
        file, "block_ord", F.regexp_extract("head", ANCHOR, 1).alias("session_id"), "turn_uuid", F.regexp_extract("head", ANCHOR, 3).alias("transcript_path"),
        F.regexp_extract("head", ANCHOR, 4).alias("provisional"), "body", F.sha2("body", 256).alias("sha256"),
    )


def torn(files: DataFrame, found: DataFrame, file: str = "file", text: str = "text") -> DataFrame:
    """How many anchors of each file have no end."""
    n = files.select(file, F.size(F.filter(F.split(text, "\n"), lambda x: x.rlike(ANCHOR))).alias("anchors"))
    return n.join(found.groupBy(file).agg(F.count(F.lit(1)).alias("pairs")), file, "left").select(file, (F.col("anchors") - F.coalesce("pairs", F.lit(0))).alias("torn"))


def stand_ins(found: DataFrame, placeholder: str, suppression: str) -> DataFrame:
    kind = F.when(F.contains("body", F.lit(placeholder)), "placeholder").when(F.contains("body", F.lit(suppression)), "suppressed")
    return found.withColumn("kind", kind).where("kind is not null")


def without_markers(text: Column) -> Column:
    """A block's text as it is graded: no anchors, ends, notes or verbatim regions."""
    text = F.regexp_replace(text, r"(?s)<!-- verbatim -->.*?<!-- /verbatim -->", " ")
    return F.regexp_replace(F.regexp_replace(text, r"<!--[^\n]*?-->", " "), r"(?m)^_\d+ more not shown\._$", " ")


def frontmatter(ids: Column) -> Column:
    return F.concat(F.lit("---\nsessions: ["), F.array_join(F.array_distinct(ids), ", "), F.lit("]\n---\n"))


def strip_frontmatter(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\A---\nsessions: \[[^\n]*\]\n---\n", "")


def apply_frontmatter(text: Column, ids: Column) -> Column:
    """A text with its sessions in front: its own older list gives way, and a text that begins with any
    other front matter stays as it is."""
    foreign = text.startswith("---\n") & ~text.rlike(r"\A---\nsessions: \[[^\n]*\]\n---\n")
    return F.when(foreign, text).otherwise(F.concat(frontmatter(ids), strip_frontmatter(text)))


def records(found: DataFrame, file: str = "file") -> DataFrame:
    """Manifest rows of blocks: the agent is the file's folder, the date its name; no log path is empty."""
    parts = F.split(F.col(file), "/")
    log = F.coalesce(F.col("eventlog_path"), F.lit("")) if "eventlog_path" in found.columns else F.lit("")
    return found.select(F.col(file).alias("path"), "sha256", F.element_at(parts, -2).alias("agent"), F.regexp_replace(F.element_at(parts, -1), r"\.md$", "").alias("date"), "session_id", "turn_uuid", "provisional", log.alias("eventlog_path"))


def tombstones(gone: DataFrame, by: str) -> DataFrame:
    """Manifest lines that say by which block others were superseded."""
    return gone.select("path", "session_id", "turn_uuid", F.lit("").alias("sha256"), F.col(by).alias("superseded_by"))


def correction_scan(files: DataFrame, logs: DataFrame, file: str = "file", text: str = "text") -> DataFrame:
    """One row of what a correction would look at: files that are no UTF-8 (null text), torn blocks, blocks
    that are provisional, without a log or with one that cannot be read (parsed), and those left to grade."""
    good = files.where(F.col(text).isNotNull())
    found = blocks(good, file, text)
    broken = torn(good, found, file, text).agg(F.coalesce(F.sum("torn"), F.lit(0)).cast("long").alias("torn"))
    x = found.join(logs.select("session_id", "parsed", F.lit(True).alias("_log")), "session_id", "left")
    final = F.col("provisional") == ""
    n = x.agg(
        F.count_if(~final).alias("provisional"), F.count_if(final & F.col("_log").isNull()).alias("no_log"), F.count_if(final & F.col("_log").isNotNull() & ~F.coalesce("parsed", F.lit(False))).alias("bad_log"),
        F.count_if(final & F.coalesce("parsed", F.lit(False))).alias("to_grade"),
    )
    return files.agg(F.count_if(F.col(text).isNull()).alias("undecodable")).join(broken).join(n)  # one row each


def preview(lines: DataFrame, doc: str, order: str, line: str, last: int) -> DataFrame:
    """The last lines of each document's sections that hold a bullet: headings and bullets alone;
    lines before the first heading are a section of their own."""
    x = lines.where(F.col(line).rlike(r"^(##|- )"))
    w = Window.partitionBy(doc).orderBy(order)
    x = x.withColumn("_s", F.sum(F.col(line).rlike(r"^## ").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    x = x.withColumn("_b", F.max(F.col(line).startswith("- ")).over(Window.partitionBy(doc, "_s"))).where("_b")
    return x.withColumn("_n", F.row_number().over(Window.partitionBy(doc).orderBy(F.desc(order)))).where(F.col("_n") <= last).drop("_s", "_b", "_n")


def islands(df: DataFrame, doc: str, order: str, hit: Column, least: int) -> DataFrame:
    """Runs of consecutive hits of at least `least` rows: (doc, first, last, n)."""
    w = Window.partitionBy(doc).orderBy(order)
    x = df.withColumn("_g", F.sum((~hit).cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0))).where(hit)
    x = x.groupBy(doc, "_g").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("n"))
    return x.where(F.col("n") >= least).drop("_g")


def edits(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """(key, line, before, after) of lines that a rewrite changed; it keeps the number of lines."""
    def numbered(df: DataFrame, name: str) -> DataFrame:
        return df.select(key, F.posexplode(F.split("body", "\n")).alias("line", name))

    return numbered(before, "before").join(numbered(after, "after"), [key, "line"]).where("before <> after").withColumn("line", F.col("line") + 1)
