"""Readers of transcripts, logs, ledgers and digest files, and their writers.

Files with a meaningful line order are read whole and split by position, so every line keeps its
number; a file is a few MB. Tables derived from them belong in Parquet."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomlog.functions.text import package_name, string_leaves

EVENT_LOG = """
schema_version int, session_id string, transcript_path string, project_dir string, agent string, cwd string, git_branch string, version string, entrypoint string, started_at string, ended_at string,
turns array<struct<turn_uuid:string,index:int,started_at:string,ended_at:string,user_text:string,queued_input:array<string>,assistant_text:array<string>,
  events:array<struct<seq:int,tool:string,kind:string,target:string,args_digest:string,ok:boolean,error:string,result_digest:string,result_chars:bigint,task_status:string>>,thinking_blocks:int>>,
subagents array<struct<turn_index:int,seq:int,subagent_type:string,description:string,background:boolean,agent_id:string,status:string,log_path:string,log_exists:boolean>>,
compactions array<struct<ts:string,turn_index:int,trigger:string,pre_tokens:bigint,post_tokens:bigint>>, background_pending array<string>,
stats struct<records:bigint,records_unparsable:bigint,turns:bigint,tool_events:bigint,raw_content_chars:bigint,extracted_chars:bigint,token_estimate:bigint,secrets_redacted:bigint,degradation_level:int>
"""
NEWEST_EVENT_LOG = 2
MANIFEST = ["path", "sha256", "agent", "date", "session_id", "turn_uuid", "provisional", "eventlog_path"]


def files(spark: SparkSession, glob: str, exclude: tuple[str, ...] = (), now: Column | None = None) -> DataFrame:
    """(path, size_bytes, mtime, idle_seconds) of the files of a glob, never of deeper folders;
    paths with an excluded component are left out."""
    df = spark.read.format("binaryFile").load(glob).select("path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("mtime"))
    if exclude:
        df = df.where(~F.exists(F.split("path", "/"), lambda p: p.isin(*exclude)))
    idle = F.unix_timestamp(F.current_timestamp() if now is None else now) - F.unix_timestamp("mtime")
    return df.dropDuplicates(["path"]).withColumn("idle_seconds", F.greatest(idle, F.lit(0)))


def lines(spark: SparkSession, glob: str) -> DataFrame:
    """(path, line_no from 1, raw) of non-blank lines."""
    df = spark.read.text(glob, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.posexplode(F.split("value", "\r\n|\n|\r")).alias("pos", "raw"))
    return df.select("path", (F.col("pos") + 1).cast("long").alias("line_no"), F.trim(F.make_valid_utf8("raw")).alias("raw")).where("raw <> ''")


def records(spark: SparkSession, glob: str) -> DataFrame:
    """Lines with v, the record as a variant, and parsed: whether it is a JSON object."""
    return with_variant(lines(spark, glob))


def with_variant(df: DataFrame, raw: str = "raw") -> DataFrame:
    v = F.try_parse_json(F.col(raw))
    return df.withColumn("v", v).withColumn("parsed", F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False)))


def event_logs(spark: SparkSession, glob: str, strict: bool = True) -> DataFrame:
    """Event logs by their schema; a log of a newer version is refused, an unreadable one too, or
    left out where strict is false."""
    df = spark.read.schema(EVENT_LOG).option("mode", "FAILFAST" if strict else "DROPMALFORMED").option("multiLine", True).json(glob)
    newer = F.col("schema_version") > NEWEST_EVENT_LOG
    if strict:
        return df.withColumn("schema_version", F.when(newer, F.raise_error(F.lit("event log of a newer schema")).cast("int")).otherwise(F.col("schema_version")))
    return df.where(~newer)


def manifest(spark: SparkSession, glob: str) -> DataFrame:
    """Manifest lines with their fields and reason, why a line is no record (null for a good one)."""
    df = records(spark, glob)
    fields = [F.when(F.schema_of_variant(F.try_variant_get("v", f"$.{f}", "variant")) == "STRING", F.try_variant_get("v", f"$.{f}", "string")).alias(f) for f in MANIFEST]
    df = df.select("line_no", "parsed", F.col("v").isNull().alias("broken"), *fields, F.try_variant_get("v", "$.superseded_by", "string").alias("superseded_by"))
    missing = F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in MANIFEST]))
    reason = F.when(F.col("broken"), "not JSON").when(~F.col("parsed"), "not an object").when(F.size(missing) > 0, F.concat(F.lit("missing or not text: "), F.array_join(missing, ", ")))
    return df.withColumn("reason", reason).drop("parsed", "broken")


def run_records(spark: SparkSession, glob: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Run records by schema, and (lines, bad_lines) of the file."""
    df = records(spark, glob)
    good = df.where("parsed").select(F.from_json("raw", schema).alias("r")).select("r.*")
    return good, df.agg(F.count(F.lit(1)).alias("lines"), F.count_if(~F.col("parsed")).alias("bad_lines"))


def digests(spark: SparkSession, root: str) -> DataFrame:
    """(file, agent, date, text) of digest files at any depth; text null where it is no UTF-8."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").load(root)
    raw = F.col("content").cast("string")
    parts = F.split("path", "/")
    return df.select(F.col("path").alias("file"), F.element_at(parts, -2).alias("agent"), F.regexp_replace(F.element_at(parts, -1), r"\.md$", "").alias("date"), F.when(F.is_valid_utf8(raw), raw).alias("text"))


def recent(df: DataFrame, limit: int = 2, name: str = "name") -> DataFrame:
    """The newest journals by name."""
    return df.where(F.col(name).rlike(r"^\d{4}-\d{2}-\d{2}\.md$")).orderBy(F.desc(name)).limit(limit)


def with_fallback(fresh: DataFrame, logs: DataFrame, key: str = "session_id") -> DataFrame:
    """Fresh extracts, and the kept log where a session has none; replayed says which."""
    old = logs.join(fresh.select(key), key, "left_anti").withColumn("replayed", F.lit(True))
    return fresh.withColumn("replayed", F.lit(False)).unionByName(old, allowMissingColumns=True)


def log_key(session: Column, path: Column) -> Column:
    return F.coalesce(F.nullif(session, F.lit("")), F.regexp_extract(path, r"([^/]+)\.[^./]+$", 1))


def append(df: DataFrame, path: str) -> None:
    """Appends to a ledger: manifest, run records, corrections or spend."""
    df.write.mode("append").json(path)


def overwrite(df: DataFrame, path: str, *partitions: str) -> None:
    """Replaces a table: it is written beside the old one, which moves away before the new one takes its
    place, so that a failed write leaves the old one whole, and a crash between the moves both. With
    partitions only those that df holds are replaced, each as its files are committed."""
    if partitions:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)
        return
    new, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(new)
    spark = df.sparkSession
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    had = fs.exists(fs_path(path))
    if had and not fs.rename(fs_path(path), fs_path(old)):
        raise OSError(f"cannot move {path} away")
    if not fs.rename(fs_path(new), fs_path(path)):
        raise OSError(f"{path} is now in {old}, its new content in {new}")
    if had:
        fs.delete(fs_path(old), True)


def backup(spark: SparkSession, path: str, root: str) -> str:
    """Copies a table's files into a fresh folder below root, never one that exists; its path."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    source = jvm.org.apache.hadoop.fs.Path(path)
    target = jvm.org.apache.hadoop.fs.Path(f"{root}/{spark.sql('select current_timestamp() t').first().t:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}")
    jvm.org.apache.hadoop.fs.FileUtil.copy(source.getFileSystem(conf), source, target.getFileSystem(conf), target, False, conf)
    return target.toString()


def event_log(logs: DataFrame, session: str) -> DataFrame:
    """The log of one session: an equality that reaches the scan of a table partitioned or sorted by it."""
    return logs.where(F.col("session_id") == session)


def flattened_digest(text: Column) -> Column:
    """A digest file as it is graded: a JSON object as its texts, one a line; anything else as it is."""
    return F.when(F.coalesce(F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT"), F.lit(False)), F.array_join(string_leaves(text), "\n")).otherwise(text)


def package_headers(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """(path, name, version) of package metadata files: header lines alone, up to the first empty one;
    names in their normal form. Files without both are left out."""
    head = F.split(F.regexp_replace(F.col(text), r"\r\n?", "\n"), r"\n\n")[0]
    x = files.select(path, package_name(F.trim(F.regexp_extract(head, r"(?im)^Name:(.*)$", 1))).alias("name"), F.trim(F.regexp_extract(head, r"(?im)^Version:(.*)$", 1)).alias("version"))
    return x.where("name <> '' AND version <> ''")


def contained(path: Column, root: str) -> Column:
    """Whether a path stays below a root once `.` and `..` are resolved; null for a null path."""
    parts = F.filter(F.split(path, "/"), lambda p: (p != "") & (p != "."))
    empty = F.array().cast("array<string>")
    kept = F.aggregate(parts, empty, lambda acc, p: F.when((p == "..") & (F.size(acc) > 0), F.slice(acc, F.lit(1), F.size(acc) - 1)).when(p == "..", acc).otherwise(F.array_append(acc, p)))
    return F.concat(F.lit("/"), F.array_join(kept, "/"), F.lit("/")).startswith(root.rstrip("/") + "/")


def presence(have: Column, error: Column) -> Column:
    """present, absent or unreadable: a source that could not be read is not one that is not there."""
    return F.when(error.isNotNull(), "unreadable").when(F.coalesce(have, F.lit(False)), "present").otherwise("absent")


def rebuilt_manifest(blocks: DataFrame) -> DataFrame:
    """The first block of each (path, turn_uuid), as manifest rows."""
    first = Window.partitionBy("path", "turn_uuid").orderBy("block_ord")
    return blocks.withColumn("_n", F.row_number().over(first)).where("_n = 1").select(*MANIFEST)
