"""Shared parts of the training-data operators: scratch tables, word hashing over whole Arrow
batches, sorted-group iteration and connected components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType

# --------------------------------------------------------------------------- scratch tables


def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share: spark.checkpoint.dir of the session, else the
    context's checkpoint folder. Where neither is set, a temporary one is made if everything runs in
    one process (tests); on a cluster that would be a folder of one machine, so it is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        have = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = have.get() if have.isDefined() else None
    if not found:
        if not spark.sparkContext._jsc.sc().isLocal():
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="loomlog-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


class Scratch:
    """Tables of one operator run under the shared folder; drop() as soon as one has been used. What
    a returned DataFrame still reads goes when the scratch_scope() around the operator ends."""

    open_scopes: list[list[Scratch]] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        if self.open_scopes:
            self.open_scopes[-1].append(self)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in names or ("",):
            p = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)
            p.getFileSystem(conf).delete(p, True)


@contextlib.contextmanager
def scratch_scope() -> Iterator[None]:
    """Drops the scratch tables of operators called inside, for callers that write results inside."""
    Scratch.open_scopes.append([])
    try:
        yield
    finally:
        for scratch in Scratch.open_scopes.pop():
            scratch.drop()


#: A side of a join is broadcast up to so many rows and bytes, else shuffled.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 32 << 20


def checked(side: DataFrame, rows: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> DataFrame:
    """The side of a join, which is a stored table, to be broadcast if it is small enough. Numbers
    count 8 bytes, texts and arrays of texts their own, and each row 16 more."""
    size = F.lit(16 + 8 * len(side.columns))
    for f in side.schema:
        if isinstance(f.dataType, (StringType, BinaryType)):
            size = size + F.coalesce(F.octet_length(side[f.name]), F.lit(0))
        elif isinstance(f.dataType, ArrayType):
            own = F.octet_length(F.array_join(side[f.name], "")) if isinstance(f.dataType.elementType, StringType) else F.lit(0)
            size = size + F.coalesce(own + 8 * F.size(side[f.name]), F.lit(0))
    n, total = side.agg(F.count(F.lit(1)), F.sum(size.cast("long"))).first()
    return F.broadcast(side) if n <= rows and (total or 0) <= most else side


def tidy() -> None:
    """Gives freed memory of a Python worker back, which allocators else keep until it ends."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of queries that have ended, which it does once the driver has
    collected their plans as garbage. Its listeners hold the last query that ended: an empty one."""
    spark.range(1).collect()
    gc.collect()
    spark._jvm.System.gc()


def crc_mod(col, m: int):
    """crc32 of the id's decimal text, modulo m (null for a null id)."""
    return F.crc32(col.cast("string").cast("binary")) % m


def text_bytes(col: str):
    return F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")


# --------------------------------------------------------------------------- bytes and words

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_CODE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix64(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(1, np.uint64)
    step = base & _MASK
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(step)])
        step = step * step & _MASK
    return out


class Powers:
    """Powers of the hash base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(0, np.uint64)

    def get(self, n: int):
        if len(self.up) < n:
            self.up, self.down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
        return self.up, self.down


def blocks_of(texts: list[bytes], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about limit bytes together, one text at least."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t) + 1
    if lo < len(texts):
        yield lo, len(texts)


def hash_words(texts: list[bytes], powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words [^\\x20\\x09-\\x0D]+ of the texts, A-Z lower-cased, in order, and
    the index of each text's first word (one entry more than texts)."""
    buf = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
    lens = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    at = np.concatenate([[0], np.cumsum(lens + 1)]) + 1
    space = _SPACE[buf]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    up, down = powers.get(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_CODE[_LOWER[buf]] * up[: len(buf)], out=total[1:])
    h = mix64((total[ends] - total[starts]) * down[starts])
    return h, np.searchsorted(starts, at)


# --------------------------------------------------------------------------- sorted groups


def sorted_groups(frames: Iterable, keys: list[str]) -> Iterator:
    """(frame, bounds) with whole groups of equal keys out of frames sorted by keys; the last group
    of a frame waits for the next one."""
    import pandas as pd

    rest = None
    for x in frames:
        x = x if rest is None else pd.concat([rest, x], ignore_index=True)
        if not len(x):
            continue
        new = np.zeros(len(x), bool)
        for k in keys:
            v = x[k].to_numpy()
            new[1:] |= v[1:] != v[:-1]
        cut = np.concatenate([[0], np.flatnonzero(new)])
        rest = x.iloc[cut[-1] :].reset_index(drop=True)
        if len(cut) > 1:
            yield x.iloc[: cut[-1]], cut
    if rest is not None and len(rest):
        yield rest, np.array([0, len(rest)])


def in_blocks(rows: DataFrame, sizes: DataFrame, key: str, member: str, block: int) -> DataFrame:
    """rows of the keys in sizes (key, n), dealt into pairs of blocks of about `block` members:
    every two members of a key meet in one (key, bi, bj), none of which outgrows two blocks."""
    nb = F.ceil(F.col("n") / F.lit(float(block))).cast("int")
    x = rows.join(checked(sizes.select(key, "n")), key).withColumn("_nb", nb)
    x = x.withColumn("_b", F.pmod(F.xxhash64(F.lit(7), F.col(member)), F.col("_nb")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_nb") - 1))
    x = x.withColumn("_o", other)
    return x.withColumn("bi", F.least("_b", "_o")).withColumn("bj", F.greatest("_b", "_o")).drop("_nb", "_o", "n")


def forest(adjacent: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each row of a symmetric boolean matrix."""
    n = len(adjacent)
    label = np.arange(n)
    adjacent = adjacent | np.eye(n, dtype=bool)
    while True:
        new = np.where(adjacent, label[None, :], n).min(1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


# --------------------------------------------------------------------------- components


def components(spark: SparkSession, edges: DataFrame, each: Callable | None = None) -> DataFrame:
    """(node, root): the smallest node reachable over edges (a, b), for every node in an edge.

    Alternating large-star and small-star steps (Kiveris et al., 2014): a node's smallest neighbour
    comes from a partial aggregate, never from a collected neighbour list, and hands over its
    neighbours by an equi-join that adaptive execution may split. Each round ends in a checkpoint in
    the shared folder, which cuts lineage and survives lost executors. Rounds grow as the logarithm
    of the longest path."""
    shared_dir(spark)
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().checkpoint()

    def mark(x):
        return x.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % (1 << 31))).first()

    before = mark(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        e = small.distinct().checkpoint()
        now = mark(e)
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
