"""SimHash near-dedup by deletion-variant signatures.

A 64-bit fingerprint is cut into d // 2 + 1 segments for a distance of d, so that of two linked
fingerprints one segment differs by at most one bit. Each segment is indexed once for each of its
bits as a wildcard; fingerprints that share a variant are compared in full. Only distinct
fingerprints are indexed, and dense variants are compared in bounded blocks that give a spanning
forest, not pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, blocks_of, checked, components, forest, in_blocks, sorted_groups, text_bytes, tidy
from .similar import similar_groups

BLOCK = 256
#: Fingerprints that a task expands into variants, and most tasks for it.
EXPANDED, MOST_TASKS = 20_000, 20_000


def _shingle_hashes(text: bytes, width: int, seed: int) -> list[int]:
    words = text.lower().split()  # bytes: A-Z only, split at \x20 and \x09-\x0D
    if not words:
        return []
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(b" ".join(words), seed)]
    joined = b" ".join(words)
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    start = [0, *(end[: -width] + 1).tolist()]
    h = xxhash.xxh64_intdigest
    return [h(joined[a:b], seed) for a, b in zip(start, end[width - 1 :].tolist())]


def _majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Fingerprint of each run of hashes; first: where each run begins, with the total at the end."""
    out = np.zeros(len(first) - 1, np.int64)
    n = np.diff(first)
    full = np.flatnonzero(n)
    if not len(full):
        return out
    count = np.zeros((len(full), 64), np.int64)
    for lo in range(0, len(full), 64):
        part = full[lo : lo + 64]
        a, b = first[part[0]], first[part[-1] + 1]
        bits = np.unpackbits(hashes[a:b].astype(">u8").view(np.uint8)).reshape(-1, 64)
        count[lo : lo + 64] = np.add.reduceat(bits, first[part] - a, axis=0, dtype=np.int64)
    out[full] = np.packbits(2 * count > n[full, None], axis=1).view(">u8")[:, 0].astype(np.uint64).view(np.int64)
    return out


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """(id, fp long): the bits set in over half of the XXH64 hashes of the text's word shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for lo, hi in blocks_of(texts, 1 << 20):
                each = [_shingle_hashes(t, width, seed) for t in texts[lo:hi]]
                first = np.concatenate([[0], np.cumsum([len(x) for x in each])])
                flat = np.fromiter((h for x in each for h in x), np.uint64, first[-1])
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array(_majority(flat, first))], ["id", "fp"])
        tidy()

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("t")).mapInArrow(run, f"id {id_type}, fp long")


def _segments(distance: int) -> list[tuple[int, int]]:
    """(shift, width) of the segments; any `distance` flips leave one with at most one flip."""
    n = distance // 2 + 1
    cut = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cut, cut[1:])]


def link_forest(spark: SparkSession, scratch: Scratch, fps: DataFrame, distance: int = 3) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) that span every link of at most
    `distance` differing bits."""
    parts = [(s, w, bit) for s, w in _segments(distance) for bit in range(w)]
    tasks = min(MOST_TASKS, -(-fps.count() // EXPANDED))
    if tasks > 1:  # a stored table of 8-byte rows has few splits, and each row becomes 64
        fps = fps.repartition(tasks, "fp")

    def variants(x: DataFrame) -> DataFrame:
        at = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(_signed(((1 << w) - 1 ^ (1 << b)) << s)).alias("m")) for i, (s, w, b) in enumerate(parts)]))
        x = x.select("fp", at.alias("p"))
        return x.select(F.xxhash64(F.col("fp").bitwiseAND(F.col("p.m")), F.col("p.i")).alias("key"), "fp")

    keys = variants(fps).groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1")
    keys = scratch.write(keys, "keys")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    pairs = keys.where("n = 2").where(near).select("a", "b")
    dense = keys.where("n > 2").select("key", "n")

    def run(frames):
        for x, cut in sorted_groups(frames, ["key", "bi", "bj"]):
            fp = x["fp"].to_numpy().view(np.uint64)
            for lo, hi in zip(cut, cut[1:]):
                own = np.unique(fp[lo:hi])
                root = forest(np.bitwise_count(own[:, None] ^ own[None, :]) <= distance)
                tail = np.flatnonzero(root != np.arange(len(own)))
                if len(tail):
                    import pandas as pd

                    yield pd.DataFrame({"a": own[tail].view(np.int64), "b": own[root[tail]].view(np.int64)})

    dealt = in_blocks(variants(fps), dense, "key", "fp", BLOCK).select("key", "bi", "bj", "fp")
    dealt = dealt.repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj")
    return pairs.unionByName(dealt.mapInPandas(run, "a long, b long")).distinct()


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def simhash_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 3, distance: int = 3) -> DataFrame:
    """One row for each document: id_col, fingerprint (16 hex digits), component_id (smallest id
    reachable over links of at most `distance` differing bits, itself included).

    A null or wordless text has fingerprint zero and links like any other; texts of fewer than
    `width` words are one shingle; texts are read whole; a null id takes part but never names a
    component (null if no other id is there); repeated rows each give a row, and rows that share an
    id are documents of their own; an empty table gives none; other columns are ignored, whatever
    their names."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "simhash")
    fp = scratch.write(fingerprints(docs, id_col=id_col, text_col=text_col, width=width), "fp")
    classes = scratch.write(fp.groupBy("fp").agg(F.min("id").alias("least")), "classes")
    edges = link_forest(spark, scratch, classes.select("fp"), distance)
    comp = components(spark, edges).select(F.col("node").alias("fp"), "root")
    scratch.drop("keys")
    joined = classes.join(comp, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    out = joined.join(named, "root").select("fp", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return fp.join(out, "fp").select(F.col("id").alias(id_col), digits.alias("fingerprint"), "component_id")


def simhash_dedup(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 3, distance: int = 3, similarity: float | None = None,
) -> DataFrame:
    """The rows of docs whose document names its component: one of each group stays. Rows with a
    null id stay. Columns are those of docs.

    Groups are those of fingerprints, or, where a similarity of 0.8 or more is given, of texts whose
    sets of five-word shingles are that similar. Texts of similarity 0.8 differ in some 10 of 64 bits,
    which deletion variants of selective segments miss, so candidates then come from bands of SimHash
    fingerprints of 512 bits, and every link is verified on the whole sets (similar.py)."""
    if similarity is None:
        groups = simhash_groups(docs, id_col=id_col, text_col=text_col, width=width, distance=distance)
    else:
        groups = similar_groups(docs, id_col=id_col, text_col=text_col, least=similarity)
    scratch = Scratch(docs.sparkSession, "simhash-gone")
    gone = groups.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("_gone")).distinct()
    gone = checked(scratch.write(gone, "ids"))
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
