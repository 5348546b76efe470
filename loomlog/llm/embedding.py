"""Embedding near-dedup: cross-polytope hashing after fast Hadamard rotations.

Exact copies collapse first. Every distinct vector goes to `probes` buckets in each of `tables`
hash tables; a bucket's code joins `width` cross-polytope hashes. Vectors that share a bucket are
compared by cosine in double precision, in bounded blocks. A pair counts only in the smallest
bucket code that both vectors have, so that counts and a spanning forest leave each block, not
pairs."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, components, forest, in_blocks, mix64, sorted_groups

BLOCK = 256


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows, whose length is a power of two, scaled to a rotation."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / np.sqrt(d)


def bucket_codes(x: np.ndarray, tables: int, width: int, probes: int, seed: int) -> np.ndarray:
    """(n, tables * probes) int64 codes, the table's number in the top bits, sorted in each row."""
    n, d = x.shape
    full = 1 << max(1, (d - 1).bit_length())
    x = np.pad(x / np.linalg.norm(x, axis=1, keepdims=True), ((0, 0), (0, full - d)))
    rng, out = np.random.default_rng(seed), []
    near = min(3, full)
    combos = np.array(list(product(range(near), repeat=width)))
    for t in range(tables):
        codes, gaps = [], []
        for _ in range(width):
            y = x
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], full))
            top = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :near]
            value = np.take_along_axis(y, top, 1)
            codes.append(top * 2 + (value > 0))
            gaps.append((np.abs(value[:, :1]) - np.abs(value)) ** 2)
        cost = sum(g[:, c] for g, c in zip(gaps, combos.T))
        code = np.zeros((n, len(combos)), np.uint64)
        for v, c in zip(codes, combos.T):
            code = mix64(code * np.uint64(2 * full + 1) + v[:, c].astype(np.uint64) + np.uint64(1))
        best = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        out.append((np.take_along_axis(code, best, 1) >> np.uint64(8) | np.uint64(t << 56)).astype(np.int64))
    return np.sort(np.concatenate(out, 1), axis=1)


def _pairs(codes: np.ndarray, x: np.ndarray, code: int, least: float, rest: np.ndarray) -> np.ndarray:
    """Symmetric matrix of the links that count in this bucket; rest: which block each row is of,
    where only pairs across blocks count unless there is one block."""
    near = x @ x.T >= least
    np.fill_diagonal(near, False)
    if len(set(rest.tolist())) > 1:
        near &= rest[:, None] != rest[None, :]
    i, j = np.nonzero(np.triu(near))
    for lo in range(0, len(i), 1 << 15):
        a, b = codes[i[lo : lo + (1 << 15)]], codes[j[lo : lo + (1 << 15)]]
        first = np.full(len(a), np.iinfo(np.int64).max)
        for c in range(b.shape[1]):
            hit = (a == b[:, c : c + 1]).any(1)
            first = np.where(hit, np.minimum(first, b[:, c]), first)
        drop = first != code
        p, q = i[lo : lo + (1 << 15)][drop], j[lo : lo + (1 << 15)][drop]
        near[p, q] = near[q, p] = False
    return near


def embedding_links(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    cosine: float = 0.98, tables: int = 4, width: int = 3, probes: int = 4, seed: int = 11,
) -> DataFrame:
    """One row for each vector: id_col, n_links (other vectors linked directly), component_id
    (smallest id reachable over links), kept (it names its component).

    Vectors link when their labels are equal and not null, their dimensions are equal and their
    cosine is at least `cosine`. Null vectors, zero vectors and those with null or non-finite
    components link with nothing, as do rows with a null label. Repeated rows are vectors of their
    own, so copies of one id link with each other. Equal vectors of a label are one class, known by
    the 64-bit hash of both. An empty table gives no rows; other columns are ignored, whatever their
    names; vectors of any length go."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "embedding")
    wide = vectors.schema[vector_col].dataType.elementType.simpleString()
    kind = "float" if wide == "float" else "double"
    dtype = np.float32 if kind == "float" else np.float64
    v = F.col(vector_col).cast(f"array<{kind}>")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), v.alias("v"))
    good = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists("v", lambda e: e != 0)
    rows = rows.withColumn("ok", F.coalesce(good & F.col("label").isNotNull(), F.lit(False)))
    classes = rows.where("ok").groupBy("label", "v").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
    classes = classes.withColumn("c", F.xxhash64("label", "v"))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(1)
            size, flat = np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(zero_copy_only=False).astype(dtype)
            first = np.concatenate([[0], np.cumsum(size)])
            packed, codes = [None] * len(size), [None] * len(size)
            for d in np.unique(size):
                at = np.flatnonzero(size == d)
                x = np.stack([flat[first[k] : first[k + 1]] for k in at])
                scaled = x.astype(np.float64) / np.abs(x).max(1, keepdims=True)
                for k, raw, own in zip(at, x, bucket_codes(scaled, tables, width, probes, seed)):
                    packed[k], codes[k] = raw.tobytes(), own
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary()), pa.array(codes, pa.list_(pa.int64()))], ["c", "raw", "codes"])

    coded = scratch.write(classes.select("c", "v", "label", "least", "n"), "classes")
    points = coded.select("c", "v").mapInArrow(code, "c long, raw binary, codes array<long>")
    points = scratch.write(points.join(coded.select("c", "label", "n"), "c").select("c", "label", F.col("n").alias("copies"), "raw", "codes"), "points")
    spots = points.select("c", F.explode(F.array_distinct("codes")).alias("code"), "label", F.length("raw").alias("size"))
    spots = spots.select("c", "code", F.xxhash64("label", "size", "code").alias("key"))
    full = scratch.write(spots.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "full")
    dealt = in_blocks(spots, full, "key", "c", BLOCK)
    dealt = dealt.join(points.select("c", "copies", "raw", "codes"), "c").select("key", "bi", "bj", "code", "_b", "c", "copies", "raw", "codes")
    dealt = dealt.repartition("key", "bi", "bj").sortWithinPartitions("key", "bi", "bj", "c")

    def compare(frames):
        import pandas as pd

        for f, cut in sorted_groups(frames, ["key", "bi", "bj"]):
            c, copies, block, bucket = (f[k].to_numpy() for k in ("c", "copies", "_b", "code"))
            sums, edges = [], []
            for lo, hi in zip(cut, cut[1:]):
                x = np.frombuffer(b"".join(f["raw"].iloc[lo:hi]), dtype).reshape(hi - lo, -1).astype(np.float64)
                x = x / np.abs(x).max(1, keepdims=True)
                x /= np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
                near = _pairs(np.stack(f["codes"].iloc[lo:hi]), x, bucket[lo], cosine, block[lo:hi])
                if near.any():
                    sums.append((c[lo:hi], near @ copies[lo:hi]))
                    root = forest(near)
                    tail = np.flatnonzero(root != np.arange(hi - lo))
                    edges.append((c[lo:hi][tail], c[lo:hi][root[tail]]))
            if sums:
                links = pd.DataFrame({"a": np.concatenate([a for a, _ in sums]), "b": np.concatenate([a for a, _ in sums]), "n": np.concatenate([n for _, n in sums])})
                yield links[links.n > 0]
                yield pd.DataFrame({"a": np.concatenate([a for a, _ in edges]), "b": np.concatenate([b for _, b in edges]), "n": 0})

    found = scratch.write(dealt.mapInPandas(compare, "a long, b long, n long"), "found")
    scratch.drop("full", "points")
    comp = components(spark, found.where("a <> b").select("a", "b")).select(F.col("node").alias("c"), "root")
    links = found.where("a = b").groupBy(F.col("a").alias("c")).agg(F.sum("n").alias("links"))
    named = coded.select("c", "least", "n").join(comp, "c", "left").join(links, "c", "left")
    named = named.withColumn("root", F.coalesce("root", "c")).withColumn("links", F.coalesce("links", F.lit(0)) + F.col("n") - 1)
    top = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(top, "root").select("c", "links", "component_id")
    rows = rows.withColumn("c", F.when(F.col("ok"), F.xxhash64("label", "v"))).select("id", "c")
    out = rows.join(named, "c", "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


#: DuckDB SQL of embedding_links() over embeddings: every pair of one label compared.
SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e) * list_dot_product(b.e, b.e)) >= 0.98
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a
)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, m AS component_id, vec_id = m AS kept
FROM embeddings JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) AS r ON vec_id = r.a LEFT JOIN (SELECT a, count(*) AS n FROM link GROUP BY a) AS l ON vec_id = l.a
"""
