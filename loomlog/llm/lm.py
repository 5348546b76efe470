"""Language-model scoring with a log-frequency Bloom filter.

Documents fall into buckets of a few MB. A bucket sends its distinct word hashes and bigram keys,
with their counts in training documents, as packed sorted arrays to partitions of the hash space,
which add them up over the corpus. Word counts come back to the buckets that asked, in the order of
the request, so that the unigram base is exact. All bigrams seen in training go into a filter that
holds quantised log counts: a key of level j is entered j times, as (key, 1) to (key, j), and a
lookup probes one level after another until one misses. Each partition has the filter of its own
keys, as large as its entries ask, and answers the buckets' probes of them; nothing is broadcast. A
bigram's probability is its discounted share of what the filter holds of its context, plus the
unigram base at the weight that the discounts leave: over all words and one unknown they add up to 1,
but for keys that the filter finds though they were never entered."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Powers, Scratch, blocks_of, hash_words, mix64, text_bytes, tidy

#: MB of text in a bucket; training tokens in a partition of the hash space; fewest of either.
BUCKET_MB, PART_TOKENS, FEWEST = 8, 2_000_000, 48
#: Most partitions of the hash space: a bucket's array for each of them keeps some ten keys at any size.
MOST_PARTS = 1 << 17
#: Bits for each entry of the filter, its hashes and the log base.
BITS, HASHES, STEP = 20, 6, 1.5
#: The level of the largest count that a shard adds up to; no lookup goes beyond it.
TOP = 1 + int(math.log(1 << 40) / math.log(STEP))
DISCOUNT = 0.75
END, START = np.uint64(0x3C6EF372FE94F82B), np.uint64(0xA54FF53A5F1D36F1)
_CONTEXT = np.uint64(0x510E527FADE682D1)


# --------------------------------------------------------------------------- packed arrays


def pack_planes(x: np.ndarray) -> bytes:
    """Bytes of unsigned words, all lowest bytes first, so that rare high bytes compress away."""
    return x.view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def unpack_planes(b: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(b, np.uint8).reshape(size, -1).T.copy().view(kind).reshape(-1)


def pack_sorted(x: np.ndarray) -> bytes:
    return pack_planes(np.diff(x, prepend=np.uint64(0)))


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unpack_planes(b, np.uint64), dtype=np.uint64)


def by_part(keys: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Order that puts sorted keys together by part, and (part, from, to)."""
    order = np.argsort(part, kind="stable")
    cut = np.flatnonzero(np.diff(part[order], prepend=-1))
    ends = [*cut[1:].tolist(), len(order)]
    return order, [(int(part[order[a]]), a, b) for a, b in zip(cut.tolist(), ends)]


# --------------------------------------------------------------------------- the filter


def level_of(count: np.ndarray) -> np.ndarray:
    """Levels from 1 on of counts of at least 1."""
    return 1 + np.floor(np.log(np.maximum(count, 1.0)) / math.log(STEP) + 1e-9).astype(np.int64)


def count_of(level: np.ndarray) -> np.ndarray:
    """The middle of a level's counts; 0 for level 0."""
    return np.where(level > 0, STEP ** (level - 1.0) * (1 + STEP) / 2, 0.0)


def _bits_of(keys: np.ndarray, level: int, bits: int | np.ndarray) -> Iterator[np.ndarray]:
    h = mix64(keys + np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64)))
    step = mix64(h) | np.uint64(1)
    for _ in range(HASHES):
        yield (h >> np.uint64(32)) * bits >> np.uint64(32)
        h = h + step


def build_shard(keys: np.ndarray, counts: np.ndarray, shards: int = 1) -> bytes:
    """The bits of the keys' levels; BITS for each entry, however many shards there are."""
    level = level_of(counts)
    bits = max(64, BITS * int(level.sum()))
    bits += -bits % 8
    if bits > 1 << 32:  # partitions grow in number, not in size
        raise ValueError("a shard's hashes address 2^32 bits")
    table = np.zeros(bits // 8, np.uint8)
    for j in range(1, int(level.max(initial=0)) + 1):
        for at in _bits_of(keys[level >= j], j, np.uint64(bits)):
            np.bitwise_or.at(table, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
    return table.tobytes()


class LogFrequencyFilter:
    """Shards of bits by the top of the mixed key."""

    def __init__(self, shards: list[bytes]):
        size = np.array([len(s) for s in shards], np.int64)
        self.first, self.bits = np.cumsum(size) - size, (size * 8).astype(np.uint64)
        self.table = np.frombuffer(b"".join(shards), np.uint8)

    def levels(self, keys: np.ndarray) -> np.ndarray:
        level = np.zeros(len(keys), np.int64)
        left, j = np.arange(len(keys)), 1
        shard = shard_of(keys, len(self.bits))
        while len(left) and j <= TOP:
            own = shard[left]
            first, bits = self.first[own], self.bits[own]
            h = mix64(keys[left] + np.uint64(j * 0x9E3779B97F4A7C15 % (1 << 64)))
            step = None
            for _ in range(HASHES):  # most keys miss at the first probe
                at = (h >> np.uint64(32)) * bits >> np.uint64(32)
                byte = self.table[np.minimum(first + (at >> np.uint64(3)).astype(np.int64), len(self.table) - 1)] if len(self.table) else np.zeros(len(at), np.uint8)
                hit = np.flatnonzero((byte >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool) & (bits > 0))
                left, first, bits, h = left[hit], first[hit], bits[hit], h[hit]
                step = mix64(h) | np.uint64(1) if step is None else step[hit]
                h = h + step
            level[left] = j
            j += 1
        return level

    def counts(self, keys: np.ndarray) -> np.ndarray:
        return count_of(self.levels(keys))


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((mix64(keys) >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def context_keys(x: np.ndarray) -> np.ndarray:
    """Keys of the contexts that words or bigram keys begin with; a word's counts and its mass as a
    context meet in the partition of this key."""
    return x & ~np.uint64(0xFFFFFFFF) | _CONTEXT >> np.uint64(32)


# --------------------------------------------------------------------------- buckets


def bucket_tokens(texts: list[bytes], powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of the texts, an end token after each, and where each text begins."""
    out, sizes = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for lo, hi in blocks_of(texts):
        h, first = hash_words(texts[lo:hi], powers)
        out.append(np.insert(h, first[1:], END))
        sizes.append(np.diff(first) + 1)
    return np.concatenate(out), np.cumsum(np.concatenate(sizes))


def bigram_keys(tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys (context in the top half, token in the lower) and the contexts' hashes."""
    context = np.empty_like(tokens)
    context[1:] = tokens[:-1]
    context[first[:-1]] = START
    return context & ~np.uint64(0xFFFFFFFF) | tokens >> np.uint64(32), context


def score_documents(
    docs: DataFrame, held_out, *, id_col: str = "doc_id", text_col: str = "text", discount: float = DISCOUNT, bucket_mb: float = BUCKET_MB,
) -> DataFrame:
    """(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document.

    Learns from documents whose held_out column is false. A null text is empty: its end token alone.
    Repeated rows are documents of their own. Without training tokens, base and score are those of
    an empty vocabulary. An empty table gives no rows; other columns are ignored.

    Words and bigrams are known by 64-bit hashes. The model's bigrams are all those seen in
    training; their filter has BITS for each entry at any size. What the filter holds of each context
    is added up exactly. Texts are scored whole; a bucket holds one text at least."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "lm")
    held = F.coalesce(held_out, F.lit(False))
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string"))).alias("b")).first()["b"] or 0
    buckets = max(FEWEST, math.ceil(size / (bucket_mb * 1e6)))
    parts = min(MOST_PARTS, max(FEWEST, math.ceil(size / (6.0 * PART_TOKENS))))
    rows = docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("t"), held.alias("held"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("id", "t"), F.lit(buckets)).cast("int")).select("bucket", "id", "held", "t")

    def send(pdf: pd.DataFrame) -> pd.DataFrame:
        texts, train = pdf["t"].tolist(), ~pdf["held"].to_numpy(bool)
        tokens, first = bucket_tokens(texts, Powers())
        taught = np.repeat(train, np.diff(first))
        words, back = np.unique(np.append(tokens, START), return_inverse=True)
        counts = np.bincount(back[:-1][taught], minlength=len(words)).astype(np.uint32)
        keys, back = np.unique(bigram_keys(tokens, first)[0], return_inverse=True)
        times = np.bincount(back[taught], minlength=len(keys)).astype(np.uint32)
        out = []
        for kind, x, own, n in (("u", words, context_keys(words), counts), ("b", keys, keys, times)):
            order, cuts = by_part(x, shard_of(own, parts))
            out += [(p, kind, int(pdf["bucket"].iloc[0]), pack_sorted(x[order[a:b]]), pack_planes(n[order[a:b]])) for p, a, b in cuts]
        return pd.DataFrame(out, columns=["p", "kind", "bucket", "a", "b"])

    def add_up(pdf: pd.DataFrame) -> pd.DataFrame:
        out, p = [], int(pdf["p"].iloc[0])
        for kind, own in pdf.groupby("kind"):
            keys = [unpack_sorted(a) for a in own["a"]]
            counts = np.concatenate([unpack_planes(b, np.uint32) for b in own["b"]]).astype(np.int64)
            distinct, back = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(back, counts, len(distinct)).astype(np.int64)
            if kind == "u":
                out.append(("stats", p, -1, b"", int(total.sum()), int((total > 0).sum())))
                out += [("asked", p, int(bucket), a, 0, 0) for bucket, a in zip(own["bucket"], own["a"])]
                answer = np.minimum(total, (1 << 40) - 1).astype(np.uint64)
            else:
                entered = total > 0
                held, total = distinct[entered], total[entered]
                answer = LogFrequencyFilter([build_shard(held, total)]).levels(distinct).astype(np.uint8)
                quantised = count_of(answer[entered].astype(np.int64))
                context = context_keys(held)
                cut = np.flatnonzero(np.diff(context, prepend=~context[:1])) if len(held) else np.zeros(0, np.int64)
                if len(cut):
                    mass = np.add.reduceat(quantised, cut).astype(np.float32)
                    types = np.diff(np.append(cut, len(context))).astype(np.float32)
                    order, cuts = by_part(context[cut], shard_of(context[cut], parts))
                    out += [("mass", q, -1, pack_sorted(context[cut][order[a:b]]) + mass[order[a:b]].tobytes() + types[order[a:b]].tobytes(), b - a, 0) for q, a, b in cuts]
            at = 0
            for bucket, k in zip(own["bucket"], keys):
                out.append(("counts" if kind == "u" else "levels", p, int(bucket), pack_planes(answer[back[at : at + len(k)]]), 0, 0))
                at += len(k)
        tidy()
        return pd.DataFrame(out, columns=["kind", "p", "bucket", "a", "n", "m"])

    sent = rows.groupBy("bucket").applyInPandas(send, "p int, kind string, bucket int, a binary, b binary")
    added = scratch.write(sent.groupBy("p").applyInPandas(add_up, "kind string, p int, bucket int, a binary, n long, m long"), "added")
    stats = added.where("kind = 'stats'").agg(F.sum("n").alias("n"), F.sum("m").alias("v")).first()
    total, distinct = stats["n"] or 0, stats["v"] or 0

    def add_mass(pdf: pd.DataFrame) -> pd.DataFrame:
        given, asked = pdf[pdf["kind"] == "mass"], pdf[pdf["kind"] == "asked"]
        keys = np.concatenate([np.zeros(0, np.uint64), *[unpack_sorted(a[: 8 * n]) for a, n in zip(given["a"], given["n"])]])
        sums = np.concatenate([np.zeros((2, 0), np.float32), *[np.frombuffer(a[8 * n :], np.float32).reshape(2, -1) for a, n in zip(given["a"], given["n"])]], axis=1)
        keys, back = np.unique(keys, return_inverse=True)
        sums = [np.append(np.bincount(back, x, len(keys)), 0.0).astype(np.float32) for x in sums]
        out = []
        for bucket, a in zip(asked["bucket"], asked["a"]):
            own = context_keys(unpack_sorted(a))
            at = np.searchsorted(keys, own)
            at[np.append(keys, np.uint64(0))[at] != own] = len(keys)
            out += [(kind, int(pdf["p"].iloc[0]), bucket, pack_planes(x[at])) for kind, x in zip(("masses", "types"), sums)]
        tidy()
        return pd.DataFrame(out, columns=["kind", "p", "bucket", "a"])

    masses = added.where("kind IN ('mass', 'asked')").select("kind", "p", "bucket", "a", "n").groupBy("p").applyInPandas(add_mass, "kind string, p int, bucket int, a binary")

    def score(key, pdf: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return pd.DataFrame(columns=["id", "held", "n_tokens", "n_known", "base", "score"])
        tokens, first = bucket_tokens(pdf["t"].tolist(), Powers())
        words, back = np.unique(np.append(tokens, START), return_inverse=True)
        back, start = back[:-1], back[-1]
        keys, where = np.unique(bigram_keys(tokens, first)[0], return_inverse=True)
        answers = {(kind, p): a for kind, p, a in zip(found["kind"], found["p"], found["a"])}
        counts, mass, types, level = np.zeros(len(words), np.int64), np.zeros(len(words)), np.zeros(len(words)), np.zeros(len(keys), np.int64)
        above = context_keys(words)
        for into, name, own, kind in ((counts, "counts", above, np.uint64), (mass, "masses", above, np.float32), (types, "types", above, np.float32), (level, "levels", keys, np.uint8)):
            order, cuts = by_part(own, shard_of(own, parts))
            for p, a, b in cuts:
                into[order[a:b]] = unpack_planes(answers[name, p], kind)
        c = counts[back]
        base = (c + 0.5) / (total + 0.5 * (distinct + 1))
        around = np.empty_like(back)
        around[1:] = back[:-1]
        around[first[:-1]] = start
        mass, types = mass[around], types[around]
        able = mass > 0  # the context was seen in training
        p = np.where(able, discount * types / np.where(able, mass, 1.0), 1.0) * base
        seen = np.flatnonzero((c > 0) & able)
        p[seen] += np.maximum(count_of(level[where[seen]]) - discount, 0) / mass[seen]
        n = np.diff(first)
        known = np.add.reduceat((c > 0).astype(np.int64), first[:-1])
        tidy()
        return pd.DataFrame({"id": pdf["id"], "held": pdf["held"], "n_tokens": n, "n_known": known, "base": np.add.reduceat(np.log10(base), first[:-1]), "score": np.add.reduceat(np.log10(p), first[:-1])})

    id_type = docs.schema[id_col].dataType.simpleString()
    asked = added.where("kind IN ('counts', 'levels')").select("kind", "p", "bucket", "a").unionByName(masses)
    out = rows.groupBy("bucket").cogroup(asked.groupBy("bucket")).applyInPandas(score, f"id {id_type}, held boolean, n_tokens long, n_known long, base double, score double")
    return out.select(F.col("id").alias(id_col), F.col("held").alias("held_out"), "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")
