import collections
import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from loomlog.llm import lm
from loomlog.llm.common import crc_mod


def tokens(text):
    return (text or "").encode().lower().split() + [None]


def test_base_is_exact_and_model_beats_it(documents):
    rng = random.Random(4)
    phrase = ["the quick brown fox jumps", "over a lazy dog today", "while it rains outside Again", "é È ß ok"]
    rows = [(i, " ".join(rng.choice(phrase) for _ in range(rng.randint(0, 9)))) for i in range(160)] + [(500, None), (501, ""), (502, "neverseen words"), (502, "neverseen words"), (None, "x y")]
    got = lm.score_documents(documents(rows), crc_mod(F.col("doc_id"), 5) == 1).collect()
    assert len(got) == len(rows)
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows}
    count = collections.Counter(t for i, x in rows if not held[i] for t in tokens(x))
    total, distinct = sum(count.values()), len(count)
    text = dict(rows)
    for r in got:
        own = tokens(text[r.doc_id])
        base = sum(math.log10((count[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in own)
        assert r.held_out == held[r.doc_id] and r.train_tokens == total and r.n_tokens == len(own)
        assert r.n_known == sum(count[t] > 0 for t in own) and math.isclose(r.base_score, base, rel_tol=1e-9) and r.score <= 0
    out = [r for r in got if r.held_out and r.n_tokens > 5]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_empty_tables(documents):
    d = documents([(1, "a")])
    assert lm.score_documents(d.where("false"), F.lit(False)).count() == 0
    only = lm.score_documents(d, F.lit(True)).first()
    assert only.train_tokens == 0 and math.isclose(only.base_score, 2 * math.log10(0.5 / 0.5))


def test_filter_returns_quantised_counts():
    rng = np.random.default_rng(0)
    keys = rng.integers(1, 1 << 62, 5000, dtype=np.uint64)
    counts = rng.integers(2, 3000, 5000)
    where = lm.shard_of(keys, 7)
    f = lm.LogFrequencyFilter([lm.build_shard(keys[where == s], counts[where == s], 7) for s in range(7)])
    got = f.counts(keys)
    assert (got >= counts / lm.STEP).all() and np.mean(got <= counts * lm.STEP) > 0.999
    assert np.mean(f.counts(rng.integers(1, 1 << 62, 5000, dtype=np.uint64)) > 0) < 0.01


def test_packing_round_trips():
    x = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 999, dtype=np.uint64))
    assert (lm.unpack_sorted(lm.pack_sorted(x)) == x).all()
    assert (lm.unpack_planes(lm.pack_planes(x), np.uint64) == x).all()


def test_filter_grows_with_its_entries():
    keys = np.random.default_rng(3).integers(1, 1 << 62, 40000, dtype=np.uint64)
    shards = 1 << 16  # as many as a corpus of 800 GB asks
    f = lm.LogFrequencyFilter([lm.build_shard(keys[:20000], np.full(20000, 2), shards)])
    assert 8 * len(f.table) >= lm.BITS * 20000
    assert (f.counts(keys[:20000]) >= 2 / lm.STEP).all() and np.mean(f.counts(keys[20000:]) > 0) < 0.01


def test_scores_equal_brute_force(documents):
    rng = random.Random(8)
    word = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(word) for _ in range(rng.randint(0, 30)))) for i in range(60)] + [(100, "rare words meet once"), (101, "rare words meet once"), (102, None)]
    got = lm.score_documents(documents(rows), F.col("doc_id") % 3 == 2, bucket_mb=0.0001).collect()
    taught = [[0, *tokens(x)] for i, x in rows if i % 3 != 2]
    count = collections.Counter(t for own in taught for t in own)
    pair = collections.Counter(p for own in taught for p in zip(own, own[1:]))
    level = lambda n: 1 + math.floor(math.log(n) / math.log(lm.STEP) + 1e-9)
    held = {p: lm.STEP ** (level(n) - 1) * (1 + lm.STEP) / 2 for p, n in pair.items()}  # what the filter returns
    mass, types = collections.Counter(), collections.Counter()
    for (a, _), n in held.items():
        mass[a] += n
        types[a] += 1
    total, distinct = sum(count.values()) - count[0], len(count) - 1

    def p(a, t):
        base = (count[t] + 0.5) / (total + 0.5 * (distinct + 1))
        return base if not mass[a] else lm.DISCOUNT * types[a] / mass[a] * base + max(held.get((a, t), 0) - lm.DISCOUNT, 0) / mass[a]

    words = [t for t in count if t != 0] + ["unknown"]
    assert all(math.isclose(sum(p(a, t) for t in words), 1.0, rel_tol=1e-9) for a in [0, "w1", "rare", "nowhere"])
    assert 1 in pair.values() and len(got) == len(rows)
    text = dict(rows)
    for r in got:
        own = [0, *tokens(text[r.doc_id])]
        assert math.isclose(r.score, sum(math.log10(p(a, t)) for a, t in zip(own, own[1:])), rel_tol=1e-6)


def test_a_full_filter_ends_its_lookups():
    f = lm.LogFrequencyFilter([b"\xff" * 32])
    assert (f.levels(np.arange(5, dtype=np.uint64)) == lm.TOP).all()


def test_very_long_texts(documents):
    rows = [(1, "long words " * 200_000), (2, "long words"), (3, " ")]
    got = {r.doc_id: r for r in lm.score_documents(documents(rows), F.col("doc_id") == 2, bucket_mb=0.5).collect()}
    assert got[1].n_tokens == 400_001 and got[2].n_known == 3 and got[3].n_tokens == 1 and all(math.isfinite(r.score) for r in got.values())
