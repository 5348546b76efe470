import random

import numpy as np
import xxhash

from loomlog.llm import simhash
from loomlog.llm.common import Scratch, components, forest


def brute_print(text):
    w = (text or "").encode().lower().split()
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def test_groups_equal_brute_force(documents):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdef") for _ in range(6)) for _ in range(300)]
    rows = []
    for i in range(120):
        w = base[(i % 15) * 20 : (i % 15) * 20 + 120]
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            w = [*w]
            w[rng.randrange(len(w))] = "zz"
        rows.append((500 - i, " ".join(w)))
    rows += [(900, None), (901, ""), (902, "one"), (903, "one two"), (904, "ONE\ttwo\x0b"), (905, "é É"), (905, "é É")]
    got = simhash.simhash_groups(documents(rows)).collect()
    assert len(got) == len(rows)
    fp = np.array([brute_print(t) for _, t in rows], np.uint64)
    root = forest(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3)
    least = {k: min(rows[i][0] for i in range(len(rows)) if root[i] == k) for k in set(root)}
    want = sorted((i, f"{f:016x}", least[r]) for (i, _), f, r in zip(rows, fp, root))
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == want


def test_forest_spans_dense_variants(spark):
    rng = np.random.default_rng(2)
    near = {0x0123456789ABCDEF ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False)) for _ in range(700)}
    far = {int(x) for x in rng.integers(0, 1 << 62, 300)}
    values = np.array(sorted(near | far), np.uint64)
    df = spark.createDataFrame([(int(x),) for x in values.view(np.int64)], "fp long")
    edges = simhash.link_forest(spark, Scratch(spark, "t"), df)
    got = {r.node: r.root for r in components(spark, edges).collect()}
    root = forest(np.bitwise_count(values[:, None] ^ values[None, :]) <= 3)
    signed = values.view(np.int64)
    groups, mine = {}, {}
    for i, r in enumerate(root):
        groups.setdefault(int(r), set()).add(int(signed[i]))
        mine.setdefault(got.get(int(signed[i]), int(signed[i])), set()).add(int(signed[i]))
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_distance_sets_segments():
    assert len(simhash._segments(3)) == 2 and len(simhash._segments(5)) == 3
    assert sum(w for _, w in simhash._segments(5)) == 64


def test_dedup_keeps_one_of_each_group(documents):
    rows = [(3, "a b c d"), (1, "a b c d"), (2, "something else here now"), (None, "a b c d")]
    kept = simhash.simhash_dedup(documents(rows))
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect() if r.doc_id) == [(False, 1), (False, 2)]
    assert kept.columns == documents(rows).columns
    assert simhash.simhash_groups(documents([(1, "x")]).where("false")).count() == 0


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(6, 40)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark, spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 5 for i in range(5, 40)}


def test_very_long_texts_link(documents):
    long = " ".join(f"w{k % 5003}" for k in range(300_000))
    rows = [(1, long), (2, long + " tail"), (3, "other words entirely here"), (4, None), (5, " ")]
    got = {r.doc_id: r.component_id for r in simhash.simhash_groups(documents(rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4}
