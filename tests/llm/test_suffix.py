import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomlog.llm import suffix


def compare(rows, documents, **options):
    got = suffix.digests(documents(rows), **options).collect()
    want = suffix.brute_force([(i, (t or "").encode()) for i, t in rows])
    assert len(got) == len(rows)
    for r in got:
        runs, sha = want[r.doc_id]
        assert (r.n_removed, r.n_spans, r.kept_sha256) == (sum(b - a for a, b in runs), len(runs), sha), r.doc_id


def test_equals_brute_force(documents):
    rng = random.Random(8)
    pool = ["".join(rng.choice("abcdéfg ") for _ in range(rng.randint(80, 300))) for _ in range(14)]
    rows = [(i * 3 - 40, "".join(rng.choice(pool)[rng.randint(0, 9) :] if rng.random() < 0.6 else "".join(rng.choice("xyz ") for _ in range(rng.randint(1, 120))) for _ in range(rng.randint(0, 6)))) for i in range(90)]
    rows += [(500 + i, "a" * (60 + 13 * i)) for i in range(12)] + [(600 + i, "ab" * (40 + i)) for i in range(8)]
    rows += [(700, None), (701, ""), (702, "z" * 99), (703, "q" * 100), (704, "q" * 100)]
    compare(rows, documents)
    compare(rows, documents, ranges=4)  # splitters in two steps


def test_texts_that_share_an_id(documents, spark):
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    a, b, c = word(300), word(400), word(200)
    rows = [(1, a), (2, a), (2, b), (3, c + b[50:250]), (3, b[:350] + c), (3, b[:350] + c), (None, a[100:] + c), (None, word(150)), (4, a), (4, a)]
    frame = documents(rows)
    hashed = frame.select("doc_id", "text", F.xxhash64(F.encode("text", "UTF-8"))).collect()
    order = {(r[0], r[1]): (r[0] if r[0] is not None else 1 << 63, r[2]) for r in hashed}  # a null id last, then by hash
    want = suffix.brute_force(sorted((k, t.encode()) for (_, t), k in order.items()))
    got = suffix.remove_repeats(frame, carry=["text"]).collect()
    assert len(got) == len(rows)
    for r in got:
        assert [(x.start, x.end) for x in r.spans] == want[order[r.doc_id, r.text]][0], (r.doc_id, r.text[:9])
    assert {r.text: len(r.kept) for r in got if r.doc_id == 2} == {a: 0, b: 400}


def test_windows_longer_than_a_slice(documents, monkeypatch):
    monkeypatch.setattr(suffix, "_SLICE", 256)
    rng = random.Random(2)
    part = "".join(rng.choice("abcdefgh") for _ in range(700))
    rows = [(1, part + "".join(rng.choice("ijk") for _ in range(300))), (2, "x" + part), (3, part[:350] + "-" + part[350:])]
    compare(rows, documents)


def test_rows_that_share_an_id_and_empty_tables(documents):
    rows = [(1, "m" * 50 + "n" * 100), (1, "m" * 50 + "n" * 100), (None, "o" * 120)]
    got = suffix.digests(documents(rows)).collect()
    assert len(got) == 3 and {r.doc_id for r in got} == {1, None}
    assert suffix.digests(documents([(1, "a")]).where("false")).count() == 0
    kept = suffix.remove_repeats(documents([(1, "p" * 130)]), carry=["lang", "kept", "x"])
    assert kept.columns == ["doc_id", "n_bytes", "spans", "kept", "lang", "kept", "x"]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=3, max_size=3), min_size=0, max_size=40))
def test_multikey_order(rows):
    suffix.SMALL = 3
    words = np.array(rows, np.uint64).reshape(-1, 3)
    order, head = suffix.multikey_order(words)
    done = words[order].tolist()
    assert done == sorted(words.tolist())
    for a, b, h in zip(done, done[1:], head[1:]):
        assert h == next((k for k in range(3) if a[k] != b[k]), 3)


def test_routing_by_splitters():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 4, (3, 500)).astype(np.uint64)
    splitters = np.array(sorted(map(tuple, rng.integers(0, 4, (20, 3)).tolist())), np.uint64).T
    want = [sum(tuple(s) <= tuple(k) for s in splitters.T.tolist()) for k in keys.T.tolist()]
    assert suffix._part_of(keys, splitters).tolist() == want
