import numpy as np
import pytest

from loomlog.llm import embedding
from loomlog.llm.common import forest

SCHEMA = "vec_id long, embedding array<float>, label int, c long, codes int"


def brute(rows, least=0.98):
    n = len(rows)
    near = np.zeros((n, n), bool)
    for i, a in enumerate(rows):
        for j, b in enumerate(rows):
            if i != j and a[2] is not None and a[2] == b[2] and a[1] and b[1] and len(a[1]) == len(b[1]) and None not in a[1] + b[1]:
                x, y = np.array(a[1], np.float32).astype(float), np.array(b[1], np.float32).astype(float)
                if np.isfinite(x).all() and np.isfinite(y).all() and x.any() and y.any():
                    near[i, j] = x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least
    root = forest(near)
    ids = [r[0] for r in rows]
    least_id = {k: min(ids[i] for i in range(n) if root[i] == k) for k in set(root)}
    return {(ids[i], int(near[i].sum()), least_id[root[i]]) for i in range(n)}


def test_links_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows, centre = [], rng.normal(size=(12, 24))
    for i in range(260):
        c = centre[i % 12] + rng.normal(size=24) * rng.choice([0.0, 0.06, 0.1, 1.0])
        rows.append((1000 - i, [float(v) for v in c.astype(np.float32)], int(i % 12) % 3, 1, 2))
    hub = rng.normal(size=24)
    rows += [(2000 + i, [float(v) for v in (hub + rng.normal(size=24) * 0.02).astype(np.float32)], 5, 1, 2) for i in range(600)]  # several blocks
    found = embedding.embedding_links(spark.createDataFrame(rows, SCHEMA)).collect()
    want = brute(rows)
    got = {(r.vec_id, r.n_links, r.component_id) for r in found}
    assert len(found) == len(rows)
    assert sum(r[1] for r in got & want) >= 0.99 * sum(r[1] for r in want)  # the index's recall
    assert sum(r.n_links for r in found) <= sum(w[1] for w in want)  # no link below the threshold
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1, 0, 0), (2, [2.0, 0.0], 1, 0, 0), (3, [1.0, 0.0], None, 0, 0), (4, [0.0, 0.0], 1, 0, 0), (5, None, 1, 0, 0), (6, [1.0, None], 1, 0, 0),
        (7, [nan, 1.0], 1, 0, 0), (8, [inf, 1.0], 1, 0, 0), (9, [1.0, 0.0, 0.0], 1, 0, 0), (1, [1.0, 0.0], 1, 0, 0), (10, [1.0, 0.0], 2, 0, 0), (11, [], 1, 0, 0),
    ]
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding.embedding_links(spark.createDataFrame(rows, SCHEMA)).collect())
    alone = [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11)]
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), *alone])
    assert embedding.embedding_links(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("d", [1, 3, 64, 100])
def test_codes_are_equal_for_equal_directions(d):
    x = np.random.default_rng(1).normal(size=(5, d))
    a, b = embedding.bucket_codes(x, 3, 2, 2, 0), embedding.bucket_codes(4 * x, 3, 2, 2, 0)
    assert (a == b).all()
