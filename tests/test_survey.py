import hashlib

from pyspark.sql import functions as F

from loomlog.operators import survey


def test_foreign_probe_equals_brute_force(spark):
    claims = [(f"s{i}", f"c{(i * 7 + k * k) % 90}") for i in range(40) for k in range(i % 6)] + [("s1", None)]
    logs = {f"s{i}": " ".join(f"c{x}" for x in range(i, i + 30)) + " " for i in range(3, 50)}
    digest_of = lambda x: hashlib.sha256(f"{x}|z".encode()).hexdigest()
    pool = sorted({c for _, c in claims if c}, key=digest_of)
    for n in (5, 200):
        got = survey.foreign_probe(
            spark.createDataFrame(claims, "session_id string, claim string"), spark.createDataFrame(list(logs.items()), "session_id string, corpus string"), n, "z", lambda c, t: F.contains(t, F.concat(c, F.lit(" ")))
        )
        want = []
        for s, corpus in logs.items():
            at, own = int(digest_of(s)[:15], 16) % len(pool), {c for x, c in claims if x == s}
            asked = [c for c in pool[at:] + pool[:at] if c not in own][:n]
            assert len(asked) == min(n, len(set(pool) - own))
            want.append((s, len(asked), sum(f"{c} " in corpus for c in asked)))
        assert sorted(map(tuple, got.collect())) == sorted(want)
