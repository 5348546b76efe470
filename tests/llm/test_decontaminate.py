import hashlib
import random
import re

from loomlog.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, bench):
    out = set()
    windows = []
    for item, text in bench:
        w = words(text)
        n = min(13, len(w))
        windows += [(item, tuple(w[i : i + n])) for i in range(len(w) - n + 1) if n]
    for i, text in docs:
        w, hit, items = words(text), set(), set()
        for item, x in windows:
            for p in range(len(w) - len(x) + 1):
                if tuple(w[p : p + len(x)]) == x:
                    hit.update(range(p, p + len(x)))
                    if item is not None:
                        items.add(item)
        names = ",".join(sorted(map(str, items)))
        out.add((i, len(w), len(hit), len(items), hashlib.sha256(names.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def run(spark, documents, docs, bench):
    b = spark.createDataFrame(bench, "item_id long, text string")
    return decontaminate.contamination(documents(docs), b).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def test_equals_brute_force(spark, documents):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(12)] + ["É", "é", "STOP", "stop"]
    bench = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 12, 13, 14, 30])))) for i in range(25)]
    bench += [(30, ""), (31, None), (32, "--- !!"), (3, bench[3][1]), (None, "w1 w2 w1 w2"), (33, "w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1")]
    docs = []
    for i in range(60):
        parts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40)))]
        if rng.random() < 0.5:
            parts.append(rng.choice(bench[:25])[1].upper().replace(" ", ", "))
        docs.append((i, "-".join(parts)))
    docs += [(100, None), (101, ""), (102, "w1 " * 40), (103, "é É")]
    got = {tuple(r) for r in run(spark, documents, docs, bench).collect()}
    assert got == brute(docs, bench)


def test_repeated_rows_and_empty_tables(spark, documents):
    bench = [(1, "a b c")]
    assert run(spark, documents, [(5, "x a b c"), (5, "x a b c"), (None, "a b c")], bench).count() == 3
    assert run(spark, documents, [(5, "a b c")], [(1, None)]).first().n_hit == 0
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contamination(documents([(5, "a b c")]), empty).first().n_hit == 0
    assert decontaminate.contamination(documents([(1, "a")]).where("false"), empty).count() == 0


def test_phrases_and_near_matches(spark, documents):
    item = " ".join(f"t{i}" for i in range(20))
    broken = item.split()
    broken[10] = "other"
    docs = documents([(1, "x y " + item), (2, "z " + " ".join(broken))])
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    phrases = decontaminate.phrase_matches(docs, bench).collect()
    assert [(r.item_id, r.doc_id, r.doc_from, r.n_words) for r in phrases] == [(9, 1, 2, 20)]
    assert {r.doc_id for r in decontaminate.proximity_matches(docs, bench).collect()} == {1, 2}
    kept = decontaminate.decontaminate(docs, bench)
    assert [r.doc_id for r in kept.collect()] == [2] and kept.columns == docs.columns


def test_main_path_is_native():
    source = open(decontaminate.__file__).read()
    assert not re.search(r"import (pandas|pyarrow|numpy)|mapIn|applyIn|\.rdd|udf", source)
