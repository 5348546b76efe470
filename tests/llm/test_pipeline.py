import itertools

from pyspark.sql import functions as F

import corpus_pipeline
from loomlog.llm import decontaminate, quality, suffix

DIR = "/root/testdata/sf0.001"


def first_of_similar(texts, width=5, least=0.8):
    """The smallest id of each component of texts whose sets of shingles are alike, by comparing all."""
    def shingles(text):
        w = (text or "").encode().lower().split()
        return {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()

    sets, root = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(texts), 2):
        x, y = sets[a], sets[b]
        if x == y or len(x & y) >= least * len(x | y) - 1e-9:
            p, q = sorted((top(a), top(b)))
            root[q] = p
    return [i for i in texts if top(i) == i]


def test_stages_work_on_what_is_kept(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "simhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination", "best_fit_packing"]
    labels, bench = (spark.read.parquet(f"{DIR}/{t}.parquet") for t in ("labels", "benchmark"))
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = left.collect()
        left = spark.createDataFrame(stage(spark, left, DIR).collect(), docs.schema)
        after = {r.doc_id: r for r in left.collect()}
        assert left.columns == docs.columns and set(after) <= {r.doc_id for r in before}
        frame = spark.createDataFrame(before, docs.schema)
        if name == "quality_classifier":
            assert set(after) == {r.row.doc_id for r in quality.classify(frame, labels).collect() if r.kept}
        elif name == "simhash_near_dedup":
            assert set(after) == set(first_of_similar({r.doc_id: r.text for r in before}))
        elif name == "suffix_array_dedup":
            runs = suffix.brute_force([(r.doc_id, r.text.encode()) for r in before])
            for r in before:
                t, keep, at = r.text.encode(), b"", 0
                for a, b in runs[r.doc_id][0]:
                    keep, at = keep + t[at:a], b
                want = (keep + t[at:]).decode("utf-8", "ignore")
                assert (after[r.doc_id].text == want and after[r.doc_id].n_chars == len(want)) if want.strip() else r.doc_id not in after
        else:
            assert set(after) == {r.doc_id for r in decontaminate.contamination(frame, bench).collect() if not r.contaminated}
    packed = corpus_pipeline.STAGES[-1][1](spark, left, DIR)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in left.collect()}


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, DIR)
        docs = spark.createDataFrame(rows.collect(), rows.schema)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, corpus_pipeline.run(spark, DIR).select(key).collect())) == sorted(map(tuple, docs.select(key).collect()))


def test_stages_take_nulls_repeats_clashes_and_empty_tables(spark, documents):
    clean = spark.read.parquet(f"{DIR}/documents.parquet").limit(40).select("doc_id", "text", "lang").collect()
    rows = [*map(tuple, clean), (900_001, None, "en"), (900_002, "", None), (None, "some words here", "en"), (900_003, "again and again", None), (900_003, "again and again", None)]
    for table in (documents(rows).withColumn("n_chars", F.length("text")), documents(rows).withColumn("n_chars", F.length("text")).where("false")):
        left = table
        for name, stage in corpus_pipeline.STAGES:
            left = stage(spark, left, DIR)
            kept = left.collect()
            assert name == "best_fit_packing" or left.columns == table.columns
            left = spark.createDataFrame(kept, left.schema)
        assert left.count() <= 3 * len(rows)
