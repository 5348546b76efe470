import random

import numpy as np

from pyspark.sql import functions as F

from loomlog.llm import langid

WORDS = {"en": "the and with house river green thing".split(), "de": "der und mit häuser größe schön nicht".split(), "fr": "le et avec maison rivière élève où".split()}


def test_languages_are_told_apart(documents):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(WORDS[lang]) for _ in range(30)), lang) for i in range(90) for lang in [list(WORDS)[i % 3]]]
    docs = documents(rows)
    got = {r.doc_id: r for r in langid.predict_languages(docs, docs.where("doc_id < 60")).collect()}
    assert sum(got[i].lang_pred == lang for i, _, lang in rows) >= 88
    assert all(0 <= r.score <= 1 for r in got.values())


def test_edge_cases(documents):
    docs = documents([(1, "the green house and the river", "en"), (2, None, "en"), (3, "", "en"), (4, "12 34!", "en"), (5, "日本", None), (None, "the", "en"), (1, "the green house and the river", "en")])
    got = [(r.doc_id, r.lang_pred, r.score) for r in langid.predict_languages(docs, docs).collect()]
    assert len(got) == 7 and {i: p for i, p, _ in got}[2] == "und" and {i: p for i, p, _ in got}[4] == "und" and {i: p for i, p, _ in got}[1] == "en"
    assert all(r.lang_pred == "und" and r.score == 0 for r in langid.predict_languages(docs, docs.where("false")).collect())
    assert langid.predict_languages(docs.where("false"), docs).count() == 0


def test_more_than_sixty_four_languages(documents):
    rows = [(i, f"{chr(97 + i % 26) * 3}{chr(97 + i // 26) * 4} " * 8, f"l{i:02d}") for i in range(70)]
    docs = documents(rows)
    got = {r.doc_id: r.lang_pred for r in langid.predict_languages(docs, docs).collect()}
    assert sum(got[i] == lang for i, _, lang in rows) >= 69


def test_source_and_id_are_no_inputs(documents):
    docs = documents([(i, "the green river" if i % 2 else "der schön größe", "en" if i % 2 else "de") for i in range(20)])
    other = docs.withColumn("doc_id", F.col("doc_id") + 1000).withColumn("lang", F.lit(None).cast("string"))
    a = {r.doc_id: r.lang_pred for r in langid.predict_languages(docs, docs).collect()}
    b = {r.doc_id - 1000: r.lang_pred for r in langid.predict_languages(other, docs).collect()}
    assert a == b


def test_very_long_texts_and_held_out_accuracy(documents):
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(3, 60))), lang) for i in range(600) for lang in [list(WORDS)[i % 3]]]
    rows += [(1000, "the green river " * 150_000, None), (1001, "-" * 2_000_000 + " schön", None)]
    docs = documents(rows)
    got = {r.doc_id: r for r in langid.predict_languages(docs, docs.where("doc_id < 300")).collect()}
    assert sum(got[i].lang_pred == lang for i, _, lang in rows if 300 <= i < 600) >= 297  # never learned from
    assert got[1000].lang_pred == "en" and got[1001].lang_pred == "de"


def test_scores_equal_brute_force():
    """Hits of each language's own set of cells, counted gram by gram, less what chance makes appear."""
    rng = np.random.default_rng(2)
    table = [(rng.random((langid.CELLS, 3)) < 0.3) @ np.array([1, 2, 4])]
    table = [table[0].astype(np.uint8)]
    texts = [b"some words of a text", "größe über alles".encode(), b"x"]
    got = langid.score_texts(texts, ["a", "b", "c"], table)
    chance = [np.mean(table[0] >> i & 1) ** langid.HASHES for i in range(3)]
    for text, best, score in zip(texts, *got):
        total = np.zeros(3)
        for n in langid.GRAMS:
            buf = bytes(langid._WORD[list(b" " + text + b" ")])
            grams = [buf[k : k + n] for k in range(len(buf) - n + 1)]
            grams = [g for g in grams if b" " not in g[1:-1] and not (g[0] == g[-1] == 0x20)]
            cells = [[int(c[0]) for c in langid._grams(np.frombuffer(g, np.uint8), n)[1]] for g in grams]
            for i in range(3):
                hits = sum(all(table[0][c] >> i & 1 for c in own) for own in cells)
                total[i] += n * max(0, (hits - len(grams) * chance[i]) / (1 - chance[i]))
        sure = np.exp((total - total.max()) / (1e-9 + 0.05 * total.max()))
        assert best == (["a", "b", "c"][int(total.argmax())] if total.max() > 0 else None)
        assert abs(score - (sure.max() / sure.sum() if total.max() > 0 else 0)) < 1e-9
