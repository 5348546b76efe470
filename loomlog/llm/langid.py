"""Language identification with language-bitmask n-gram filters.

The Bloom filters of all languages are bit-sliced: one table whose cells hold one bit for each
language, so the AND of an n-gram's cells is the mask of the languages that contain it. A text's
popcounts for each language, less what the filter's fill makes appear by chance, decide."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks_of, text_bytes

#: Cells of the filter (a power of two), hashes, and n-gram lengths in bytes.
CELLS, HASHES, GRAMS = 1 << 20, 2, (3, 4)
#: Most documents of one language that the filter learns from, in expectation.
SAMPLE = 3000
#: Least share of a language's sampled documents that an n-gram must be in.
LEAST = 0.002
_WORD = np.full(256, 0x20, np.uint8)
_WORD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_WORD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_WORD[0x80:] = np.arange(0x80, 0x100)


def _normal(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes with A-Z lower-cased and every other ASCII byte but letters made a space, and where
    each text begins; texts stand between spaces."""
    buf = _WORD[np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)]
    lens = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    return buf, np.concatenate([[0], np.cumsum(lens + 1)])


def _grams(buf: np.ndarray, n: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """For each position, whether an n-gram of one word begins there - inner bytes hold no space, the
    ends may - and the filter's cells of the bytes."""
    size = max(0, len(buf) - n + 1)
    code, ok = np.zeros(size, np.uint64), np.ones(size, bool)
    blank = buf == 0x20
    for k in range(n):
        code <<= np.uint64(8)
        code |= buf[k : k + size]
        if 0 < k < n - 1:
            ok &= ~blank[k : k + size]
    ok &= ~(blank[:size] & blank[n - 1 :])
    code += np.uint64(n << 56)
    code *= np.uint64(0x9E3779B97F4A7C15)
    code ^= code >> np.uint64(29)
    code *= np.uint64(0xBF58476D1CE4E5B9)
    bits = CELLS.bit_length() - 1
    return ok, [(code >> np.uint64(64 - bits * (i + 1)) & np.uint64(CELLS - 1)).astype(np.int32) for i in range(HASHES)]


def learn(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> tuple[list[str], list[np.ndarray]]:
    """Languages in order and the filter's table: one array of CELLS words for each 64 languages.

    Learns from an id-hash sample of about `sample` documents of each language at most; what comes
    to the driver is the n-grams of that sample, bounded by it, and never depends on the corpus."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("t"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(counts)
    if not langs:
        return [], []
    share = F.create_map(*[F.lit(x) for k in langs for x in (k, min(1.0, sample / counts[k]))])
    picked = known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)).select("lang", F.col("t").cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, texts = np.array(batch.column(0).to_pylist(), object), batch.column(1).to_pylist()
            for one in set(lang):
                own = [t for k, t in zip(lang, texts) if k == one]
                for lo, hi in blocks_of(own):
                    buf, start = _normal(own[lo:hi])
                    seen = [np.zeros(0, np.int64)]
                    for n in GRAMS:
                        ok, (c, d) = _grams(buf, n)
                        at = np.flatnonzero(ok)
                        gram, doc = c[at].astype(np.int64) << 32 | d[at], np.searchsorted(start, at, "right")
                        order = np.lexsort((doc, gram))
                        gram, doc = gram[order], doc[order]
                        new = np.ones(len(gram), bool)
                        new[1:] = (gram[1:] != gram[:-1]) | (doc[1:] != doc[:-1])
                        seen.append(gram[new])
                    gram, count = np.unique(np.concatenate(seen), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([one] * len(gram), pa.string()), pa.array(gram), pa.array(count)], ["lang", "h", "n"])

    need = F.create_map(*[F.lit(x) for k in langs for x in (k, max(1.0, LEAST * min(sample, counts[k])))])
    found = picked.mapInArrow(run, "lang string, h long, n long").groupBy("lang", "h").agg(F.sum("n").alias("n"))
    found = found.where(F.col("n") >= need[F.col("lang")]).select("lang", "h").toPandas()
    table = [np.zeros(CELLS, np.uint64) for _ in range(-(-len(langs) // 64))]
    for i, one in enumerate(langs):
        gram = found["h"][found["lang"] == one].to_numpy(np.int64)
        for c in (gram >> 32, gram & 0xFFFFFFFF):
            table[i // 64][c] |= np.uint64(1 << i % 64)
    return langs, [t.astype(np.uint8) for t in table] if len(langs) <= 8 else table


def score_texts(texts: list[bytes], langs: list[str], table: list[np.ndarray]) -> tuple[list[str | None], np.ndarray]:
    """The language of each text and its score; None where no n-gram is known."""
    buf, start = _normal(texts)
    kind = table[0].dtype.type
    chance = np.array([np.mean(table[i // 64] >> kind(i % 64) & kind(1)) ** HASHES for i in range(len(langs))])
    total = np.zeros((len(texts), len(langs)))
    for n in GRAMS:
        ok, cells = _grams(buf, n)
        if not len(ok):
            continue
        first = np.minimum(start[:-1], len(ok) - 1)
        seen = np.add.reduceat(ok, first, dtype=np.int64)
        for w, words in enumerate(table):
            mask = words[cells[0]]
            for c in cells[1:]:
                mask &= words[c]
            mask *= ok
            for i in range(64 * w, min(64 * w + 64, len(langs))):
                hit = np.add.reduceat(mask >> kind(i % 64) & kind(1), first, dtype=np.int64)
                total[:, i] += n * np.clip((hit - seen * chance[i]) / max(1e-9, 1 - chance[i]), 0, None)
    most = total.max(1)
    sure = np.exp((total - most[:, None]) / (1e-9 + 0.05 * most[:, None]))
    sure /= sure.sum(1, keepdims=True)
    best = total.argmax(1)
    return [langs[b] if m > 0 else None for b, m in zip(best, most)], np.where(most > 0, sure[np.arange(len(texts)), best], 0.0)


def predict_languages(docs: DataFrame, training: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """(id_col, lang_pred, score) of every row of docs, learned from text and lang of training.

    lang_pred is `und` and score 0 for a text that is null or has no letter, and where nothing was
    learned; where no n-gram of a text is known, it is the first language, with score 0. Texts are
    read whole, a MB of them at a time, one text at least. Repeated rows each give a row; an empty
    table gives none; other columns are never read, whatever their names."""
    spark: SparkSession = docs.sparkSession
    langs, table = learn(training, id_col=id_col, text_col=text_col, lang_col=lang_col, sample=sample)
    shared = spark.sparkContext.broadcast((langs, table))  # CELLS words for each 64 languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, table = shared.value
        for batch in batches:
            ids, texts, ok = batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for lo, hi in blocks_of(texts):
                lang, sure = score_texts(texts[lo:hi], langs, table) if langs else ([None] * (hi - lo), np.zeros(hi - lo))
                lang = [(k or langs[0]) if good and langs else "und" for k, good in zip(lang, ok[lo:hi])]
                sure = np.where(np.array([k == "und" for k in lang]), 0.0, sure)
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), pa.array(lang, pa.string()), pa.array(sure)], ["id", "lang_pred", "score"])

    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("t"), letters.alias("ok"))
    id_type = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"id {id_type}, lang_pred string, score double").withColumnRenamed("id", id_col)
