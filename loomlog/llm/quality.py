"""Quality classifier: an interpolated modified Kneser-Ney n-gram model of trusted text.

Four fifths of all trusted documents teach the model, the others make the thresholds; all unwanted
documents teach a second model. The models grow with the corpus and are never in one place: buckets of
a few MB of text send their distinct trigrams as packed arrays to partitions of the hash space, which
count them, their contexts and - one order after the other - in how many longer n-grams the shorter
ones occur. To score, a bucket sends the distinct words, bigrams and trigrams of its texts to the
partitions and gets their counts back. A document is kept if its perplexity, drawn toward its
language's mean as far as it is short, is within a quantile of its language's held-back trusted
documents, and if its strongest word is: words weigh by how much likelier they are in the model of
unwanted documents."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .common import Powers, Scratch, blocks_of, checked, hash_words, mix64, release, text_bytes, tidy
from .lm import MOST_PARTS, bucket_tokens, pack_planes, shard_of, unpack_planes

#: Share of the trusted documents that teach the model; the quantile of the other ones that is the
#: threshold; tokens of the language's mean that each document's mean starts from.
TAUGHT, QUANTILE, PRIOR = 0.8, 0.998, 10.0
#: MB of text in a bucket, and for each partition of the hash space; fewest of either.
BUCKET_MB, PART_MB, FEWEST = 5, 6, 12
#: Passes over the corpus, each of which scores its share of the texts, so that only a share is shuffled at once.
PASSES = 4
#: Order of the model of unwanted documents, whose single words alone are compared.
CONTRAST_ORDER = 2
ORDER = 3
#: Fewest calibration documents for a language to have its own threshold.
LEAST = 30
_END, _START = np.uint64(0x3C6EF372FE94F82B), np.uint64(0xA54FF53A5F1D36F1)
_HALF, _LOW = np.uint64(32), np.uint64(0xFFFFFFFF)
#: Bits of a key within its partition of half a million keys: of unseen keys, some 3e-5 are found. More
#: where partitions grow.
KEY_BITS = 34


def grams(texts: list[bytes], powers: Powers, order: int) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """For n from 1 to order, hashes of the n-grams that end at each token and of their contexts;
    and where each text begins. Each text gets start tokens before and an end token after."""
    h, first = hash_words(texts, powers)
    tokens = np.insert(h, first[1:], _END)
    first = first + np.arange(len(first))
    place = np.arange(len(tokens)) - np.repeat(first[:-1], np.diff(first))
    gram, contexts = [mix64(tokens + np.uint64(1))], [np.zeros(len(tokens), np.uint64)]
    context = np.zeros(len(tokens), np.uint64)
    for n in range(2, order + 1):
        back = np.full(len(tokens), _START, np.uint64)
        back[n - 1 :] = tokens[: max(0, len(tokens) - n + 1)]
        back[place < n - 1] = _START
        context = mix64(context * np.uint64(3) + back)
        contexts.append(context)
        gram.append(mix64(context ^ tokens * np.uint64(0x9E3779B97F4A7C15) + np.uint64(n)))
    return gram, contexts, first


class Model:
    """Sorted keys and values: shares of n-grams and weights of contexts for each n; and how much
    likelier words are in a model of unwanted text, as log10, where they are."""

    def __init__(self, tables: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]], vocabulary: int, order: int):
        self.tables, self.vocabulary, self.order = tables, vocabulary, order
        self.tables["contrast", 1] = np.zeros(0, np.uint64), np.zeros(0, np.float32)

    def _find(self, kind: str, n: int, keys: np.ndarray, default: float) -> np.ndarray:
        have, value = self.tables.get((kind, n), (np.zeros(0, np.uint64), np.zeros(0)))
        if not len(have):
            return np.full(len(keys), default)
        at = np.minimum(np.searchsorted(have, keys), len(have) - 1)
        return np.where(have[at] == keys, value[at], default)

    def words(self, keys: np.ndarray) -> np.ndarray:
        """Probabilities of single words."""
        return self._find("share", 1, keys, 0.0) + self._find("weight", 1, np.zeros(1, np.uint64), 1.0) / (self.vocabulary + 1)

    def against(self, other: Model) -> None:
        """Keeps the words that the other model finds likelier."""
        keys = other.tables["share", 1][0]
        ratio = np.log10(other.words(keys) / self.words(keys))
        self.tables["contrast", 1] = keys[ratio > 0], ratio[ratio > 0].astype(np.float32)

    def log10(self, texts: list[bytes], powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens, log10 probability and the largest contrast of each text."""
        gram, contexts, first = grams(texts, powers, self.order)
        contrast = self._find("contrast", 1, gram[0], 0.0)
        p = np.full(len(gram[0]), 1.0 / (self.vocabulary + 1))
        for n in range(1, self.order + 1):
            p = self._find("share", n, gram[n - 1], 0.0) + self._find("weight", n, contexts[n - 1], 1.0) * p
        return np.diff(first), np.add.reduceat(np.log10(p), first[:-1]), np.maximum.reduceat(contrast, first[:-1]).astype(np.float64)


def discounts(times: dict[int, int]) -> list[float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and from 3 on, by how many n-grams have a count."""
    n1, n2, n3, n4 = (max(1, times.get(k, 0)) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2)
    return [min(max(k - (k + 1) * y * b / a, 0.05), k - 0.05) for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]


def train(trusted: DataFrame, *, text_col: str = "text", order: int = ORDER) -> Model:
    """The model of a table of documents that one machine's memory holds, for comparison."""
    scratch = Scratch(trusted.sparkSession, "quality")
    names = [f"{k}{n}" for n in range(order, 0, -1) for k in "gh"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for lo, hi in blocks_of(texts):
                gram, contexts, _ = grams(texts[lo:hi], powers, order)
                cols = [x[n - 1] for n in range(order, 0, -1) for x in (gram, contexts)]
                yield pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in cols], names)

    tokens = trusted.select(text_bytes(text_col).alias("t")).mapInArrow(run, ", ".join(f"{n} long" for n in names))
    counts = tokens.groupBy(names).agg(F.count(F.lit(1)).alias("c"))
    tables, vocabulary = {}, 0
    for n in range(order, 0, -1):
        counts = scratch.write(counts, f"counts{n}")  # below the top order: in how many longer n-grams
        times = {r["c"]: r["n"] for r in counts.where("c < 5").groupBy("c").agg(F.count(F.lit(1)).alias("n")).collect()}
        d = discounts(times)
        cut = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        total = counts.groupBy(f"h{n}").agg(F.sum("c").alias("total"), F.sum(cut).alias("freed"))
        share = counts.join(total, f"h{n}").select(F.col(f"g{n}").alias("key"), ((F.col("c") - cut) / F.col("total")).alias("value"))
        weight = total.select(F.col(f"h{n}").alias("key"), (F.col("freed") / F.col("total")).alias("value"))
        for kind, rows in (("share", share), ("weight", weight)):
            got = rows.select("key", F.col("value").cast("float").alias("value")).toArrow()
            key = got["key"].to_numpy().view(np.uint64)
            by = np.argsort(key)
            tables[kind, n] = key[by], got["value"].to_numpy()[by]
        vocabulary = counts.count()
        if n > 1:
            counts = counts.groupBy(names[2 * (order - n + 1) :]).agg(F.count(F.lit(1)).alias("c"))
    scratch.drop()
    return Model(tables, vocabulary, order)


# --------------------------------------------------------------------------- packed arrays


def _zip(b: bytes) -> bytes:
    return len(b).to_bytes(8, "little") + pa.compress(b, "zstd", asbytes=True)


def _unzip(b: bytes) -> bytes:
    return pa.decompress(b[8:], int.from_bytes(b[:8], "little"), "zstd", asbytes=True)


def _pack_keys(x: np.ndarray) -> bytes:
    return _zip(pack_planes(np.diff(x, prepend=np.uint64(0))))


def _unpack_keys(b: bytes) -> np.ndarray:
    return np.cumsum(unpack_planes(_unzip(b), np.uint64), dtype=np.uint64)


def _pack_counts(*columns: np.ndarray) -> bytes:
    """Columns of counts, each in the fewest bytes that its largest needs."""
    kinds = [np.min_scalar_type(int(x.max(initial=0))) for x in columns]
    return bytes(k.itemsize for k in kinds) + _zip(b"".join(pack_planes(x.astype(k)) for x, k in zip(columns, kinds)))


def _unpack_counts(b: bytes, columns: int) -> np.ndarray:
    sizes, data = list(b[:columns]), _unzip(b[columns:])
    n, at, out = len(data) // sum(sizes), 0, []
    for k in sizes:
        out.append(unpack_planes(data[at : at + n * k], f"u{k}").astype(np.int64))
        at += n * k
    return np.array(out)


# --------------------------------------------------------------------------- counts by shards

#: What partitions know of a key: its count; as a context, how many n-grams of count 1, 2 and more
#: follow, and by how much those exceed 3; a word's count among unwanted documents.
_COLUMNS = ("count", "once", "twice", "more", "excess", "unwanted")


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values in order, where one of each is, and the place of every row's value."""
    order = np.argsort(x)
    ordered = x[order]
    new = np.ones(len(x), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    back = np.empty(len(x), np.int64)
    back[order] = np.cumsum(new) - 1
    return ordered[new], order[new], back


def _word_keys(words: np.ndarray) -> np.ndarray:
    return mix64(words + np.uint64(0x6A09E667F3BCC909))


def _pair_keys(pairs: np.ndarray) -> np.ndarray:
    return mix64(pairs ^ np.uint64(0xBB67AE8584CAA73B))


def _trigram_keys(context: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix64(context + words * np.uint64(0x9E3779B97F4A7C15))


def _short(keys: np.ndarray, bits: int) -> np.ndarray:
    return keys >> np.uint64(64 - bits)


class _Grams:
    """Words (32 bits of their hashes), pairs with the word before, and pairs before, of each token
    of some texts; and where each text begins."""

    def __init__(self, texts: list[bytes]):
        tokens, self.first = bucket_tokens(texts, Powers())
        start = _START >> _HALF
        self.words = tokens >> _HALF
        before = np.roll(self.words, 1)
        before[self.first[:-1]] = start
        self.pairs = before << _HALF | self.words
        self.above = np.roll(self.pairs, 1)
        self.above[self.first[:-1]] = start << _HALF | start


def _placed(texts: list[bytes], parts: int, bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Partitions and keys, in one number, of each token's word, pair and trigram, those of the start
    last; and where each text begins."""
    g = _Grams(texts)
    start = _START >> _HALF
    words, pairs = _word_keys(np.append(g.words, start)), _pair_keys(np.append(g.pairs, start << _HALF | start))
    above = np.roll(pairs[:-1], 1)
    above[g.first[:-1]] = pairs[-1]
    at = [shard_of(x, parts).astype(np.uint64) << np.uint64(bits) for x in (words, pairs)]
    over = np.roll(at[1][:-1], 1)
    over[g.first[:-1]] = at[1][-1]
    return [at[0] | _short(words, bits), at[1] | _short(pairs, bits), over | _short(_trigram_keys(above, g.words), bits)], g.first


def _cuts(placed: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """(partition, from, to) of distinct keys in order."""
    part = (placed >> np.uint64(bits)).astype(np.int64)
    cut = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
    for a, b in zip(cut, [*cut[1:], len(part)]):
        yield int(part[a]), a, b


#: Columns that are asked of a word, a pair and a trigram.
_ASKED = 6, 5, 1


def _dealt_rows(kind: str, keys: np.ndarray, own: np.ndarray, parts: int, *columns: np.ndarray) -> list[tuple]:
    """Rows of sorted keys and their columns for each partition of own, the keys to be placed by."""
    part = shard_of(own, parts)
    order = np.argsort(part, kind="stable")
    cut = np.flatnonzero(np.diff(part[order], prepend=-1)).tolist()
    return [(kind, int(part[order[a]]), _pack_keys(keys[order[a:b]]), _pack_counts(*[c[order[a:b]] for c in columns])) for a, b in zip(cut, [*cut[1:], len(order)])]


def _model_row(p: int, keys: np.ndarray, **columns: np.ndarray) -> tuple:
    order = np.argsort(keys)
    return "model", p, _pack_keys(keys[order]), _pack_counts(*[columns[c][order].astype(np.int64) if c in columns else np.zeros(len(keys), np.int64) for c in _COLUMNS])


def _stats_row(kind: str, p: int, counts: np.ndarray) -> tuple:
    """How many counts are 1, 2, 3 and 4; all; and their sum."""
    return (kind, p, b"", b"", *(int((counts == k).sum()) for k in (1, 2, 3, 4)), int((counts > 0).sum()), int(counts.sum()))


def _followers(context: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Distinct contexts, and how many counts of 1, 2 and more each has and by how much those exceed 3."""
    distinct, _, back = _distinct(context)
    add = lambda x: np.bincount(back, x, len(distinct)).astype(np.int64)
    return distinct, {"once": add(counts == 1), "twice": add(counts == 2), "more": add(counts > 2), "excess": add(np.maximum(counts - 3, 0))}


def _summed(frame: pd.DataFrame, columns: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of packed rows and the sums of their columns."""
    keys = np.concatenate([np.zeros(0, np.uint64), *map(_unpack_keys, frame["a"])])
    values = np.concatenate([np.zeros((columns, 0), np.int64), *[_unpack_counts(c, columns) for c in frame["c"]]], axis=1)
    keys, _, back = _distinct(keys)
    return keys, np.array([np.bincount(back, v, len(keys)).astype(np.int64) for v in values])


_STATS = [f"n{k}" for k in range(1, 7)]
_ROWS = "kind string, p int, a binary, c binary, " + ", ".join(f"{n} long" for n in _STATS)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    tidy()
    return pd.DataFrame([(*r, *[0] * (10 - len(r))) for r in rows], columns=["kind", "p", "a", "c", *_STATS])


class ShardedModel:
    """Counts of trusted and of unwanted documents, in partitions of the hash space."""

    def __init__(self, taught: DataFrame, parts: int, bits: int, scratch: Scratch):
        """taught: rows (t, unwanted) of all documents that teach."""
        self.parts, self.bits, spark = parts, bits, taught.sparkSession

        def packed(texts: list[bytes], unwelcome: bool) -> pa.RecordBatch:
            g = _Grams(texts)
            if unwelcome:
                pairs = np.unique(g.pairs)
                rows = _dealt_rows("unwanted", pairs, _pair_keys(pairs), parts)
            else:
                above = _pair_keys(g.above)
                _, at, back = _distinct(_trigram_keys(above, g.words))
                order = np.argsort(g.above[at])
                at, n = at[order], np.bincount(back)[order]
                rows = _dealt_rows("trigrams", g.above[at], above[at], parts, g.words[at], n)
            tidy()
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.string(), pa.int32(), pa.binary(), pa.binary()))], ["kind", "p", "a", "c"])

        def teach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            texts, size = {False: [], True: []}, {False: 0, True: 0}
            for batch in batches:
                for t, k in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    texts[k].append(t)
                    size[k] += len(t)
                    if size[k] >= BUCKET_MB * 1e6:
                        yield packed(texts[k], k)
                        texts[k], size[k] = [], 0
            yield from (packed(texts[k], k) for k in texts if texts[k])

        def third(pdf: pd.DataFrame) -> pd.DataFrame:
            p, own = int(pdf["p"].iloc[0]), pdf[pdf["kind"] == "trigrams"]
            out = []
            if len(own):
                above, (words, n) = np.concatenate([_unpack_keys(a) for a in own["a"]]), np.concatenate([_unpack_counts(c, 2) for c in own["c"]], axis=1)
                words = words.astype(np.uint64)
                keys, at, back = _distinct(_trigram_keys(_pair_keys(above), words))
                n, above, words = np.bincount(back, n, len(keys)).astype(np.int64), above[at], words[at]
                contexts, follow = _followers(above, n)
                out += [_model_row(p, _short(keys, bits), count=n), _model_row(p, _short(_pair_keys(contexts), bits), **follow), _stats_row("third", p, n)]
                pairs, n = np.unique((above & _LOW) << _HALF | words, return_counts=True)
                out += _dealt_rows("pairs", pairs, _pair_keys(pairs), parts, n)
            own = pdf[pdf["kind"] == "unwanted"]
            if len(own):
                words, n = np.unique(np.unique(np.concatenate([_unpack_keys(a) for a in own["a"]])) & _LOW, return_counts=True)
                none = np.zeros(len(words), np.int64)
                out += _dealt_rows("words", words, _word_keys(words), parts, none, none, none, none, none, n)
            return _frame(out)

        def second(pdf: pd.DataFrame) -> pd.DataFrame:
            p, (pairs, (n,)) = int(pdf["p"].iloc[0]), _summed(pdf, 1)
            contexts, follow = _followers(pairs >> _HALF, n)
            ends, times = np.unique(pairs & _LOW, return_counts=True)
            words = np.union1d(contexts, ends)
            columns = np.zeros((len(_COLUMNS), len(words)), np.int64)
            columns[0, np.searchsorted(words, ends)] = times
            columns[1:5, np.searchsorted(words, contexts)] = [follow[k] for k in _COLUMNS[1:5]]
            return _frame([_model_row(p, _short(_pair_keys(pairs), bits), count=n), _stats_row("second", p, n), *_dealt_rows("words", words, _word_keys(words), parts, *columns)])

        def single(pdf: pd.DataFrame) -> pd.DataFrame:
            p, (words, columns) = int(pdf["p"].iloc[0]), _summed(pdf, len(_COLUMNS))
            return _frame([_model_row(p, _short(_word_keys(words), bits), **dict(zip(_COLUMNS, columns))), _stats_row("first", p, columns[0]), _stats_row("unwanted", p, columns[5])])

        def merged(pdf: pd.DataFrame) -> pd.DataFrame:
            keys, columns = _summed(pdf, len(_COLUMNS))
            tidy()
            return pd.DataFrame([(int(pdf["p"].iloc[0]), _pack_keys(keys), _pack_counts(*columns))], columns=["p", "a", "c"])

        sent = taught.select(F.col("t").cast("binary").alias("t"), "unwanted").mapInArrow(teach, "kind string, p int, a binary, c binary")
        three = scratch.write(sent.groupBy("p").applyInPandas(third, _ROWS), "third")
        release(spark)
        two = scratch.write(three.where("kind = 'pairs'").select("p", "a", "c").groupBy("p").applyInPandas(second, _ROWS), "second")
        release(spark)
        words = two.where("kind = 'words'").unionByName(three.where("kind = 'words'")).select("p", "a", "c")
        one = scratch.write(words.groupBy("p").applyInPandas(single, _ROWS), "first")
        every = three.unionByName(two).unionByName(one)
        stats = {r["kind"]: [r[n] for n in _STATS] for r in every.where("a = X''").groupBy("kind").agg(*[F.sum(n).alias(n) for n in _STATS]).collect()}
        release(spark)
        self.rows = scratch.write(every.where("kind = 'model'").select("p", "a", "c").groupBy("p").applyInPandas(merged, "p int, a binary, c binary"), "model")
        scratch.drop("third", "second", "first")
        release(spark)
        nothing = [0] * 6
        self.third, self.second, self.first, self.unwanted = (stats.get(k, nothing) for k in ("third", "second", "first", "unwanted"))


def _cut(n: np.ndarray, d: list[float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(n, 3)]


def _single_words(n: np.ndarray, stats: list[int]) -> np.ndarray:
    """Probabilities of words of counts n in a model with these stats."""
    once, twice, _, _, kinds, total = stats
    d = _discounts(stats)
    if not total:
        return np.ones(len(n))
    freed = d[0] * once + d[1] * twice + d[2] * (kinds - once - twice)
    return (n - _cut(n, d)) / total + freed / total / (kinds + 1)


def _discounts(stats: list[int]) -> list[float]:
    return discounts(dict(zip((1, 2, 3, 4), stats)))


def _mixed(n: np.ndarray, follow: np.ndarray, at: np.ndarray, d: list[float], lower: np.ndarray) -> np.ndarray:
    """Probabilities of n-grams of counts n after contexts, of whose followers the columns at tell."""
    once, twice, more, excess = follow
    total = once + 2 * twice + 3 * more + excess
    share = np.where(total > 0, 1.0 / np.maximum(total, 1), 0.0)
    weight = np.where(total > 0, (d[0] * once + d[1] * twice + d[2] * more) * share, 1.0)
    return (n - _cut(n, d)) * share[at] + weight[at] * lower


def _scores(model: ShardedModel, rows: DataFrame, buckets: int) -> DataFrame:
    """rows (salt, t, and what else they hold) without salt and t, but with n_tokens, lp - the log10
    probability of the text t - and the text's largest contrast."""
    parts, bits, third, second, first, unwanted = model.parts, model.bits, model.third, model.second, model.first, model.unwanted
    others = [f for f in rows.schema if f.name not in ("salt", "t")]
    names = [f.name for f in others]
    rows = rows.select(F.pmod("salt", F.lit(buckets)).cast("int").alias("bucket"), "t", *names)

    def placed(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray]:
        return _placed([(t or "").encode() for t in table.column("t").to_pylist()], parts, bits)

    def ask(table: pa.Table) -> pa.Table:
        bucket, low, own = table.column("bucket")[0].as_py(), np.uint64((1 << bits) - 1), []
        for kind, x in enumerate(placed(table)[0]):
            x = np.sort(x)
            x = x[np.append(True, x[1:] != x[:-1])]
            own += [(p, bucket, kind, _pack_keys(x[a:b] & low)) for p, a, b in _cuts(x, bits)]
        tidy()
        return pa.table([pa.array(x, t) for x, t in zip(zip(*own), (pa.int32(), pa.int32(), pa.int32(), pa.binary()))], ["p", "bucket", "kind", "a"])

    def answer(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        keys, columns = (_unpack_keys(known["a"].iloc[0]), _unpack_counts(known["c"].iloc[0], len(_COLUMNS))) if len(known) else _summed(known, len(_COLUMNS))
        keys, columns = np.append(keys, ~np.uint64(0)), np.pad(columns, ((0, 0), (0, 1)))
        out = []
        for p, bucket, kind, a in zip(asked["p"], asked["bucket"], asked["kind"], asked["a"]):
            own = _unpack_keys(a)
            at = np.searchsorted(keys, own)
            at[keys[at] != own] = len(keys) - 1
            out.append((p, bucket, kind, _pack_counts(*columns[: _ASKED[kind], at])))
        tidy()
        return pd.DataFrame(out, columns=["p", "bucket", "kind", "c"])

    def score(table: pa.Table, found: pa.Table) -> pa.Table:
        keys, begins = placed(table)
        head = begins[:-1]
        answers = dict(zip(zip(found.column("kind").to_pylist(), found.column("p").to_pylist()), found.column("c").to_pylist()))
        at, got = [], []
        for kind, n in enumerate(_ASKED):
            x, _, back = _distinct(keys[kind])
            keys[kind] = None
            at.append(back)
            got.append(np.concatenate([_unpack_counts(answers[kind, p], n) for p, _, _ in _cuts(x, bits)], axis=1))
        words, pairs, trigrams = got
        (word, before), (pair, above) = ((x[:-1], np.roll(x[:-1], 1)) for x in at[:2])
        before[head], above[head] = at[0][-1], at[1][-1]
        single = _single_words(words[0], first)
        contrast = np.where(words[5] > 0, np.maximum(np.log10(_single_words(words[5], unwanted) / single), 0.0), 0.0)
        p = _mixed(pairs[0, pair], words[1:5], before, _discounts(second), single[word])
        p = _mixed(trigrams[0, at[2]], pairs[1:5], above, _discounts(third), p)
        columns = [*map(table.column, names), pa.array(np.diff(begins)), pa.array(np.add.reduceat(np.log10(p), head)), pa.array(np.maximum.reduceat(contrast[word], head))]
        tidy()
        return pa.table(columns, [*names, "n_tokens", "lp", "contrast"])

    asked = rows.groupBy("bucket").applyInArrow(ask, "p int, bucket int, kind int, a binary")
    found = asked.groupBy("p").cogroup(model.rows.groupBy("p")).applyInPandas(answer, "p int, bucket int, kind int, c binary")
    out = StructType([*others, *[StructField(c, t) for c, t in (("n_tokens", LongType()), ("lp", DoubleType()), ("contrast", DoubleType()))]])
    return rows.groupBy("bucket").cogroup(found.groupBy("bucket")).applyInArrow(score, out)


def _dealt(known: DataFrame, train_docs: int | None, share: float, scratch: Scratch, name: str) -> DataFrame:
    """known (id, t, lang) with fold, a hash of the id in [0, 1), and part, the share of the row's
    language that a model learns from: share, or if train_docs is given so many documents in all in
    expectation, half of them dealt evenly over the languages, but half of a language at most."""
    fold = F.pmod(F.xxhash64("id", F.lit(17)), F.lit(1 << 20)) / float(1 << 20)
    if train_docs is None:
        return known.withColumn("fold", fold).withColumn("part", F.lit(share))
    sizes = scratch.write(known.groupBy(F.col("lang").alias("of")).agg(F.count(F.lit(1)).alias("n")), name)
    n, languages = sizes.agg(F.sum("n"), F.count(F.lit(1))).first()
    n, languages = max(1, n or 0), max(1, languages)
    part = F.least(F.lit(0.5), train_docs / 2 * (1 / F.lit(float(n)) + 1 / (languages * F.col("n"))))
    sizes = checked(sizes.select("of", part.alias("part")))
    return known.withColumn("fold", fold).join(sizes, F.col("lang").eqNullSafe(F.col("of")))


def _names_of(text: Column) -> list[Column]:
    """Two hashes that a text is known by."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def classify(
    docs: DataFrame, labels: DataFrame, *, training: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    trusted: str = "quality = 1 AND coalesce(toxic, 0) = 0", unwanted: str = "toxic = 1", train_docs: int | None = None, calibrate_docs: int | None = None, quantile: float = QUANTILE,
    prior: float = PRIOR,
) -> DataFrame:
    """Every row of docs with what the classifier says of it: (row struct, n_tokens, perplexity,
    threshold, contrast, limit, kept). n_tokens counts each text's end; the threshold is the
    perplexity up to which a text of that length and language is kept, the limit the same of the
    contrast: how much likelier, as log10, its most telling word is among unwanted documents.

    Learns from all rows of training (docs, unless given) whose id labels names: TAUGHT of the trusted
    ones, by a hash of the id, make the model and all other trusted ones the thresholds; all unwanted
    ones make the second model. If given, train_docs is how many documents, in expectation, teach
    each model, half of them dealt evenly over the languages, and calibrate_docs how many make the
    thresholds. A null language, or one of fewer than LEAST calibration documents, takes the
    thresholds of all. A null or wordless text is not kept; without trusted documents every other
    text is, and without unwanted ones every contrast is 0. Texts are scored whole; a bucket holds one
    text at least. Words are known by 32 bits of their hashes, n-grams by KEY_BITS within a partition.
    Repeated rows each give a row; an empty table gives none; extra columns pass through in row,
    whatever their names."""
    training = docs if training is None else training
    scratch = Scratch(docs.sparkSession, "trusted")
    size = max(x.agg(F.sum(F.octet_length(F.col(text_col).cast("string"))).alias("b")).first()["b"] or 0 for x in ([docs] if training is docs else [docs, training]))
    buckets, parts = max(FEWEST, math.ceil(size / (BUCKET_MB * 1e6))), min(MOST_PARTS, max(FEWEST, math.ceil(size / (PART_MB * 1e6))))
    bits = KEY_BITS + max(0, math.ceil(math.log2(max(1, size) / (parts * PART_MB * 1e6))))
    known = training.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t"), F.col(lang_col).cast("string").alias("lang"))
    known = known.where(F.trim(F.coalesce("t", F.lit(""))) != "")
    good, bad = (checked(scratch.write(labels.where(rule).select(F.col(id_col).alias("id")).distinct(), name)) for rule, name in ((trusted, "good"), (unwanted, "bad")))
    dealt = _dealt(known.join(good, "id"), train_docs, TAUGHT, scratch, "sizes")
    others = _dealt(known.join(bad, "id"), train_docs, 1.0, scratch, "bad-sizes")
    taught = [x.where("fold < part").select("t", F.lit(k).alias("unwanted")) for x, k in ((dealt, False), (others, True))]
    model = ShardedModel(taught[0].unionByName(taught[1]), parts, bits, scratch)
    held = dealt.where("fold >= part")
    if calibrate_docs is not None:
        held = held.where(F.col("fold") < F.col("part") + calibrate_docs / max(1, dealt.count()))
    held = scratch.write(_scores(model, held.select(F.xxhash64("id", "t").alias("salt"), "t", "lang"), buckets), "held")
    mean = (F.sum("lp") / F.sum("n_tokens")).alias("mean")
    drawn = (F.col("lp") + prior * F.col("mean")) / (F.col("n_tokens") + prior)
    least = F.percentile_approx(drawn, 1 - quantile, 100_000).alias("least")
    most = F.percentile_approx("contrast", quantile, 100_000).alias("most")
    common = held.agg(mean).first()["mean"]
    common = (0.0, -math.inf, math.inf) if common is None else (common, *held.withColumn("mean", F.lit(common)).agg(least, most).first())
    own = held.where("lang IS NOT NULL").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), mean).where(F.col("n") >= LEAST)
    own = scratch.write(held.join(own, "lang").groupBy("lang", "mean").agg(least, most), "limits")
    release(docs.sparkSession)
    own = checked(own.select(F.col("lang").alias("of"), "mean", "least", "most"))
    scratch.drop("held", "good", "bad", "sizes", "bad-sizes")

    texts = docs.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("salt"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    texts = texts.select("*", *_names_of(F.col("t")))
    found = []
    for k in range(PASSES):
        mine = texts.where(F.pmod(F.xxhash64("salt"), F.lit(PASSES)) == k)
        scored = _scores(model, mine, max(1, buckets // PASSES)).groupBy("h1", "h2").agg(*[F.max(c).alias(c) for c in ("n_tokens", "lp", "contrast")])
        found.append(scratch.write(scored, f"scores{k}"))
        release(docs.sparkSession)
    scratch.drop("model")
    scored = reduce(DataFrame.unionByName, found).groupBy("h1", "h2").agg(*[F.max(c).alias(c) for c in ("n_tokens", "lp", "contrast")])
    scored = checked(scratch.write(scored, "scores"))
    scratch.drop(*[f"scores{k}" for k in range(PASSES)])

    rows = docs.select(F.struct(*[docs[c].cast("string").alias(c) if c == text_col else docs[c] for c in docs.columns]).alias("row"))
    rows = rows.select("row", *_names_of(F.coalesce(F.col("row")[text_col], F.lit(""))))
    out = rows.join(scored, ["h1", "h2"], "left").join(own, F.col("row")[lang_col].cast("string") == F.col("of"), "left")
    for name, value in zip(("mean", "least", "most"), common):
        out = out.withColumn(name, F.coalesce(name, F.lit(value)))
    size = F.col("n_tokens")
    lowest = (F.col("least") * (size + prior) - F.col("mean") * prior) / size
    threshold = F.pow(F.lit(10.0), -lowest)
    perplexity = F.pow(F.lit(10.0), -F.col("lp") / size)
    kept = (size > 1) & (drawn >= F.col("least")) & (F.col("contrast") <= F.col("most"))
    return out.select("row", "n_tokens", perplexity.alias("perplexity"), threshold.alias("threshold"), "contrast", F.col("most").alias("limit"), kept.alias("kept"))
