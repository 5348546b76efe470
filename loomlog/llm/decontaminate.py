"""Benchmark decontamination over a distributed positional inverted index, in SQL functions only.

The index stores the postings (document, position) of every corpus token whose term some benchmark
item holds, and one more posting, of the empty term, behind each document's last word. Each window
of an item is looked up by its rarest term; a posting there gives a candidate alignment (item,
document, document position less item position). The lists of the item's other terms, moved by
their offsets, are intersected with the candidates, and runs of matched positions are the phrases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, checked

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words: ASCII but digits and lower-case letters.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; no other letter changes."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)
    low = F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.array_remove(F.split(low, _BETWEEN, -1), "")


class Index:
    """Tables of one corpus and one benchmark: terms (key, item_id, n, ipos, t), postings (k, id,
    pos, t), where t is 0 for the posting behind the last word."""

    def __init__(self, docs: DataFrame, bench: DataFrame, *, id_col: str, text_col: str, item_col: str, item_text_col: str):
        self.scratch = Scratch(docs.sparkSession, "index")
        items = bench.select(F.col(item_col).alias("item_id"), words(F.col(item_text_col)).alias("w"))
        items = items.withColumn("key", F.xxhash64("item_id", "w")).dropDuplicates(["key"])
        each = items.select("key", "item_id", F.size("w").alias("n"), F.posexplode("w").alias("ipos", "term"))
        each = each.withColumn("t", F.xxhash64("term"))
        self.terms = self.scratch.write(each, "terms")
        vocabulary = self.terms.select("term", "t").distinct().unionByName(docs.sparkSession.sql("select '' term, 0L t"))
        vocabulary = self.scratch.write(vocabulary, "vocabulary")
        rows = docs.select(F.xxhash64(id_col, text_col).alias("k"), F.col(id_col).alias("id"), words(F.col(text_col)).alias("w"))
        rows = rows.select("k", "id", F.posexplode(F.array_append("w", F.lit(""))).alias("pos", "term"))
        found = rows.join(checked(vocabulary), "term").select("k", "id", "pos", "t")
        self.postings = self.scratch.write(found, "postings")

    def anchors(self, width: int) -> DataFrame:
        """The rarest term (item key, ipos, t) of each window of `width` words, or of the whole item
        where it is shorter; windows with a term that the corpus lacks cannot occur."""
        count = self.postings.groupBy("t").agg(F.count(F.lit(1)).alias("df"))
        spots = self.terms.join(count, "t", "left").withColumn("df", F.coalesce("df", F.lit(0)))
        starts = F.sequence(F.greatest(F.lit(0), F.col("ipos") - width + 1), F.greatest(F.lit(0), F.least(F.col("ipos"), F.col("n") - width)))
        spots = spots.select("key", F.struct("df", "ipos", "t").alias("x"), F.explode(starts).alias("start"))
        rare = spots.groupBy("key", "start").agg(F.min("x").alias("x")).where("x.df > 0")
        return rare.select("key", F.col("x.ipos").alias("ipos"), F.col("x.t").alias("t")).distinct()

    def alignments(self, width: int) -> DataFrame:
        """Matched positions (key, k, diag, ipos) of every candidate alignment."""
        anchors = self.scratch.write(self.anchors(width), "anchors")
        found = self.postings.join(checked(anchors), "t").select("key", "k", (F.col("pos") - F.col("ipos")).alias("diag")).distinct()
        found = self.scratch.write(found, "candidates")
        some = self.scratch.write(found.select("k").distinct(), "documents")
        own = self.postings.join(checked(some), "k", "left_semi").select("k", "pos", "t")
        wanted = found.join(checked(self.terms.select("key", "ipos", "t")), "key")
        wanted = wanted.select("key", "k", "diag", "ipos", "t", (F.col("diag") + F.col("ipos")).alias("pos"))
        return wanted.join(own, ["k", "pos", "t"]).select("key", "k", "diag", "ipos").distinct()


def _runs(matched: DataFrame, terms: DataFrame, width: int) -> DataFrame:
    by = Window.partitionBy("key", "k", "diag").orderBy("ipos")
    runs = matched.withColumn("g", F.col("ipos") - F.row_number().over(by)).groupBy("key", "k", "diag", "g")
    runs = runs.agg(F.min("ipos").alias("lo"), F.max("ipos").alias("hi"))
    items = terms.select("key", "item_id", "n").distinct()
    runs = runs.join(items, "key").where(F.col("hi") - F.col("lo") + 1 >= F.least(F.lit(width), F.col("n")))
    return runs.select("item_id", "k", F.col("lo").alias("item_from"), (F.col("diag") + F.col("lo")).alias("doc_from"), (F.col("hi") - F.col("lo") + 1).alias("n_words"))


def phrase_matches(docs: DataFrame, bench: DataFrame, *, width: int = 13, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Exact phrases (item_id, id_col, item_from, doc_from, n_words): maximal runs of item words in
    documents, of `width` words or of a whole shorter item at least; word positions from 0."""
    index = Index(docs, bench, id_col=id_col, text_col=text_col, item_col=item_col, item_text_col=item_text_col)
    ids = index.postings.where("t = 0").select("k", F.col("id").alias(id_col))
    return _runs(index.alignments(width), index.terms, width).join(ids, "k").drop("k")


def proximity_matches(docs: DataFrame, bench: DataFrame, *, width: int = 13, least: float = 0.7, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Near matches (item_id, id_col, doc_from, matched, of): alignments at the rarest term of any
    third of a window where at least that share of the `width` words around a matched word stand in their places."""
    index = Index(docs, bench, id_col=id_col, text_col=text_col, item_col=item_col, item_text_col=item_text_col)
    ahead = Window.partitionBy("key", "k", "diag").orderBy("ipos").rangeBetween(0, width - 1)
    x = index.alignments(max(1, width // 3)).withColumn("matched", F.count(F.lit(1)).over(ahead))
    items = index.terms.select("key", "item_id", F.least(F.lit(width), F.col("n")).alias("of")).distinct()
    x = x.join(items, "key").where(F.col("matched") >= F.col("of") * least)
    ids = index.postings.where("t = 0").select("k", F.col("id").alias(id_col))
    return x.join(ids, "k").select("item_id", id_col, (F.col("diag") + F.col("ipos")).alias("doc_from"), "matched", "of")


def contamination(docs: DataFrame, bench: DataFrame, *, width: int = 13, part: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row for each document: id_col, n_words, n_hit (words inside an occurrence of a window),
    n_items (items with occurring windows), items_sha256 (of their ids, sorted as strings and joined
    by commas), contaminated (n_hit > 0 and part * n_hit >= n_words).

    A window is `width` consecutive words of an item; an item of fewer, but not none, is one window.
    A null text has no words; texts are read whole. Repeated rows each give a row, and rows that share
    an id are documents of their own; documents, items and terms are known by 64-bit hashes. Items
    with a null id hit words but are not counted; repeated items count once. Empty tables give no
    hits or no rows; other columns are ignored, whatever their names."""
    index = Index(docs, bench, id_col=id_col, text_col=text_col, item_col=item_col, item_text_col=item_text_col)
    runs = index.scratch.write(_runs(index.alignments(width), index.terms, width), "runs")
    spots = runs.select("k", F.explode(F.sequence(F.col("doc_from"), F.col("doc_from") + F.col("n_words") - 1)).alias("pos")).distinct()
    hits = spots.groupBy("k").agg(F.count(F.lit(1)).alias("n_hit"))
    items = runs.where("item_id is not null").select("k", F.col("item_id").cast("string").alias("i")).distinct()
    items = items.groupBy("k").agg(F.sort_array(F.collect_list("i")).alias("items"))
    found = index.scratch.write(hits.join(items, "k", "left"), "hits")
    index.scratch.drop("terms", "vocabulary", "anchors", "candidates", "documents", "runs")
    out = index.postings.where("t = 0").select("k", F.col("id").alias(id_col), F.col("pos").cast("long").alias("n_words"))
    out = out.join(checked(found), "k", "left").withColumn("n_hit", F.coalesce("n_hit", F.lit(0)).cast("long"))
    names = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        id_col, "n_words", "n_hit", F.size(names).cast("long").alias("n_items"), F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * part >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, bench: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of docs that are not contaminated; rows with a null id stay."""
    bad = contamination(docs, bench, id_col=id_col, **options).where("contaminated").select(F.col(id_col).alias("_bad")).distinct()
    bad = checked(Scratch(docs.sparkSession, "contaminated").write(bad, "ids"))
    return docs.join(bad, docs[id_col] == bad["_bad"], "left_anti")


#: DuckDB SQL of contamination() over documents and benchmark.
SQL = r"""
WITH b AS (
  SELECT DISTINCT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS l, list_slice(w, s, s + least(13, len(w)) - 1) AS p
  FROM b, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS u(s) WHERE len(w) > 0
), d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), spots AS (
  SELECT doc_id, s, l, list_slice(w, s, s + l - 1) AS p
  FROM d, (SELECT DISTINCT l FROM win) AS x, unnest(range(1, len(w) - l + 2)) AS u(s)
), hit AS (
  SELECT doc_id, s, spots.l, item_id FROM spots JOIN win ON spots.l = win.l AND spots.p = win.p
), n AS (
  SELECT doc_id, count(DISTINCT s + k) AS n_hit FROM hit, unnest(range(0, l)) AS u(k) GROUP BY doc_id
), i AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM hit GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN i USING (doc_id)
"""
