"""Suffix-array dedup: removal of bytes that a string of `width` bytes starting earlier covers.

Every window of `width` bytes has an anchor, the position of its smallest 32-byte hash, which
depends on the window's bytes alone; equal windows have equal anchors at equal places. Windows of
one anchor form a suffix record: the text from the anchor on (its leading tokens first), then the
text before it. Only suffixes whose anchor hash occurs more than once in the corpus can repeat.
Splitters sampled from these range-partition them by text, document and position, in two steps if
one step would ask more splitters than a task should hold; each partition is sorted by multikey
quicksort on eight-byte words, equal neighbours are repeats of their first, and anchors whose
suffixes differ are compared window by window. A group that reaches a partition's border sends the
first of each of its windows to be compared across borders."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import _CODE, Scratch, checked, mix64, text_bytes, tidy
from .lm import by_part, pack_sorted, shard_of, unpack_sorted

#: Bytes of an anchor's hash; MB of text in a bucket and bytes in a range partition; fewest of them.
GRAM, BUCKET_MB, FEWEST = 32, 8, 48
#: Splitters are drawn from about so many suffixes for each range partition; ranges of one step.
SAMPLED, RANGES = 40, 4096
#: Most partitions of the hash space: a bucket's array for each of them keeps a few hashes at any size.
HASH_PARTS = 1 << 15
#: Rows up to which a segment is sorted by all its words at once instead of being parted further.
SMALL = 256
_STEP = 0x9E3779B97F4A7C15 | 1
_PLACE = (1 << 26) - 1
_SLICE = 1 << 20


def gram_hashes(buf: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-byte strings (n a power of two) at each position."""
    h, k, step = _CODE[buf], 1, _STEP
    while k < n:
        h = h[:-k] * np.uint64(step) + h[k:]
        step = step * step % (1 << 64)
        k *= 2
    return mix64(h)


def window_anchors(buf: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of `width` bytes: its anchor's place, the leftmost of the smallest hashes in
    it, and that hash."""
    n = len(buf) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = gram_hashes(buf, GRAM)
    key = h & ~np.uint64(_PLACE) | np.arange(len(h), dtype=np.uint64)
    span = width - GRAM + 1
    full = -(-len(key) // span) * span
    x = np.full(full, np.iinfo(np.uint64).max)
    x[: len(key)] = key
    blocks = x.reshape(-1, span)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(blocks, axis=1).ravel()
    at = (np.minimum(ahead[:n], behind[span - 1 : span - 1 + n]) & np.uint64(_PLACE)).astype(np.int64)
    return at, h[at]


def suffix_records(texts: list[bytes], width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Blocks of (text number, anchor, first window, last window, hash), places within the text, of
    each run of windows with one anchor."""
    lo = 0
    while lo < len(texts):
        hi, size = lo + 1, len(texts[lo])
        while hi < len(texts) and size + len(texts[hi]) <= _SLICE:
            size += len(texts[hi])
            hi += 1
        whole = np.frombuffer(b"".join(texts[lo:hi]), np.uint8)
        lens = np.fromiter((len(t) for t in texts[lo:hi]), np.int64, hi - lo)
        ends = np.cumsum(lens)
        for a in range(0, len(whole), 2 * _SLICE):  # a longer text goes in slices, windows whole
            at, h = window_anchors(whole[a : a + 2 * _SLICE + width - 1], width)
            first = np.arange(a, a + len(at))
            doc = np.searchsorted(ends, first, "right")
            ok = np.flatnonzero(first + width <= ends[doc])
            if not len(ok):
                continue
            at, h, first, doc = at[ok] + a, h[ok], first[ok], doc[ok]
            cut = np.flatnonzero((np.diff(at, prepend=-1) != 0) | (np.diff(doc, prepend=-1) != 0))
            last = np.append(cut[1:], len(at)) - 1
            base = (ends - lens)[doc[cut]]
            yield doc[cut] + lo, at[cut] - base, first[cut] - base, first[last] - base, h[cut]
        lo = hi


def multikey_order(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows and the column at which each first differs from the row before it (the
    number of columns where it doesn't).

    Multikey quicksort (Bentley and Sedgewick, 1997): a segment is parted in three by the median of
    three of its words - smaller, equal, larger - and the equal ones go on with their next word.
    Small segments are sorted by what is left of their words."""
    n, depth = words.shape
    order = np.arange(n)
    todo = [(0, n, 0)]
    while todo:
        lo, hi, d = todo.pop()
        own = order[lo:hi]
        if hi - lo < 2 or d == depth:
            continue
        if hi - lo <= SMALL:
            order[lo:hi] = own[np.lexsort(words[own, d:].T[::-1])]
            continue
        x = words[own, d]
        pivot = np.sort(x[[0, len(x) // 2, -1]])[1]
        parts = [own[x < pivot], own[x == pivot], own[x > pivot]]
        order[lo:hi] = np.concatenate(parts)
        a, b = lo + len(parts[0]), hi - len(parts[2])
        todo += [(lo, a, d), (a, b, d + 1), (b, hi, d)]
    head = np.full(n, depth)
    head[:1] = 0
    for lo in range(1, n, 1 << 14):  # in blocks, as words may be many
        at = order[lo - 1 : lo + (1 << 14)]
        other = words[at[1:]] != words[at[:-1]]
        head[lo : lo + len(other)] = np.where(other.any(1), other.argmax(1), depth)
    return order, head


def _words(buf: np.ndarray, start: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
    """The first `width` bytes of each string as big-endian words, zero beyond its end."""
    width += -width % 8
    place = np.arange(width)
    x = buf[np.minimum(start[:, None] + place, len(buf) - 1)]
    x[place >= size[:, None]] = 0
    return x.view(">u8").astype(np.uint64)


def _width_hashes(buf: np.ndarray, width: int, code: np.ndarray) -> np.ndarray:
    """Hashes of the width-byte strings at each position."""
    n, h, k, step, at = len(buf) - width + 1, code[buf], 1, _STEP, 0
    out = np.zeros(max(0, n), np.uint64)
    while k <= width:
        if width & k:
            out = out * np.uint64(step) + h[at : at + len(out)]
            at += k
        if 2 * k <= width:
            h = h[:-k] * np.uint64(step) + h[k:]
        step = step * step % (1 << 64)
        k *= 2
    return mix64(out)


_CODES = (_CODE, mix64(_CODE) | np.uint64(1))


def _sooner(place: tuple[np.ndarray, ...], tie: np.ndarray) -> np.ndarray:
    """Of runs of ties, the rows whose place differs from their run's first."""
    run = np.maximum.accumulate(np.where(tie, 0, np.arange(len(tie))))
    other = np.zeros(len(tie), bool)
    for x in place:
        other |= x != x[run]
    return tie & other


def compare_suffixes(x: dict[str, np.ndarray], width: int, edges: bool) -> tuple[list[tuple], list[tuple]]:
    """Removed ranges (row, from, to) among suffixes of one range partition, and for the groups at
    its borders (edges) the first of each window: (hash, hash, row, from). x: buf (each suffix's
    text before its anchor, then from it on), before, after (their lengths), id and k (the document),
    at (the anchor)."""
    buf, before, after, ids, ks, at = (x[k] for k in ("buf", "before", "after", "id", "k", "at"))
    if not len(ids):
        return [], []
    begin = np.cumsum(before + after) - before - after
    sign = np.int64(-(1 << 63))
    place = np.stack([before << 16 | after, ids ^ sign, ks ^ sign, at], axis=1).view(np.uint64)
    words = np.concatenate([_words(buf, begin + before, after, width), _words(buf, begin, before, width), place], axis=1)
    order, head = multikey_order(words)
    ids, ks, at, before, after, begin = ids[order], ks[order], at[order], before[order], after[order], begin[order]
    group = np.cumsum(head < GRAM // 8) - 1
    border = np.zeros(group[-1] + 1, bool)
    if edges:
        border[[0, -1]] = True
    same = head >= words.shape[1] - 3  # text and lengths are those of the suffix before
    late = np.flatnonzero(_sooner((ids, ks, at), same))
    gone = [(order[late], (at - before)[late], (at + after)[late])]
    kinds = np.bincount(group[~same], minlength=len(border))
    firsts = np.flatnonzero(~same & ((kinds > 1) | border)[group])
    asked = []
    size = (before + after)[firsts]
    while len(firsts):  # whole groups, some MB at a time
        n = max(1, int(np.searchsorted(np.cumsum(size), _SLICE)))
        while n < len(firsts) and group[firsts[n]] == group[firsts[n - 1]]:
            n += 1
        some, own = firsts[:n], size[:n]
        firsts, size = firsts[n:], size[n:]
        near = np.cumsum(own) - own
        part = buf[np.repeat(begin[some] - near, own) + np.arange(own.sum())]
        each = own - width + 1
        row = np.repeat(np.arange(n), each)
        off = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        a, b = (_width_hashes(part, width, c)[near[row] + off] for c in _CODES)
        doc, text, start = ids[some][row], ks[some][row], (at - before)[some][row] + off
        by = np.lexsort((start, text, doc, b, a))
        a, b, doc, text, start, row = a[by], b[by], doc[by], text[by], start[by], row[by]
        tie = np.zeros(len(a), bool)
        tie[1:] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
        late = np.flatnonzero(_sooner((doc, text, start), tie))
        gone.append((order[some][row[late]], start[late], start[late] + width))
        ask = np.flatnonzero(~tie & border[group[some]][row])
        asked.append((a[ask].view(np.int64), b[ask].view(np.int64), order[some][row[ask]], start[ask]))
    return gone, asked


def _merged(doc: np.ndarray, text: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges of the same document (doc, text) that touch or overlap made one."""
    by = np.lexsort((lo, text, doc))
    doc, text, lo, hi = doc[by], text[by], lo[by], hi[by]
    if not len(doc):
        return doc, text, lo, hi
    head = np.ones(len(doc), bool)
    head[1:] = (doc[1:] != doc[:-1]) | (text[1:] != text[:-1])
    shift = np.cumsum(head) * (int(hi.max()) + 1)  # so that running maxima start anew with each document
    reach = np.maximum.accumulate(hi + shift)
    new = head.copy()
    new[1:] |= lo[1:] + shift[1:] > reach[:-1]
    cut = np.flatnonzero(new)
    last = np.append(cut[1:], len(doc)) - 1
    return doc[cut], text[cut], lo[cut], (reach - shift)[last]


def _ints(*arrays: np.ndarray) -> bytes:
    return np.concatenate([np.asarray(a, np.int64) for a in arrays]).tobytes()


def _columns(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(blob, np.int64).reshape(n, -1)


def _whole(pdf: pd.DataFrame, found: pd.DataFrame) -> np.ndarray:
    """Which rows are copies of an earlier document's text and go whole."""
    pairs = {x for ids, ks in zip(found["ids"], found["ks"]) if ids is not None for x in zip(ids, ks)}
    return np.array([x in pairs for x in zip(pdf["id"], pdf["k"])], bool) if pairs else np.zeros(len(pdf), bool)


def _ranked(gram: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Columns by which suffixes are routed: the leading words and the id, as unsigned numbers."""
    return np.vstack([gram.T, (ids ^ np.int64(-(1 << 63))).view(np.uint64)])


def _unranked(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), ">u8").astype(np.uint64).reshape(-1, GRAM // 8 + 1).T


def _splitters(drawn: list[bytes], parts: int) -> np.ndarray:
    """Splitters of parts ranges from a sample of _ranked columns, in order."""
    drawn = sorted(drawn)
    return _unranked([drawn[k] for k in np.unique(np.linspace(0, len(drawn), parts + 1).astype(int)[1:-1])] if drawn else [])


def _part_of(keys: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    """How many splitters are no larger than each key: by a search on the first word, and of the few
    keys that share it with splitters on all words."""
    if not splitters.shape[1]:
        return np.zeros(keys.shape[1], np.int64)
    lo, hi = np.searchsorted(splitters[0], keys[0]), np.searchsorted(splitters[0], keys[0], "right")
    open_ = np.flatnonzero(lo < hi)
    while len(open_):
        at = (lo[open_] + hi[open_]) // 2
        less, tied = np.zeros(len(open_), bool), np.ones(len(open_), bool)  # key < splitter
        for k, s in zip(keys[:, open_], splitters[:, at]):
            less |= tied & (k < s)
            tied &= k == s
        hi[open_[less]] = at[less]
        lo[open_[~less]] = at[~less] + 1
        open_ = open_[lo[open_] < hi[open_]]
    return lo


def _groups(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order, cuts = by_part(part, part)
    return ((p, order[a:b]) for p, a, b in cuts)


def _packed(x: dict[str, np.ndarray], begin: np.ndarray, n: np.ndarray, k: np.ndarray) -> tuple[int, bytes, bytes, bytes]:
    """Suffixes k of x as a row: how many, their texts, lengths and places."""
    buf = x["buf"][np.repeat(begin[k] - np.cumsum(n[k]) + n[k], n[k]) + np.arange(n[k].sum())]
    return len(k), buf.tobytes(), x["before"][k].astype(np.uint8).tobytes() + x["after"][k].astype(np.uint8).tobytes(), _ints(x["id"][k], x["k"][k], x["at"][k])


def _unpacked(buf, size, place) -> dict[str, np.ndarray]:
    size = np.concatenate([np.frombuffer(b, np.uint8).reshape(2, -1) for b in size], axis=1).astype(np.int64)
    place = np.concatenate([np.frombuffer(b, np.int64).reshape(3, -1) for b in place], axis=1)
    return {"buf": np.frombuffer(b"".join(buf), np.uint8), "before": size[0], "after": size[1], "id": place[0], "k": place[1], "at": place[2]}


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = 100, bucket_mb: float = BUCKET_MB, carry: list[str] = (), ranges: int = RANGES) -> DataFrame:
    """One row for each document: id_col, n_bytes, spans (array of start and end of the maximal
    removed runs, in bytes), kept (binary: what is left), then the columns named in carry.

    A byte goes if a string of `width` bytes that covers it also starts earlier: in a smaller id or
    in the same document before. A null text is empty; texts of fewer bytes than width lose none. Of
    different texts that share an id, the one with the smaller 64-bit hash is earlier; rows of the
    same id and text are one document, each with its row. A null id comes last; ids are whole
    numbers; an empty table gives no rows; other columns are ignored, whatever their names. Texts are
    read whole, in slices of a few MB. Windows are compared by two 64-bit hashes where suffixes
    differ."""
    if width < GRAM + 8 or width > 255:
        raise ValueError(f"width must be from {GRAM + 8} to 255")
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffix")
    text = F.col(text_col).cast("string")
    size = docs.agg(F.sum(F.octet_length(text)).alias("b")).first()["b"] or 0
    buckets = max(FEWEST, math.ceil(size / (bucket_mb * 1e6)))
    parts, shards = buckets, min(buckets, HASH_PARTS)
    id_ = F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1))
    rows = docs.select(id_.alias("id"), F.col(id_col).isNull().alias("lost"), text_bytes(text_col).alias("t"), F.struct(F.lit(0).alias("_"), *[docs[c] for c in carry]).alias("x"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("id", "t"), F.lit(buckets)).cast("int")).select("bucket", "id", F.xxhash64("t").alias("k"), "lost", "t", "x")
    whole_rows, rows = rows, rows.drop("x")

    # exact copies: all but the smallest id go whole, and need no suffixes
    marks = rows.where(F.length("t") >= width).select("bucket", "id", "k", F.sha2("t", 256).alias("sha"))
    least = marks.groupBy("sha").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    least = scratch.write(least.select("sha", "least"), "least")
    copies = marks.join(checked(least, 200_000), "sha").where("id > least").select("bucket", "id", "k").distinct()
    copies = scratch.write(copies.groupBy("bucket").agg(F.collect_list("id").alias("ids"), F.collect_list("k").alias("ks")), "copies")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct anchor hashes of a task by bucket and part of the hash space, with flags of those seen twice."""
        hashes, where = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for batch in batches:
            own = batch.column(0).to_numpy().astype(np.int64)
            for doc, _, _, _, h in suffix_records(batch.column(1).to_pylist(), width):
                hashes.append(h)
                where.append(own[doc])
        h, own = np.concatenate(hashes), np.concatenate(where)
        by = np.lexsort((h, own))
        h, own = h[by], own[by]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
        cut = np.flatnonzero(new)
        twice = np.diff(np.append(cut, len(h))) > 1
        h, own = h[cut], own[cut]
        key = own * shards + shard_of(h, shards)
        order, cuts = by_part(h, key)
        out = [(k % shards, k // shards, pack_sorted(h[order[a:b]]), np.packbits(twice[order[a:b]]).tobytes()) for k, a, b in cuts]
        for lo in range(0, len(out), 10_000):
            cols = list(zip(*out[lo : lo + 10_000]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["p", "bucket", "a", "b"])

    def repeated(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [unpack_sorted(a) for a in pdf["a"]]
        times = np.concatenate([1 + np.unpackbits(np.frombuffer(b, np.uint8), count=len(k)) for b, k in zip(pdf["b"], keys)])
        own = np.repeat(pdf["bucket"].to_numpy(), [len(k) for k in keys])
        distinct, back = np.unique(np.concatenate(keys), return_inverse=True)
        often = np.bincount(back, times)[back] > 1
        back, own = back[often], own[often]
        by = np.lexsort((back, own))
        back, own = back[by], own[by]
        out = []
        for b in np.unique(own):
            out.append((int(b), pack_sorted(np.unique(distinct[back[slice(*np.searchsorted(own, [b, b + 1]))]]))))
        return pd.DataFrame(out, columns=["bucket", "a"])

    sent = rows.select("bucket", "t").mapInArrow(send, "p int, bucket int, a binary, b binary")
    alive = scratch.write(sent.groupBy("p").applyInPandas(repeated, "bucket int, a binary"), "alive")
    none = F.lit(None).cast("array<long>")
    guide = alive.withColumns({"ids": none, "ks": none}).unionByName(copies.select("bucket", F.lit(None).cast("binary").alias("a"), "ids", "ks"))

    def suffixes(pdf: pd.DataFrame, found: pd.DataFrame) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
        """Suffixes that may repeat, and their grams as words."""
        keys = [unpack_sorted(a) for a in found["a"] if a is not None]
        if not keys or not len(pdf):
            return
        keys = np.sort(np.concatenate(keys))
        pdf = pdf[~(_whole(pdf, found) | pdf.duplicated(["id", "k"]).to_numpy())]
        texts, ids, ks = pdf["t"].tolist(), pdf["id"].to_numpy(), pdf["k"].to_numpy()
        for doc, at, first, last, h in suffix_records(texts, width):
            ok = np.flatnonzero(keys[np.minimum(np.searchsorted(keys, h), len(keys) - 1)] == h)
            if not len(ok):
                continue
            doc, at, first, end = doc[ok], at[ok], first[ok], last[ok] + width
            lo, hi = int(doc[0]), int(doc[-1]) + 1
            whole = np.frombuffer(b"".join(texts[lo:hi]), np.uint8)
            lens = np.fromiter((len(t) for t in texts[lo:hi]), np.int64, hi - lo)
            base = (np.cumsum(lens) - lens)[doc - lo]
            n = end - first
            buf = whole[np.repeat(base + first - np.cumsum(n) + n, n) + np.arange(n.sum())]
            gram = _words(whole, base + at, np.full(len(at), GRAM), GRAM)
            yield {"buf": buf, "before": at - first, "after": end - at, "id": ids[doc], "k": ks[doc], "at": at}, gram

    def sample(key, pdf: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        out = [_ranked(gram, x["id"]) for x, gram in suffixes(pdf, found)]
        return pd.DataFrame({"g": [g.tobytes() for x in out for g in x.T.astype(">u8")]}, columns=["g"])

    steps = [min(parts, ranges)]
    if parts > ranges:
        steps.append(math.ceil(parts / ranges))
    share = min(1.0, SAMPLED * parts * 250.0 / max(1, size))  # a suffix for each 50 bytes, of which a fifth repeats
    some = rows.where(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    drawn = scratch.write(some.groupBy("bucket").cogroup(guide.groupBy("bucket")).applyInPandas(sample, "g binary"), "drawn")
    n = drawn.count()
    few = drawn if n <= SAMPLED * ranges else drawn.where(F.rand(7) < SAMPLED * ranges / n)  # to the driver: SAMPLED * ranges in expectation, at any size
    splitters = _splitters([r["g"] for r in few.collect()], steps[0])

    def route(key, pdf: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        out = []
        for x, gram in suffixes(pdf, found):
            part = _part_of(_ranked(gram, x["id"]), splitters)
            n = x["before"] + x["after"]
            begin = np.cumsum(n) - n
            out += [(p, int(key[0]), *_packed(x, begin, n, k)) for p, k in _groups(part)]
        tidy()
        return pd.DataFrame(out, columns=["p", "bucket", "n", "buf", "size", "place"])

    routed = rows.groupBy("bucket").cogroup(guide.groupBy("bucket")).applyInPandas(route, "p int, bucket int, n long, buf binary, size binary, place binary")
    if len(steps) > 1:  # each range has splitters of its own, from its part of the sample

        def finer(key, pdf: pd.DataFrame) -> pd.DataFrame:
            cut = _splitters(pdf["g"].tolist(), steps[1])
            return pd.DataFrame([(int(key[0]), cut.astype(">u8").T.tobytes())], columns=["p", "g"])

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                part = _part_of(_unranked(batch.column(0).to_pylist()), splitters)
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), batch.column(0)], ["p", "g"])

        def again(key, pdf: pd.DataFrame, cut: pd.DataFrame) -> pd.DataFrame:
            out, own = [], _unranked([cut["g"].iloc[0]] if len(cut) else [])
            for bucket, n, buf, size, place in zip(pdf["bucket"], pdf["n"], pdf["buf"], pdf["size"], pdf["place"]):
                x = _unpacked([buf], [size], [place])
                n = x["before"] + x["after"]
                begin = np.cumsum(n) - n
                gram = _words(x["buf"], begin + x["before"], np.full(len(n), GRAM), GRAM)
                part = _part_of(_ranked(gram, x["id"]), own)
                out += [(int(key[0]) * steps[1] + p, bucket, *_packed(x, begin, n, k)) for p, k in _groups(part)]
            return pd.DataFrame(out, columns=["p", "bucket", "n", "buf", "size", "place"])

        cuts = drawn.mapInArrow(place, "p int, g binary").groupBy("p").applyInPandas(finer, "p int, g binary")
        routed = routed.groupBy("p").cogroup(cuts.groupBy("p")).applyInPandas(again, "p int, bucket int, n long, buf binary, size binary, place binary")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        x = _unpacked(pdf["buf"], pdf["size"], pdf["place"])
        bucket = np.repeat(pdf["bucket"].to_numpy(), pdf["n"].to_numpy())
        gone, asked = compare_suffixes(x, width, edges=True)
        out = []
        if gone:
            row, lo, hi = (np.concatenate(c) for c in zip(*gone))
            own = bucket[row]
            for b in np.unique(own):
                k = own == b
                out.append((int(b), 0, 0, 0, 0, -1, _ints(*_merged(x["id"][row[k]], x["k"][row[k]], lo[k], hi[k]))))
        if asked:
            a, b, row, lo = (np.concatenate(c) for c in zip(*asked))
            out += zip(bucket[row].tolist(), a.tolist(), b.tolist(), x["id"][row].tolist(), x["k"][row].tolist(), lo.tolist(), [None] * len(row))
        tidy()
        return pd.DataFrame(out, columns=["bucket", "a", "b", "id", "k", "lo", "gone"])

    found = scratch.write(routed.groupBy("p").applyInPandas(compare, "bucket int, a long, b long, id long, k long, lo long, gone binary"), "found")
    scratch.drop("alive", "drawn", "least")
    both = Window.partitionBy("a", "b")  # a row for each range partition at most
    late = found.where("lo >= 0").withColumn("first", F.min(F.struct("id", "k", "lo")).over(both)).where(F.struct("id", "k", "lo") != F.col("first"))
    cols = ["bucket", "id", "k", "lo", "gone"]
    marked = found.where("lo < 0").select(cols).unionByName(late.select(cols)).withColumns({"ids": none, "ks": none})
    marked = marked.unionByName(copies.select("bucket", F.lit(0).cast("long").alias("id"), F.lit(0).cast("long").alias("k"), F.lit(-1).cast("long").alias("lo"), F.lit(None).cast("binary").alias("gone"), "ids", "ks"))

    def cut_out(key, pdf: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return pd.DataFrame(columns=["id", "lost", "n_bytes", "spans", "kept", "x"])
        gone = [_columns(b, 4) for b in found["gone"] if b is not None]
        single = found[found["lo"] >= 0]
        lo = single["lo"].to_numpy(np.int64)
        gone.append(np.stack([single["id"].to_numpy(np.int64), single["k"].to_numpy(np.int64), lo, lo + width]))
        whole, own_of = _whole(pdf, found), {}
        for i, k, p, q in zip(*(x.tolist() for x in _merged(*np.concatenate(gone, axis=1)))):
            own_of.setdefault((i, k), []).append((p, q))
        spans, kept = [], []
        for i, k, t, copy in zip(pdf["id"], pdf["k"], pdf["t"], whole):
            own = [(0, len(t))] if copy else own_of.get((i, k), [])
            at, left = 0, []
            for p, q in own:
                left.append(t[at:p])
                at = q
            spans.append([{"start": p, "end": q} for p, q in own])
            kept.append(b"".join([*left, t[at:]]))
        tidy()
        return pd.DataFrame({"id": pdf["id"], "lost": pdf["lost"], "n_bytes": [len(t) for t in pdf["t"]], "spans": spans, "kept": kept, "x": pdf["x"]})

    kind = whole_rows.schema["x"].dataType.simpleString()
    out = whole_rows.groupBy("bucket").cogroup(marked.groupBy("bucket")).applyInPandas(cut_out, f"id long, lost boolean, n_bytes long, spans array<struct<start:long,end:long>>, kept binary, x {kind}")
    kind = docs.schema[id_col].dataType
    return out.select(F.when(~F.col("lost"), F.col("id")).cast(kind).alias(id_col), "n_bytes", "spans", "kept", *[F.col("x")[c].alias(c) for c in carry])


def digests(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """(id_col, n_bytes, n_removed, n_spans, kept_sha256) of remove_repeats' rows."""
    out = remove_repeats(docs, id_col=id_col, **options)
    return out.select(id_col, "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(docs: list[tuple[int, bytes]], width: int = 100) -> dict[int, tuple[list[tuple[int, int]], str]]:
    """Removed runs and digest of what is left, window by window; for tests."""
    first: dict[bytes, tuple[int, int]] = {}
    for i, t in sorted(docs):
        for p in range(len(t) - width + 1):
            first.setdefault(t[p : p + width], (i, p))
    out = {}
    for i, t in docs:
        gone = bytearray(len(t))
        for p in range(len(t) - width + 1):
            if first[t[p : p + width]] < (i, p):
                gone[p : p + width] = b"\1" * width
        runs, p = [], 0
        while (p := gone.find(1, p)) >= 0:
            q = gone.find(0, p)
            q = len(t) if q < 0 else q
            runs.append((p, q))
            p = q
        out[i] = (runs, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest())
    return out


#: DuckDB SQL of digests() over documents.
SQL = """
WITH d AS (
  SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), w AS (
  SELECT doc_id, p, md5(array_slice(b, p + 1, p + 100)) AS k FROM d, unnest(range(0, n - 99)) AS u(p)
), late AS (
  SELECT doc_id, p FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS r FROM w) WHERE r > 1
), mark AS (
  SELECT *, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS fresh FROM late
), run AS (
  SELECT doc_id, min(p) AS a, max(p) + 100 AS z FROM (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p ROWS UNBOUNDED PRECEDING) AS g FROM mark) GROUP BY doc_id, g
), edge AS (
  SELECT doc_id, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS x, a AS y FROM run
  UNION ALL SELECT doc_id, coalesce(z, 0), n FROM d LEFT JOIN (SELECT doc_id, max(z) AS z FROM run GROUP BY doc_id) USING (doc_id)
), kept AS (
  SELECT doc_id, string_agg(CASE WHEN y > x THEN hex(array_slice(b, x + 1, y)) ELSE '' END, '' ORDER BY x, y) AS h, count(*) - 1 AS n_spans FROM edge JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(n - length(h) // 2 AS BIGINT) AS n_removed, CAST(n_spans AS BIGINT) AS n_spans, sha256(unhex(h)) AS kept_sha256 FROM d JOIN kept USING (doc_id)
"""
