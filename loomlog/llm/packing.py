"""Best-fit packing of tokenised documents by bin completion with branch and bound.

Lengths are whole numbers of at most `capacity`, so the histogram of piece lengths - at most that
many counts, however large the corpus - is the whole packing problem. The driver solves it: around
the largest piece left, undominated fillings are enumerated, the least waste first, applied as often
as the counts allow or less often, and pruned by the waste that a solution better than the incumbent
may have; best-fit decreasing gives the first incumbent. The search skips no case: given nodes
enough it ends with a proven optimum, and pack() says whether it did. Pieces then find their places
by rank among those of their length."""

from __future__ import annotations

import os
import re
import sys
import types
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, blocks_of, tidy

#: Pieces of one length are ranked in groups of about GROUP, or a GROUPS-th of all if that is more.
GROUP, GROUPS = 256, 1 << 16
#: Nodes of each of the two searches, and fillings they look at, unless the lower bound is met before.
NODES = 8000
#: Fillings that are looked at first, and branches that lead to them.
LIKELY, TRIED = 24, 4
#: Most chunks whose ids a worker remembers.
REMEMBERED = 800_000

_SPLIT = re.compile(r"(?<=\S) (?=\S)")

Pattern = tuple[tuple[int, int], ...]


def _byte_letters() -> dict[int, str]:
    """The letters of byte-level BPE: a printable Latin-1 byte is its own, each other one, in order,
    a letter from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    other = (b for b in range(256) if b not in own)
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(other)}


class _Odd(Exception):
    """A chunk that white space stands next to."""


class Encoder:
    """Ids of texts as little-endian 32-bit words, by a tokenizers file.

    A text falls into chunks at single spaces between two characters that are none: byte-level BPE
    always splits before such a space, so a chunk has the same ids alone and in place. Most chunks
    have been seen before and come from a dictionary of bounded size."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added)), re.IGNORECASE) if added else None
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.known = (_Chunks(self, ""), _Chunks(self, " "))
        self.line = self.whole("\n")

    @classmethod
    def of(cls, path: str) -> Encoder:
        """The worker's own encoder, kept between tasks."""
        store = sys.modules.setdefault("_loomlog_encoders", types.ModuleType("_loomlog_encoders"))
        if path not in store.__dict__:
            setattr(store, path, cls(path))
        return getattr(store, path)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def word(self, lead: str, text: str) -> bytes:
        """Ids of letters or of a mark, which the pattern before the merges leaves whole."""
        if text.isascii():
            text = (self.letters[32] if lead else "") + text
        else:
            text = (lead + text).encode().decode("latin-1").translate(self.letters)
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(text)])

    def encode(self, texts: list[str]) -> list[bytes]:
        first, rest = self.known
        if len(first) + len(rest) > REMEMBERED:
            first.clear()
            rest.clear()
        out = []
        for text in texts:
            if self.added and self.added.search(text):  # added tokens stand across chunks
                out.append(self.whole(text))
                continue
            head, *tail = text.split(" ")
            try:
                ids = b"".join([first[head], *[rest[x] for x in tail]]) if text else b""
            except _Odd:
                head, *tail = _SPLIT.split(text)
                ids = b"".join([self.whole(head), *[self.whole(" " + x) for x in tail]])
            out.append(ids)
        return out


class _Chunks(dict):
    """Ids of chunks, without the space before them."""

    def __init__(self, encoder: Encoder, lead: str):
        self.encoder, self.lead = encoder, lead

    def __missing__(self, x: str) -> bytes:
        e = self.encoder
        if x.isalpha():
            self[x] = ids = e.word(self.lead, x)
            return ids
        if not x or x[0].isspace() or x[-1].isspace():
            raise _Odd
        a, line, b = x.partition("\n")
        if x[-1] in ".," and x[:-1].isalpha():
            ids = self[x[:-1]] + e.word("", x[-1])
        elif line and not a[-1].isspace() and not b[0].isspace():
            ids = self[a] + e.line + e.known[0][b]
        else:
            ids = e.whole(self.lead + x)
        self[x] = ids
        return ids


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole, or pieces of capacity after a shorter first."""
    first = n if n <= capacity else n % capacity or capacity
    return [(0, first), *[(at, capacity) for at in range(first, n, capacity)]]


# --------------------------------------------------------------------------- the packing problem


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing over a histogram: (pattern, times) with patterns of (length, copies)."""
    room: dict[int, list[list]] = {}  # space left: [pattern, bins]
    for size in range(capacity, 0, -1):
        n = int(counts[size])
        while n:
            left = min((r for r in room if r >= size and room[r]), default=0)
            pattern, bins = room[left].pop() if left else ((), -(-n // (capacity // size)))
            left = left or capacity
            each = left // size
            full = min(bins, n // each)
            for some, copies in ((full, each), (int(full < bins and n > full * each), n - full * each)):
                if some:
                    room.setdefault(left - copies * size, []).append([(*pattern, (size, copies)), some])
                    n -= some * copies
                    bins -= some
            if bins and pattern:
                room.setdefault(left, []).append([pattern, bins])
    return [(p, m) for groups in room.values() for p, m in groups]


def _reachable(sizes: list[int], counts: list[int], room: int) -> list[int]:
    """For each k, the sums up to room that sizes[k:] can make, as bits of a number; one more, of 0."""
    full, out = (1 << (room + 1)) - 1, [1]
    for s, n in zip(reversed(sizes), reversed(counts)):
        bits, n, step = out[-1], min(n, room // s), 1
        while n > 0:
            take = min(step, n)
            bits |= bits << take * s & full
            n, step = n - take, 2 * step
        out.append(bits)
    return out[::-1]


def _dominated(pattern: Pattern, waste: int, spare: np.ndarray) -> bool:
    """Whether a piece that is left over could take the place of one or two smaller ones, or stand in
    the waste: the filling that has it needs no more bins than this one. spare: how many are left."""
    for s, n in pattern:
        if spare[s + 1 : s + waste + 1].any():
            return True
        for t, _ in pattern:
            if (t < s or t == s and n > 1) and spare[s + t : s + t + waste + 1].any():
                return True
    return bool(spare[1 : waste + 1].any())


def fillings(counts: np.ndarray, room: int, allowed: int, steps: list[int]) -> Iterator[tuple[int, Pattern]]:
    """(waste, pattern) of all undominated fillings of the room that waste no more than allowed, the
    least waste first and longer pieces first, one at a time. steps: how many fillings the search may
    still look at, counted down; nothing more comes at 0."""
    sizes = [int(s) for s in np.flatnonzero(counts[: room + 1])[::-1] if s]
    have = [int(counts[s]) for s in sizes]
    reach = _reachable(sizes, have, room)

    def go(k: int, left: int, own: Pattern) -> Iterator[Pattern]:
        if not left:
            yield own
            return
        while k < len(sizes) and sizes[k] > left:
            k += 1
        if not reach[k] >> left & 1:
            return
        for n in range(min(have[k], left // sizes[k]), -1, -1):
            if reach[k + 1] >> left - n * sizes[k] & 1:
                yield from go(k + 1, left - n * sizes[k], (*own, (sizes[k], n)) if n else own)

    spare = counts[: 2 * room + 2].copy()
    spare[room + 1 :] = 0  # longer ones don't fit
    for waste in range(min(room, allowed) + 1):
        for pattern in go(0, room - waste, ()):
            steps[0] -= 1
            if steps[0] <= 0:
                return
            for s, n in pattern:
                spare[s] -= n
            gone = _dominated(pattern, waste, spare)
            for s, n in pattern:
                spare[s] += n
            if not gone:
                yield waste, pattern


def likely_fillings(counts: np.ndarray, room: int, allowed: int, steps: list[int]) -> Iterator[tuple[int, Pattern]]:
    """The same in another order: first a few fillings with the longest pieces by the least waste and
    the fewest pieces, then all others."""
    sizes = [int(s) for s in np.flatnonzero(counts[: room + 1])[::-1] if s]
    found: set[tuple[int, Pattern]] = set()

    def go(k: int, left: int, own: dict[int, int]) -> None:
        tried = 0
        while k < len(sizes) and tried < TRIED and len(found) < LIKELY:
            s = sizes[k]
            if s <= left and counts[s] > own.get(s, 0):
                go(k, left - s, own | {s: own.get(s, 0) + 1})
                tried += 1
            k += 1
        if not tried and own:
            found.add((left, tuple(own.items())))

    go(0, room, {})
    first = sorted((x for x in found if x[0] <= allowed), key=lambda x: (x[0], sum(n for _, n in x[1])))
    yield from first
    yield from (x for x in fillings(counts, room, allowed, steps) if x not in found)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """The largest over all k of: bins of pieces longer than half the capacity, and of what the pieces
    from k on up to half of it need beyond the room that those leave (Martello and Toth, 1990)."""
    counts = np.asarray(counts, np.int64)
    size = np.arange(len(counts))
    n, total = np.cumsum(counts[::-1])[::-1], np.cumsum((counts * size)[::-1])[::-1]
    n, total = np.append(n, [0, 0]), np.append(total, [0, 0])
    half, best = capacity // 2, 0
    for k in range(1, half + 1):  # pieces over capacity - k stand alone, for those from k on
        big, middle = int(n[capacity - k + 1]), int(n[half + 1] - n[capacity - k + 1])
        room = middle * capacity - int(total[half + 1] - total[capacity - k + 1])
        small = int(total[k] - total[half + 1])
        best = max(best, big + middle + max(0, -(-(small - room) // capacity)))
    return max(best, -(-int((counts * size).sum()) // capacity))


def pack(counts: np.ndarray, capacity: int, nodes: int = NODES) -> tuple[list[tuple[Pattern, int]], int, bool]:
    """Patterns that hold the histogram's pieces (counts[length]), the lower bound of bins, and
    whether no packing needs fewer: the bound is met, or a search has ended. Two searches go through
    the same tree in different orders, the second one from the first one's result."""
    counts = np.asarray(counts, np.int64)
    counts = np.pad(counts, (0, max(0, capacity + 1 - len(counts))))
    bound = lower_bound(counts, capacity)
    best, proven = best_fit(counts, capacity), False
    for order in (likely_fillings, fillings):
        if not proven and sum(m for _, m in best) > bound:
            best, proven = _search(counts, capacity, best, bound, order, nodes)
    return best, bound, proven or sum(m for _, m in best) == bound


def _search(counts: np.ndarray, capacity: int, best: list[tuple[Pattern, int]], bound: int, order: Callable, nodes: int) -> tuple[list[tuple[Pattern, int]], bool]:
    """Branch and bound from an incumbent: the best packing found, and whether the tree has ended."""
    total, bins = int((counts * np.arange(len(counts))).sum()), sum(m for _, m in best)
    chosen: list[tuple[Pattern, int]] = []
    steps = [20 * nodes]

    def options(c: np.ndarray, used: int, waste: int) -> Iterator[tuple[np.ndarray, int, int, Pattern, int]]:
        """What may stand around the largest piece left, and what is left then."""
        size = int(np.flatnonzero(c)[-1])
        c = c.copy()
        c[size] -= 1
        for spare, rest in order(c, capacity - size, (bins - 1) * capacity - total - waste, steps):
            copies = dict(rest)
            copies[size] = copies.get(size, 0) + 1
            times = min(int(c[s] + (s == size)) // k for s, k in copies.items())
            for n in range(times, 0, -1):
                if used + n >= bins or waste + n * spare > (bins - 1) * capacity - total:
                    continue
                new = c.copy()
                new[size] += 1
                for s, k in copies.items():
                    new[s] -= n * k
                yield new, used + n, waste + n * spare, tuple(sorted(copies.items(), reverse=True)), n

    stack = [options(counts, 0, 0)]
    while stack and bins > bound:
        nodes -= 1
        if nodes <= 0 or steps[0] <= 0:
            return best, False
        step = next(stack[-1], None)
        if step is None:
            if steps[0] <= 0:
                return best, False
            stack.pop()
            if chosen:
                chosen.pop()
            continue
        left, used, waste, pattern, times = step
        chosen.append((pattern, times))
        if left.any():
            stack.append(options(left, used, waste))
        else:
            best, bins = list(chosen), used
            chosen.pop()
    return best, True


def places(solution: list[tuple[Pattern, int]]) -> np.ndarray:
    """Rows (length, first rank, copies a bin, first bin, offset in the bin), by length and rank."""
    rank: dict[int, int] = {}
    rows, bin_ = [], 0
    for pattern, times in solution:
        at = 0
        for size, copies in pattern:
            rows.append((size, rank.get(size, 0), copies, bin_, at))
            rank[size] = rank.get(size, 0) + copies * times
            at += size * copies
        bin_ += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


# --------------------------------------------------------------------------- over documents


def tokenised_pieces(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every document's pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder.of(tokenizer), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for lo, hi in blocks_of(texts, 1 << 22):
                rows, row = [], []
                for k, blob in enumerate(encoder.encode(texts[lo:hi]), lo):
                    blob += end
                    for p, (at, n) in enumerate(piece_bounds(len(blob) // 4, capacity)):
                        row.append(k)
                        rows.append((p, at, n, zlib.crc32(blob[4 * at : 4 * (at + n)])))
                cols = [pa.array([r[c] for r in rows], t) for c, t in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(row, pa.int64())), *cols], ["id", "piece", "start", "length", "ids_crc32"])
        tidy()

    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    return rows.mapInArrow(run, f"id {id_type}, piece int, start long, length long, ids_crc32 long")


def pack_documents(
    docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end_id: int = 2, nodes: int = NODES,
) -> DataFrame:
    """One row for each piece: id_col, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is one piece, the end id alone; texts are tokenised whole, however long.
    Repeated rows are documents of their own, and so are rows that share an id. Strings of added
    tokens in a text become those tokens, as the tokenizer does it. An empty table gives no rows;
    other columns are ignored, whatever their names. Sequences are filled from offset 0 without
    gaps. If the search ends before its nodes or at the lower bound, no packing has fewer sequences;
    packing_report() says whether it did."""
    scratch = Scratch(docs.sparkSession, "packing")
    pieces = scratch.write(tokenised_pieces(docs, tokenizer, id_col=id_col, text_col=text_col, capacity=capacity, end_id=end_id), "pieces")
    counts = histogram(pieces, capacity)
    at = places(pack(counts, capacity, nodes)[0])
    key = at[:, 0] << 40 | at[:, 1]  # ranks within a length stay under 2**40
    # as many groups for a length as it has pieces for: capacity + GROUPS in all at most
    groups = np.maximum(1, -(-counts // max(GROUP, -(-int(counts.sum()) // GROUPS))))
    first = np.cumsum(groups) - groups
    many = F.array(*[F.lit(int(g)) for g in groups])
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.element_at(many, F.col("length").cast("int") + 1)).cast("int"))
    shape = np.zeros(int(groups.sum()), np.int64)
    for r in pieces.groupBy("length", "bucket").count().collect():
        shape[first[r["length"]] + r["bucket"]] = r["count"]
    before = np.cumsum(shape) - shape
    before -= np.repeat(before[first], groups)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            size, bucket, rank = (b.column(k).to_numpy() for k in (3, 5, 6))
            rank = rank - 1 + before[first[size] + bucket]
            own = at[np.searchsorted(key, size << 40 | rank, "right") - 1]
            rank = rank - own[:, 1]
            where = [pa.array(own[:, 3] + rank // own[:, 2]), pa.array(own[:, 4] + rank % own[:, 2] * size)]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(5)), *where], ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    rank = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("id", "piece", "start", "ids_crc32")).cast("long")
    id_type = docs.schema[id_col].dataType.simpleString()
    out = pieces.select("id", "piece", "start", "length", "ids_crc32", "bucket", rank.alias("rank")).mapInArrow(
        assign, f"id {id_type}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
    return out.withColumnRenamed("id", id_col)


def histogram(pieces: DataFrame, capacity: int) -> np.ndarray:
    """How many pieces have each length: capacity + 1 counts at most come to the driver."""
    counts = np.zeros(capacity + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():
        counts[r["length"]] = r["count"]
    return counts


def packing_report(pieces: DataFrame, capacity: int = 1024, nodes: int = NODES) -> dict[str, int | bool]:
    """Sequences that best fit and the search need for a table of pieces with their lengths, the lower
    bound, and whether the result is proven to be the least."""
    counts = histogram(pieces, capacity)
    best, bound, proven = pack(counts, capacity, nodes)
    return {"best_fit": sum(m for _, m in best_fit(counts, capacity)), "sequences": sum(m for _, m in best), "bound": bound, "proven": proven}
