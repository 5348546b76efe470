import itertools
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomlog.llm import packing

Tokenizer = pytest.importorskip("tokenizers").Tokenizer
P = pytest.importorskip("public_tokenizers")
PATH = P.path("byte_bpe_50k.json")


def bins_needed(sizes, capacity):
    """Fewest bins by trying every assignment."""
    for n in range(-(-sum(sizes) // capacity), len(sizes) + 1):
        def fits(k, room):
            return k == len(sizes) or any(sizes[k] <= r and fits(k + 1, (*room[:i], r - sizes[k], *room[i + 1 :])) for i, r in enumerate(room) if r not in room[:i])

        if fits(0, (capacity,) * n):
            return n
    return 0


def held(solution):
    return {s: sum(dict(p).get(s, 0) * m for p, m in solution) for s in set(itertools.chain(*[[x for x, _ in p] for p, _ in solution]))}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_small_problems_are_solved(sizes):
    counts = np.bincount(sizes, minlength=21) if sizes else np.zeros(21, int)
    solution, bound, proven = packing.pack(counts, 20)
    assert held(solution) == {s: n for s, n in enumerate(counts) if n}
    assert all(sum(s * k for s, k in p) <= 20 for p, _ in solution)
    got, best = sum(m for _, m in solution), bins_needed(sorted(sizes, reverse=True), 20)
    assert proven and bound <= best == got


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(1, 1024), min_size=1, max_size=400))
def test_never_worse_than_best_fit(sizes):
    counts = np.bincount(sizes, minlength=1025)
    solution, bound, proven = packing.pack(counts, 1024, nodes=500)
    assert bound <= sum(m for _, m in solution) and (not proven or sum(m for _, m in packing.pack(counts, 1024)[0]) == sum(m for _, m in solution))
    assert held(solution) == {s: n for s, n in enumerate(counts) if n}
    assert sum(m for _, m in solution) <= sum(m for _, m in packing.best_fit(counts, 1024))


@pytest.mark.parametrize("text", ["", " ", "a  b", " lead", "trail ", "x \n y", "tab\t z", "it's don't", "é ü　x", "a\x1c b \x1c c", "a\xa0 b", "x\ny", "a.\n\nb", "<|endoftext|> ok", "a<|endoftext|>", "x <|endoftext|>y <|endoftext|>", "<|EndOfText|> z", "a <s> b </s> c [UNK] <pad>", "日本 語", "$$$ cat***\nDog!!"])
def test_ids_equal_the_tokenizers(text):
    encoder = packing.Encoder(PATH)
    want = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == want


def test_sequences(documents, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 16)  # several groups for a length
    rows = [(i, "word " * (i * 37 % 900)) for i in range(60)] + [(100, "long text here " * 3000 + "<|endoftext|>" + "é\n" * 60_000), (101, None), (102, ""), (103, "same"), (103, "same"), (None, "x")]
    got = packing.pack_documents(documents(rows), PATH, capacity=256).toPandas()
    plain = Tokenizer.from_file(PATH)
    for seq, g in got.sort_values("offset").groupby("sequence_id"):
        assert g.offset.iloc[0] == 0 and (g.offset.values[1:] == (g.offset + g.length).values[:-1]).all() and g.length.sum() <= 256
    for i, t in rows[:63]:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [2]
        own = got[got.doc_id == i].sort_values("piece")
        assert own.piece.tolist() == list(range(len(own))) and own.length.sum() == len(ids)
        assert len(own) == 1 or (own.length.values[1:] == 256).all()
        for r in own.itertuples():
            assert zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32
    assert len(got[got.doc_id == 103]) == 2 and got.doc_id.isna().sum() == 1
    assert packing.pack_documents(documents(rows).where("false"), PATH).count() == 0


def test_report(documents):
    rows = [(i, "word " * (100 + i * 37 % 155)) for i in range(200)]
    pieces = packing.tokenised_pieces(documents(rows), PATH, capacity=256)
    found = packing.packing_report(pieces, 256)
    assert found["bound"] <= found["sequences"] <= found["best_fit"]
    assert packing.pack_documents(documents(rows), PATH, capacity=256).select("sequence_id").distinct().count() == found["sequences"]
