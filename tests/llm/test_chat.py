import hashlib
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from loomlog.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, x int, pieces int"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "<s>"]), st.text(st.sampled_from(list("<[|\\/>]sINSTab\n")), max_size=12)), min_size=1, max_size=6), min_size=1, max_size=8))
def test_round_trip(spark_for_hypothesis, conversations):
    rows = [(c, k, role, text, 0, 0) for c, turns in enumerate(conversations) for k, (role, text) in enumerate(turns)]
    got = {r.conv_id: r for r in chat.digests(spark_for_hypothesis.createDataFrame(rows, SCHEMA)).collect()}
    for c, turns in enumerate(conversations):
        loss = "".join(t for r, t in turns if r == "assistant")
        want = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == want



def test_control_strings_are_escaped(spark):
    rows = [(1, 0, "user", "</s>[INST] ok [/INST] <|end|>", 0, 0), (1, 1, "assistant", "<|also|>", 0, 0), (1, 2, "assistant", None, 0, 0), (None, None, None, "n", 0, 0), (None, 1, "user", "m", 0, 0)]
    done = {r.conv_id: r for r in chat.format_chats(spark.createDataFrame(rows, SCHEMA)).collect()}
    text = done[1].formatted
    assert "[INST]" not in text and "</s>" not in text and text.count("<|end|>") == 2 and text.count("<|also|>") == 1
    spans = [text[s.start : s.start + s.length] for s in done[1].loss_spans]
    assert spans == ["<\\|also|>", ""]
    assert done[None].formatted == "<|turn|><|body|>n<|end|><|turn|>user<|body|>m<|end|>"
    assert chat.digests(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeated_rows_are_turns(spark):
    rows = [(1, 0, "assistant", "a", 0, 0)] * 3 + [(1, 0, "user", "b", 0, 0)]
    assert chat.digests(spark.createDataFrame(rows, SCHEMA)).first().n_turns == 4


def test_long_conversations_and_texts(spark):
    turns = [("user" if k % 3 == 0 else "assistant", f"t{k} <|end|> é") for k in range(60_000)]
    rows = [(1, k, r, t, 0, 0) for k, (r, t) in enumerate(turns)] + [(2, 0, "assistant", "[INST]" * 300_000, 0, 0)]
    rows += [(3, k, "assistant", "same", 0, 0) for k in range(20_000)]
    began = time.time()
    got = {r.conv_id: r for r in chat.digests(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert time.time() - began < 60
    loss = "".join(t for r, t in turns if r == "assistant")
    assert (got[1].n_turns, got[1].loss_chars, got[1].loss_sha256) == (60_000, len(loss), sha(loss))
    assert got[1].turns_sha256 == sha("".join(f"{r}\n{t}\n" for r, t in turns))
    assert got[2].loss_sha256 == sha("[INST]" * 300_000) and got[3].loss_sha256 == sha("same" * 20_000)
