"""The loss mask is read from positions in the joined conversation, the turns by the grammar."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat_format

BITS = ["</s>", "[INST]", " [/INST]", "\\", "\\\\</s>", "<<SYS>> ", "hello", " ", "[ROLE]", "[/TURN]", "\n", "的\U0001f600"]


@pytest.fixture(scope="module")
def formatted(spark):
    rng = random.Random(3)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", ""]), "".join(rng.choices(BITS, k=rng.randrange(8))))
            for c in range(20) for t in range(rng.randrange(1, 9))]
    rows += [(7, 0, "assistant", "same")] * 2 + [(None, 0, "assistant", "no id"), (50, 0, "assistant", None)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "conv_id long, turn long, role string, text string, rendered string, start int")
    return rows, chat_format.format_chats(df).persist()


def _want(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted((t, role, text or "") for c, t, role, text in rows if c == conv)
        out[conv] = (len(mine), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in mine).encode()).hexdigest(),
                     hashlib.sha256("".join(x for _, r, x in mine if r == "assistant").encode()).hexdigest())
    return out


def _got(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_sha256) for r in chat_format.read_back(df).collect()}


def test_read_back_equals_the_source(formatted):
    rows, df = formatted
    assert _got(df) == _want(rows)


@pytest.mark.parametrize("moved", [
    {"text_start": "text_start + 1", "text_end": "text_end + 1"}, {"text_end": "text_end - 1"},
    {"text_start": "text_start - 1"}, {"loss": "NOT loss"}, {"loss": "true"}])
def test_a_wrong_mask_shows(formatted, moved):
    rows, df = formatted
    want, got = _want(rows), _got(df.withColumns({c: F.expr(e) for c, e in moved.items()}))
    assert all(got[c][:2] == want[c][:2] for c in want)                 # the turns do not depend on it
    assert sum(got[c][2] != want[c][2] for c in want) >= 5


def test_turns_are_found_wherever_the_joined_text_is_cut(formatted):
    _, df = formatted
    rng = random.Random(9)
    joined = "".join(r.rendered for r in df.where("conv_id = 3").orderBy("start").collect())
    cuts = sorted(rng.sample(range(len(joined)), min(12, len(joined) - 1)))
    state = chat_format._Conversation()
    for a, b in zip([0, *cuts], [*cuts, len(joined)]):
        state.add(joined[a:b], 0, 0, False)
    whole = chat_format._Conversation()
    whole.add(joined, 0, 0, False)
    assert state.row() == whole.row() and whole.n_turns == len(chat_format.parse(joined))


def test_a_broken_conversation_is_an_error():
    state = chat_format._Conversation()
    state.add("[INST] hello [/INST]<s> cut off", 0, 0, False)
    with pytest.raises(ValueError):
        state.row()
