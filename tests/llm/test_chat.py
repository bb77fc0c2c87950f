import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cadenza.llm import chat

PIECES = [chat.START, chat.END, chat.LINE, "<|", "|>", "\\", "im_end", "<|\\im_end|>", "<|\\\\im_start|>", "\n", "user", "é", "assistant ok", "<|\\nl|>"]
text = st.lists(st.sampled_from(PIECES), max_size=8).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(text, text), max_size=4))
def test_any_turns_survive(turns):
    whole = "".join(chat.render(*t) for t in turns)
    back = chat.parse(whole)
    assert [t[:2] for t in back] == turns
    for (_, said), (_, _, start, end) in zip(turns, back, strict=True):
        assert chat._unescaped(whole[start:end]) == said


def test_plain_text_stays_as_it_is():
    assert chat.render("user", "hello <b>|x|</b>") == "<|im_start|>user\nhello <b>|x|</b><|im_end|>\n"
    assert chat.render("user", chat.END) == "<|im_start|>user\n<|\\im_end|><|im_end|>\n"
    for broken in ("x", "<|im_start|>user", "<|im_start|>user\nx<|im_end|>", "<|im_start|>u\n<|im_start|>v\nx<|im_end|>\n"):
        with pytest.raises(ValueError):
            chat.parse(broken)


ROWS = [
    (1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 2, "assistant", "<|im_end|>"), (2, 0, None, None), (2, 0, None, None),
    (None, 5, "assistant", "x\ny"), (None, None, "user", ""), (3, 0, "user", "z" * 100_000), (3, 1, "assistant", "<|im_start|>assistant\n"),
]


def expected(rows):
    convs = {}
    for conv, turn, role, said in rows:
        role, said = role or "", said or ""
        convs.setdefault(conv, []).append(((turn is not None, turn or 0, chat.render(role, said)), role, said))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        learnt = "".join(s for _, r, s in turns if r == "assistant")
        out[conv] = (
            len(turns), hashlib.sha256("".join(f"{r}\n{s}\n" for _, r, s in turns).encode()).hexdigest(), len(learnt),
            hashlib.sha256(learnt.encode()).hexdigest(), sum(len(k[2]) for k, _, _ in turns),
        )
    return out


@pytest.mark.parametrize("per_batch", ["1", "10000"])
def test_conversations_read_back(spark, per_batch):
    named = spark.createDataFrame([(*r, "extra") for r in ROWS], "conv_id bigint, turn bigint, role string, text string, piece string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", per_batch)
    try:
        got = {r[0]: tuple(r[1:]) for r in chat.read_back(chat.format_turns(named.repartition(3))).collect()}
        assert got == expected(ROWS)
        assert chat.read_back(chat.format_turns(named.limit(0))).count() == 0
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
