import hashlib

import pytest
from pyspark.sql import functions as F

from tallyshelf.llm import chat
from tests.llm.samples import CLASHES, prose

TURN = "conv_id long, turn long, role string, text string"
EVENT = "conv_id long, message long, position long, seq long, kind string, role string, text string"
ODD = ["", "\\", "\\\\", "<|", "<\\|", "<\\\\|", "<|im_end|>\n<|im_start|>user\n", "\\<|im_end|>", "<\\/", "a\nb\n", "<<||", "漢😀" * 3, "<|im_end|>"]


def read_back(df):
    rows = df.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss"))
    return {r.conv_id: ([(t.role, t.text) for t in r.turns], r.loss, r.formatted) for r in rows.collect()}


def test_odd_texts_and_roles_come_back(spark):
    rows = [(i, t, role, text) for i, role in enumerate(["user", "assistant", "system", "<|im_end|>\n", "a\nb", "<\\/"]) for t, text in enumerate(ODD)]
    got = read_back(chat.format_chats(chat.log_of(spark.createDataFrame(rows, TURN))))
    for i in range(6):
        want = [(role, text) for c, _, role, text in rows if c == i]
        assert got[i][0] == want
        assert got[i][1] == "".join(text for role, text in want if role == "assistant")


def test_events_fold(spark):
    events = [
        (1, 10, 0, 0, "open", "user", "He"), (1, 10, 0, 1, "delta", None, "llo"), (1, 11, 1, 0, "open", "assistant", None), (1, 11, 1, 1, "delta", None, "wrong"),
        (1, 11, 1, 2, "regenerate", None, None), (1, 11, 1, 4, "delta", None, "t"), (1, 11, 1, 3, "delta", None, "righ"), (1, 12, 2, 0, "open", "user", None),
        (1, 12, 2, 1, "delta", None, "draft"), (1, 12, 2, 2, "edit", None, "final"), (1, 12, 2, 3, "delta", None, "!"), (1, 13, 3, 0, "open", "assistant", None),
        (2, 14, None, 5, "delta", None, "no open"), (None, 15, 0, 0, "open", "user", None),
    ]
    got = read_back(chat.format_chats(spark.createDataFrame(events, EVENT)))
    assert got[1][:2] == ([("user", "Hello"), ("assistant", "right"), ("user", "final!"), ("assistant", "")], "right")
    assert got[1][2].startswith("<|im_start|>user\nHello<|im_end|>\n<|im_start|>assistant\nright<|im_end|>\n")
    assert got[2][0] == [("", "no open")] and got[None][0] == [("user", "")]


def test_unknown_events_are_errors(spark):
    events = spark.createDataFrame([(1, 1, 0, 0, "open", "user", "x"), (1, 1, 0, 1, "undo", None, None)], EVENT)
    with pytest.raises(Exception, match="unknown kind of event"):
        chat.format_chats(events).collect()


def test_odd_rows(spark):
    long = prose(50_000, 1)
    rows = [(1, 0, "user", long), (1, None, "user", "first"), (1, 2, "assistant", None), (1, 2, "assistant", None), (1, 2, None, "b"), (None, 0, "assistant", "n"), (2, 0, None, None)]
    df = spark.createDataFrame(rows, TURN).selectExpr("*", *[f"'x' AS `{c}`" for c in CLASHES + ("seq", "kind", "position", "message")])
    got = read_back(chat.format_chats(chat.log_of(df)))
    assert got[1][0] == [("user", "first"), ("user", long), ("", "b"), ("assistant", ""), ("assistant", "")]
    assert got[None][:2] == ([("assistant", "n")], "n") and got[2][0] == [("", "")]


def test_order_and_hot_conversation(spark, many_blocks):
    rows = [(1, i, ("user", "assistant")[i % 2], f"text {i} " * 9) for i in range(2000)] + [(i, 0, "user", "x") for i in range(2, 50)]
    got = read_back(chat.format_chats(chat.log_of(spark.createDataFrame(rows, TURN).repartition(7), delta=10)))
    whole = "".join(f"{r}\n{t}\n" for c, _, r, t in rows if c == 1)
    assert hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in got[1][0]).encode()).digest() == hashlib.sha256(whole.encode()).digest()


def test_empty(spark):
    assert chat.format_chats(chat.log_of(spark.createDataFrame([], TURN))).count() == 0
