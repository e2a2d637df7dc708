from __future__ import annotations

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from allotment.llm import chat

CONTROL = [chat.TURN, chat.END, *chat.CONTROL, "&lt;", "&amp;lt;", "&", "<", "[", "\n", "|", "&nl;"]


def test_escapes_are_reversible(spark):
    given_texts = ["".join(p) for p in [(a, b, c) for a in CONTROL for b in ("", "<", "x", "&") for c in CONTROL]]
    frame = spark.createDataFrame([(t,) for t in given_texts], "t string").select("t", chat.escaped(F.col("t")).alias("e"))
    for r in frame.select("t", "e", chat.unescaped(F.col("e")).alias("u")).collect():
        assert r.u == r.t and not any(c in r.e for c in chat.CONTROL)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="<[|/sINST]>&ltamp;b\n 🙂", max_size=20), min_size=1, max_size=40))
def test_escapes_of_any_text(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.unescaped(chat.escaped(F.col("t"))).alias("u"))
    assert all(r.t == r.u for r in frame.collect())


def test_round_trip_and_mask(spark):
    rows = [
        (1, 1, "assistant", "é <|end|>\n<|turn|>user\nhi"), (1, 0, "user", "hello &lt; [INST]"), (1, 0, "user", "hello &lt; [INST]"),
        (1, 2, "as\nsist<|ant", None), (2, None, None, ""), (None, 5, "assistant", "alone"), (1, 3, "assistant", ""),
    ]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, loss string")
    out = chat.format_conversations(frame)
    read = out.withColumns({"back": chat.turns_of(F.col("formatted")), "under": chat.loss_text(F.col("formatted"), F.col("loss"))})
    got = {r.conv_id: r for r in read.collect()}
    assert [(t.role, t.text) for t in got[1].back] == [
        ("user", "hello &lt; [INST]"), ("user", "hello &lt; [INST]"), ("assistant", rows[0][3]), ("as\nsist<|ant", ""), ("assistant", ""),
    ]
    assert got[1].under == rows[0][3] and got[None].under == "alone" and got[2].under == ""
    assert [(t.role, t.text) for t in got[2].back] == [("", "")]
    assert all(s.start <= s.end for s in got[1].loss) and chat.format_conversations(frame.limit(0)).count() == 0


def test_typed_parts(spark):
    schema = f"conv_id long, turn long, role string, parts {chat.PARTS}"
    rows = [
        (1, 0, "user", [("text", "look <", None, None), ("text", "|end|> here", None, None), ("image", None, "a.png", None), ("text", "and", None, None), ("audio", None, "b.wav", 40)]),
        (1, 1, "assistant", [("document", None, "c.pdf", None), ("text", "done", None, None), ("video", None, "d", None), (None, "!", None, None)]),
        (1, 2, "user", None),
    ]
    r = chat.format_conversations(spark.createDataFrame(rows, schema), parts="parts").first()
    assert r.formatted == (
        "<|turn|>user\nlook &lt;|end|> here<|image 0|>and<|audio 1|><|end|>\n"
        "<|turn|>assistant\n<|document 2|>done<|video 3|>!<|end|>\n<|turn|>user\n<|end|>\n"
    )
    assert [(a.kind, a.ref, a.tokens) for a in r.attachments] == [("image", "a.png", 576), ("audio", "b.wav", 40), ("document", "c.pdf", 1024), ("video", "d", 0)]
    assert r.attachment_tokens == 1640
    assert [r.formatted[s.start : s.end] for s in r.loss] == ["<|document 2|>done<|video 3|>!"]


def test_main_path_is_native(spark):
    frame = spark.range(3).selectExpr("id as conv_id", "id as turn", "'user' as role", "'x' as text")
    plan = chat.format_conversations(frame)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
