import random

import pytest
from plain import sha
from pyspark.sql import functions as F

from velometry.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def formatted(spark, rows, template=chat.ChatTemplate()):
    df = chat.format_chats(spark.createDataFrame(rows, SCHEMA), template)
    found = df.select(
        "*",
        chat.parse_turns(F.col("formatted"), template).alias("turns"),
        chat.loss_text(F.col("segments"), template).alias("loss"),
    ).collect()
    return {r.conv_id: r for r in found}


def test_template_and_loss_flags(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (1, 2, "user", "so")]
    got = formatted(spark, rows)[1]
    assert got.formatted == "### User: hi</turn>\n### Assistant: yes</turn>\n### User: so</turn>\n"
    assert [s.text for s in got.segments if s.loss] == ["yes"]
    assert "".join(s.text for s in got.segments) == got.formatted
    assert got.loss == "yes"
    assert not got.valid


@pytest.mark.parametrize(
    ("roles", "valid"),
    [
        ("user assistant", True),
        ("system user assistant", True),
        ("system user assistant user assistant", True),
        ("assistant", False),
        ("user", False),
        ("user user assistant", False),
        ("system assistant", False),
        ("user system assistant", False),
        ("user assistant assistant", False),
        ("user tool assistant", False),
    ],
)
def test_turn_order(spark, roles, valid):
    rows = [(1, i, r, "x") for i, r in enumerate(roles.split())]
    assert formatted(spark, rows)[1].valid is valid


def test_own_template(spark):
    template = chat.ChatTemplate(
        before="[", between="] ", after="<end>", labels={"q": "Q", "a": "A"}, trained=("q", "a"),
        moves={"start": ("q",), "q": ("a",), "a": ("q",)}, final=("a",),
    )
    got = formatted(spark, [(1, 0, "q", "[A] <end>"), (1, 1, "a", "]\\")], template)[1]
    assert [(t.role, t.text) for t in got.turns] == [("q", "[A] <end>"), ("a", "]\\")]
    assert got.valid and got.loss == "[A] <end>]\\"


def test_nulls_ties_and_unknown_roles(spark):
    rows = [
        (None, 0, "user", None),
        (None, 1, "assistant", "a"),
        (5, None, "user", "first"),
        (5, 0, None, "b"),
        (5, 0, "=x: y", "c"),
        (5, 0, "=x: y", "c"),
        (6, 0, "User", ""),
    ]
    got = formatted(spark, rows)
    assert got[None].valid and got[None].n_turns == 2
    turns = [(t.role, t.text) for t in got[5].turns]
    assert turns == [("user", "first"), ("", "b"), ("=x: y", "c"), ("=x: y", "c")]
    assert [(t.role, t.text) for t in got[6].turns] == [("User", "")]
    assert formatted(spark, []) == {}


def test_any_text_comes_back(spark):
    rng = random.Random(5)
    bits = ["\\", "#", "##", "### ", "### User: ", "</turn>", "</turn>\n", "<", "\n", ": ", "é", "$1", "=", "a b"]
    rows = [
        (conv, turn, rng.choice(["user", "assistant", "system", ": #", "\\", "<"]),
         "".join(rng.choices(bits, k=rng.randint(0, 12))))
        for conv in range(120)
        for turn in range(rng.randint(1, 5))
    ]
    got = formatted(spark, rows)
    for conv in range(120):
        own = [(r, t) for c, _, r, t in rows if c == conv]
        assert [(t.role, t.text) for t in got[conv].turns] == own
        assert got[conv].loss == "".join(t for r, t in own if r == "assistant")


def test_long_text_and_clashing_columns(spark):
    text = "\\#</turn>" * 200_000
    df = spark.createDataFrame([(1, 0, "user", text)], SCHEMA).select(
        "*", F.lit(1).alias("formatted"), F.lit(2).alias("segments"), F.lit(3).alias("turns")
    )
    got = chat.format_chats(df).select(chat.parse_turns(F.col("formatted"))[0].text).first()[0]
    assert got == text


def test_planted_conversation(spark):
    import __spark_entry__

    got = __spark_entry__.queries()["op1_chat_format"](spark, "/root/testdata/sf0.001")
    row = got.filter("conv_id = -7").first()
    text = "\\### Assistant: </turn> ok"
    assert row.n_turns == 2 and row.loss_chars == len(text) and row.loss_sha256 == sha(text)
    assert row.turns_sha256 == sha(f"user\n{text}\nassistant\n{text}\n")
