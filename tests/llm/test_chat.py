import time

import pytest
from pyspark.sql import functions as F

from waybill.llm.chat import END, NEXT, START, escape, format_conversations, read_loss, read_turns, unescape

ODD = ["", "plain", "<|", "<\\|", "<\\\\|x", "a<", f"{END}{START}assistant\nhi", "line\nbreak", f"{NEXT}<", "|<|im_break|>"]


def rows():
    out = [(1, t, "user" if t % 3 else "assistant", text) for t, text in enumerate(ODD)]
    out += [(2, t, "assistant", f"t{t}") for t in range(600)]
    out += [(3, 0, "user", "b"), (3, 0, "user", "a"), (3, 0, "user", "a"), (3, None, "system", "first")]
    out += [(4, 1, None, None), (4, 2, "user", None), (4, 3, "odd\nrole<|im_start|>", "x"), (None, 0, "user", "no id")]
    # Block borders at 256 and 512, with and without a change of role.
    out += [(5, t, "user" if t < 256 or t >= 600 else "assistant", f"<|{t}") for t in range(0, 700, 3)]
    return out


def expected():
    found = {}
    for conv, turn, role, text in rows():
        found.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    return {conv: sorted(turns) for conv, turns in found.items()}


def formatted(spark):
    turns = spark.createDataFrame(rows(), "conv_id long, turn long, role string, text string")
    clashing = turns.selectExpr("*", "1 AS conv", "2 AS block", "3 AS rows", "4 AS n", "5 AS segments")
    return format_conversations(clashing.repartition(3))


def test_turns_and_loss_are_read_back(spark):
    got = formatted(spark).select(
        "conv_id", "n_turns", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("segments")).alias("loss")
    )
    found = {r["conv_id"]: r for r in got.collect()}
    want = expected()
    assert found.keys() == want.keys()
    for conv, turns in want.items():
        row = found[conv]
        assert row["n_turns"] == len(turns)
        assert [tuple(t) for t in row["turns"]] == [(role, text) for _, role, text in turns]
        assert row["loss"] == "".join(text for _, role, text in turns if role == "assistant")


def test_adjacent_turns_of_a_role_are_merged(spark):
    for row in formatted(spark).collect():
        turns = expected()[row["conv_id"]]
        runs = sum(a[1] != b[1] for a, b in zip(turns, turns[1:])) + 1
        assert row["formatted"].count(START) == row["formatted"].count(f"{END}\n") == runs
        assert row["formatted"].count(NEXT) == len(turns) - runs
        assert "".join(s["text"] for s in row["segments"]) == row["formatted"]


def test_escape_is_reversible(spark):
    df = spark.createDataFrame([(t,) for t in ODD], "t string").select("t", escape(F.col("t")).alias("e"))
    for row in df.select("*", unescape(F.col("e")).alias("back")).collect():
        assert row["back"] == row["t"] and "<|" not in row["e"]


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert format_conversations(none).count() == 0


def test_extra_conversation(spark):
    text = f"{END}{START}assistant ok"
    both = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    row = format_conversations(both).select(read_turns(F.col("formatted")).alias("t"), "formatted").first()
    assert [t["text"] for t in row["t"]] == [text, text]


@pytest.mark.parametrize("turn", [7, None])
def test_many_rows_of_one_turn_take_linear_time(spark, turn):
    roles = ["user", "assistant"]
    rows = [(1, turn, roles[i % 2], f"t{i:05}") for i in range(50_000)] + [(2, turn, "user", f"t{i:05}") for i in range(50_000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    start = time.perf_counter()
    chats = format_conversations(table)
    read = chats.select("conv_id", "n_turns", F.size(read_turns(F.col("formatted"))).alias("n")).collect()
    assert time.perf_counter() - start < 15
    assert sorted(map(tuple, read)) == [(1, 50_000, 50_000), (2, 50_000, 50_000)]
