import random

import pytest
from compare import both, connect
from pyspark.sql import functions as F

from opinara.llm.chat import Template, digests, format_chats
from opinara.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_equals_sql(spark):
    ours, theirs = both(spark, connect(FOLDER), QUERIES["op7_chat_formatting"], ORACLES["op7_chat_formatting"], FOLDER)
    assert ours == theirs


def chats(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, k string, turns string, formatted int")


def row(conv, turn, role, text):
    return (conv, turn, role, text, "x", "y", 1)


@pytest.mark.parametrize("seed", range(3))
def test_reads_back_what_was_written(spark, seed):
    rng = random.Random(seed)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "[OUT]", "[TURN]", "[TEXT] ", "[/TURN]", "\\", "<", "[", "]", ">", "/", "s", "\n", " ", "é", "INST"]
    text = lambda: "".join(rng.choice(bits) for _ in range(rng.randrange(0, 12)))
    wanted, rows = {}, []
    for conv in range(40):
        wanted[conv] = [(rng.choice(["system", "user", "assistant", "tool", text()]), text()) for _ in range(rng.randrange(1, 7))]
        rows += [row(conv, turn, role, said) for turn, (role, said) in enumerate(wanted[conv])]
    rng.shuffle(rows)
    made = format_chats(chats(spark, rows))
    for one in made.select("conv_id", Template().read(F.col("formatted")).alias("turns"), "segments", "formatted").collect():
        assert [tuple(turn) for turn in one.turns] == wanted[one.conv_id]
        assert "".join(part.text for part in one.segments) == one.formatted
        assert sum(part.loss for part in one.segments) == sum(role == "assistant" for role, _ in wanted[one.conv_id])


def test_role_machine(spark):
    orders = {1: ["user", "assistant"], 2: ["system", "user"], 3: ["assistant"], 4: ["user", "user"], 5: ["system"], 6: ["user", "system"]}
    rows = [row(conv, turn, role, "t") for conv, roles in orders.items() for turn, role in enumerate(roles)]
    found = {r.conv_id: (r.state, r.valid) for r in format_chats(chats(spark, rows)).collect()}
    assert found == {1: ("answered", True), 2: ("asked", True), 3: ("error", False), 4: ("error", False), 5: ("ready", True), 6: ("error", False)}


def test_nulls_ties_and_empty_table(spark):
    rows = [row(None, 1, "user", "b"), row(None, 1, "user", "a"), row(None, None, None, None), row(2, 0, "assistant", None), row(2, 0, "assistant", None)]
    found = {r.conv_id: r for r in digests(format_chats(chats(spark, rows))).collect()}
    assert found[None].n_turns == 3 and found[2].n_turns == 2 and found[2].loss_chars == 0
    made = {r.conv_id: r.formatted for r in format_chats(chats(spark, rows)).collect()}
    assert made[None] == "<s>[TURN]  [TEXT]  [/TURN][INST] a [/INST][INST] b [/INST]"
    assert digests(format_chats(chats(spark, []))).count() == 0
