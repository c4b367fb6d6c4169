from pyspark.sql import functions as F

from tidemark.llm.chat_format import format_conversations, read_loss, read_turns

SCHEMA = "conv_id long, turn long, role string, text string, said string, formatted string"
ROWS = [
    (1, 1, "assistant", "b <|im_end|>\\<|", "x", "y"),
    (1, 0, "user", "a\n<\\|", "x", "y"),
    (2, 0, "user", None, "x", "y"),
    (2, 1, "user", "again <|im_next|>", "x", "y"),
    (2, 2, "assistant", "", "x", "y"),
    (2, 3, "assistant", "😀 two<", "x", "y"),
    (2, 3, "assistant", "😀 two<", "x", "y"),
    (3, None, "odd\nrole<|", "|z", "x", "y"),
    (3, 5, None, "no role", "x", "y"),
    (None, 0, "user", "no conversation", "x", "y"),
    (4, 0, "assistant", "<\\" * 5 + "|" + "<|" * 3, "x", "y"),
]


def test_reads_back(spark):
    made = format_conversations(spark.createDataFrame(ROWS, SCHEMA))
    rows = made.select(
        "*", read_turns(F.col("formatted")).alias("turns"), read_loss(F.col("formatted"), F.col("loss")).alias("trained")
    ).collect()
    assert len(rows) == 5
    for row in rows:
        said = sorted(
            ((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in ROWS if r[0] == row["conv_id"])
        )
        assert [(t["role"], t["text"]) for t in row["turns"]] == [s[2:] for s in said]
        assert row["trained"] == [s[3] for s in said if s[2] == "assistant"]


def test_adjacent_turns_of_a_role_are_one_block(spark):
    row = format_conversations(spark.createDataFrame([r for r in ROWS if r[0] == 2], SCHEMA)).first()
    assert row["n_blocks"] == 2
    assert row["formatted"].count("<|im_start|>") == 2 and row["formatted"].count("<|im_next|>") == 3


def test_empty_table(spark):
    assert format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0
