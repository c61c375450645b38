import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from skybasin.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, turns string, parts int, formatted string"


def _formatted(spark, rows):
    return chat.format_conversations(spark.createDataFrame([(*r, "a", 1, "b") for r in rows], SCHEMA))


def _read(spark, rows):
    read = _formatted(spark, rows).select(
        "conv_id", "formatted", chat.read_turns("formatted").alias("turns"), chat.read_learnt("formatted", "loss_spans").alias("learnt")
    )
    return {r.conv_id: (r.formatted, [tuple(t) for t in r.turns], r.learnt) for r in read.collect()}


def test_adjacent_turns_of_a_role_share_a_header(spark):
    rows = [(1, 2, "assistant", "c"), (1, 0, "user", "a"), (1, 1, "user", "b"), (1, 3, "assistant", "d")]
    text, turns, learnt = _read(spark, rows)[1]
    assert text == "[INST]user[/INST]a</s>b</s>[INST]assistant[/INST]c</s>d</s>"
    assert turns == [("user", "a"), ("user", "b"), ("assistant", "c"), ("assistant", "d")]
    assert learnt == "cd"


def test_nulls_ties_repeats_and_empty_texts(spark):
    rows = [
        (None, 0, "user", "x"),
        (2, None, "user", None),
        (2, 0, None, "t"),
        (2, 0, "assistant", ""),
        (2, 0, "assistant", ""),
    ]
    found = _read(spark, rows)
    assert found[None][1] == [("user", "x")]
    assert found[2][1] == [("user", ""), ("", "t"), ("assistant", ""), ("assistant", "")]
    assert found[2][2] == ""


def test_empty_table(spark):
    assert _formatted(spark, []).count() == 0


def test_loss_spans_are_bytes_of_the_formatted_text(spark):
    row = _formatted(spark, [(1, 0, "user", "é"), (1, 1, "assistant", "ü</s>"), (1, 2, "assistant", "日")]).head()
    raw = row.formatted.encode()
    assert [raw[s.start : s.start + s.length].decode() for s in row.loss_spans] == ["ü<\\/s>", "日"]


CONTROL = st.lists(
    st.sampled_from(["<", "[", "\\", "/", "s>", "INST]", "</s>", "[INST]", "[/INST]", "<\\/s>", "a", "\n", "é", "$1"]),
    max_size=8,
).map("".join)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "</s>"]), CONTROL), min_size=1, max_size=6))
def test_what_is_written_is_read_back(spark, turns):
    rows = [(5, i, role, text) for i, (role, text) in enumerate(turns)]
    _, read, learnt = _read(spark, rows)[5]
    assert read == turns
    assert learnt == "".join(t for r, t in turns if r == "assistant")


def test_long_conversation_and_text(spark):
    rows = [(1, i, "user" if i % 3 else "assistant", f"t{i}" + "x" * (200_000 if i == 7 else 0)) for i in range(1200)]
    digest = chat.chat_digest(_formatted(spark, rows)).head()
    lines = "".join(f"{r}\n{t}\n" for _, _, r, t in rows)
    assert digest.n_turns == 1200
    assert digest.turns_sha256 == hashlib.sha256(lines.encode()).hexdigest()


def test_only_native_expressions(spark):
    plan = _formatted(spark, [(1, 0, "user", "a")])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_very_long_conversation(spark):
    """Its spans lie in many chunks, and its time grows with its turns."""
    count = 40_000
    turns = spark.range(count).select(
        F.lit(None).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("é</s>"), F.col("id").cast("string")).alias("text"),
    )
    formatted = chat.format_conversations(turns)
    row = formatted.select("formatted", "loss_spans", chat.read_learnt("formatted", "loss_spans").alias("learnt")).head()
    raw = row.formatted.encode()
    wanted = [f"é<\\/s>{i}" for i in range(count) if i % 3]
    assert [raw[s.start : s.start + s.length].decode() for s in row.loss_spans] == wanted
    assert row.learnt == "".join(x.replace("<\\/", "</") for x in wanted)
    assert chat.chat_digest(formatted).head().n_turns == count


def test_spans_at_the_edges_of_chunks(spark, monkeypatch):
    monkeypatch.setattr(chat, "CHUNK", 3)
    rows = [(c, i, "assistant" if i % 2 else "user", "x" * i) for c in range(8) for i in range(c + 1)]
    for row in _formatted(spark, rows).collect():
        raw = row.formatted.encode()
        assert [raw[s.start : s.start + s.length].decode() for s in row.loss_spans] == ["x" * i for i in range(row.conv_id + 1) if i % 2]
