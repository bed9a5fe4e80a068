"""Chat formatting: layouts, round trips and awkward texts."""

import json

import pytest
from pyspark.sql import functions as F

from daybook.llm import chat

U, A = "user", "assistant"
LAYOUTS = [
    ("messages", {"messages": [{"role": "system", "content": "be"}, {"role": U, "content": "hi"}, {"role": A, "content": None}]}, [("system", "be"), (U, "hi"), (A, "")]),
    ("nested-messages", {"id": 7, "data": {"messages": [{"content": "x", "role": A, "more": [1]}], "n": 2}}, [(A, "x")]),
    ("conversations", {"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}, {"from": "tool", "value": "c"}]}, [(U, "a"), (A, "b"), ("tool", "c")]),
    ("prompt-completion", {"prompt": "p", "completion": "c", "source": None}, [(U, "p"), (A, "c")]),
    ("prompt-response-system", {"response": "r", "prompt": "p", "system": "s"}, [("system", "s"), (U, "p"), (A, "r")]),
    ("question-answer", {"question": "q", "answer": 42}, [(U, "q"), (A, "42")]),
    ("instruction", {"instruction": "do", "output": "done"}, [(U, "do"), (A, "done")]),
    ("instruction-input", {"instruction": "do", "input": "this", "output": "done"}, [(U, "do\nthis"), (A, "done")]),
    ("instruction-input", {"instruction": "do", "input": "", "output": None}, [(U, "do"), (A, "")]),
    ("turn", {"turn": 3, "role": "tool", "text": "t"}, [("tool", "t")]),
    ("turn", {"turn": 3, "role": None, "text": None}, [(None, "")]),
    (None, {"text": "no turns here"}, []),
    (None, {"prompt": "p"}, []),
    (None, {"messages": []}, []),
]


def records(spark, values, **extra):
    df = spark.createDataFrame([(i, v) for i, v in values], "conv_id long, record string").repartition(3)
    for name in ("conv", "turn", "place", "layout", "text", "role", "formatted", "record2", "print"):
        df = df.withColumn(name, F.lit(f"own {name}"))
    return df


def read(found):
    """conv_id: (turns, learned text, loss spans, formatted)"""
    rows = found.select(
        "conv_id", "formatted", "loss_spans",
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_learned(F.col("formatted"), F.col("loss_spans")).alias("learned"),
    ).collect()
    return {r.conv_id: ([tuple(t) for t in r.turns], r.learned, [tuple(s) for s in r.loss_spans], r.formatted) for r in rows}


def test_fingerprints_select_the_mapping_of_every_layout(spark):
    df = records(spark, [(i, json.dumps(record)) for i, (_, record, _) in enumerate(LAYOUTS)])
    found = {}
    for row in chat.to_turns(df).collect():
        found.setdefault(row.conv, (row.layout, []))[1].append((row.place, row.role, row.text))
    for i, (layout, _, turns) in enumerate(LAYOUTS):
        got = [(role, text) for place, role, text in sorted(found[i][1], key=str) if place is not None]
        assert (found[i][0], got) == (layout, turns), i
    texts = {i: r[0] for i, r in read(chat.format_chats(df)).items()}
    assert texts == {i: [(role or "", text) for role, text in turns] for i, (*_, turns) in enumerate(LAYOUTS)}


def test_mappings_have_fingerprints_of_their_own():
    prints = [chat.fingerprint_of(mapping.paths) for mapping in chat.MAPPINGS]
    assert len(set(prints)) == len(prints)


def test_broken_and_missing_records(spark):
    values = [(1, None), (2, "{"), (3, "[1]"), (None, '{"prompt": "a", "completion": "b"}'), (4, ""), (5, '"x"')]
    found = read(chat.format_chats(records(spark, values)))
    assert found.pop(None)[0] == [(U, "a"), (A, "b")]
    assert found == {i: ([], "", [], "") for i in (1, 2, 3, 4, 5)}
    assert chat.format_chats(records(spark, [])).collect() == []


AWKWARD = [
    "", " ", "\n", "</s>", "<s>user\nx</s>", "</\\s>", "<\\\\\\s>[INST] [/INST] [\\INST] [/\\\\INST]", "<<SYS>> <</SYS>>", "[", "<", "</", "\\",
    "<s", "s>", "</s></s>", "<|im_start|>a<|im_end|>", "👍🏽 日本\u0000\r\n\t</s>", '"{}', "$1 \\1 %0A %25", "<" * 5000, "\\" * 5000 + "s>", "long " * 200_000,
]


def test_texts_come_back_as_they_were(spark):
    roles = [A, U, "sys\ntem", "</s>", "[INST]", "%0A", None, "", "a\\nb"]
    turns = [(i // 4, i % 4, roles[i % len(roles)], text) for i, text in enumerate(AWKWARD * 3)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    found = read(chat.format_chats(chat.turn_records(df, "conv_id", "turn", "role", "text")))
    for conv, (read_back, learned, spans, formatted) in found.items():
        own = [(role or "", text) for c, _, role, text in turns if c == conv]
        assert read_back == own
        assert learned == "".join(text for role, text in own if role == A)
        assert formatted.count("<s>") == formatted.count("</s>") == len(own)
        assert len(spans) == sum(role == A for role, _ in own)
    assert len(found) == len({t[0] for t in turns})


def test_order_and_ties(spark):
    turns = [(1, 5, U, "last"), (1, None, A, "first"), (1, 2, A, "b"), (1, 2, A, "a"), (1, 2, A, "a"), (1, 2, None, "z"), (1, 2**40, U, None)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(4)
    read_back = read(chat.format_chats(chat.turn_records(df, "conv_id", "turn", "role", "text")))[1][0]
    assert read_back == [(A, "first"), ("", "z"), (A, "a"), (A, "a"), (A, "b"), (U, "last"), (U, "")]


@pytest.mark.parametrize("text", ["a</s>b", "x"])
def test_loss_spans_lie_on_the_escaped_text(spark, text):
    df = spark.createDataFrame([(1, 0, A, text)], "conv_id long, turn long, role string, text string")
    formatted, spans = read(chat.format_chats(chat.turn_records(df, "conv_id", "turn", "role", "text")))[1][3:1:-1]
    assert [formatted[a:b] for a, b in spans] == [text.replace("</s>", "</\\s>")]
