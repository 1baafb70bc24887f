"""Every declared layout, undeclared and unreadable records, and the way back from the text."""

import json

from barloom.llm.chat import LAYOUTS, fingerprint, format_chat, read_back

A, B = "ask ### <x> </turn>\n", "tell \\1 \\ ok"
PAIR = [("user", A), ("assistant", B)]
RECORDS = {
    "prompt": ({"prompt": A, "completion": B}, PAIR),
    "response": ({"response": B, "prompt": A}, PAIR),
    "question": ({"question": A, "answer": B}, PAIR),
    "input": ({"instruction": "be", "input": A, "output": B}, [("system", "be"), *PAIR]),
    "instruction": ({"instruction": A, "output": B}, PAIR),
    "messages": (
        {"messages": [{"role": "a\nb", "content": A}, {"content": B, "role": "assistant"}]},
        [("a\nb", A), ("assistant", B)],
    ),
    "turns": ({"turns": [{"role": r, "text": t} for r, t in PAIR]}, PAIR),
    "conversations": (
        {"conversations": [{"from": "human", "value": A}, {"from": "gpt", "value": B},
                           {"from": "tool", "value": ""}]},
        [*PAIR, ("tool", "")],
    ),
    "numbers": ({"prompt": 3, "completion": True}, [("user", "3"), ("assistant", "true")]),
    "nulls": ({"prompt": None, "completion": B}, [("user", ""), ("assistant", B)]),
    "nested": ({"prompt": {"text": A}, "completion": B}, None),
    "other": ({"prompt": A}, None),
    "list": ([1, 2], None),
    "more": ({"prompt": A, "completion": B, "id": 1}, None),
}


def test_layouts(spark):
    rows = [(k, json.dumps(v)) for k, (v, _) in RECORDS.items()]
    rows += [("broken", '{"prompt": "x", "compl'), ("empty", ""), ("null", None)]
    want = {k: turns for k, (_, turns) in RECORDS.items()} | dict.fromkeys(["broken", "empty", "null"])
    docs = spark.createDataFrame([(k, r, "clash", 7) for k, r in rows], "k string, record string, turns string, formatted int")
    back = {r.k: r for r in read_back(format_chat(docs)).collect()}
    assert back.keys() == want.keys()
    for key, turns in want.items():
        row = back[key]
        if turns is None:
            assert row.turns is None and row.formatted is None, key
            continue
        assert [tuple(t) for t in row.turns] == turns, key
        assert [tuple(t) for t in row.read_turns] == turns, key
        assert row.read_loss == "".join(t for r, t in turns if r == "assistant"), key


def test_fingerprints_tell_layouts_apart_and_ignore_types(spark):
    shown = ["prompt", "response", "question", "input", "instruction", "messages", "turns", "conversations"]
    rows = [(k, json.dumps(v)) for k, (v, _) in RECORDS.items()]
    df = spark.createDataFrame(rows, "k string, record string").selectExpr("k", "parse_json(record) r")
    found = {r.k: r.f for r in df.select("k", fingerprint(df.r).alias("f")).collect()}
    assert len({found[k] for k in shown}) == len(LAYOUTS) == len(shown)
    assert found["numbers"] == found["prompt"] == found["nulls"]
    assert found["other"] not in {found[k] for k in shown}
