import json

from promolens.llm.tool_chat import Tool, events_of, format_tool_chat

DDL = "conv_id long, turn long, kind string, role string, content string, call_id string, tool string, arguments string, json string"
TOOLS = {"add": Tool({"a": "number", "b": "number"}, {"note": "string"}), "run": Tool({}, {"opts": "object", "list": "array", "on": "boolean"}, extra=True)}


def call(conv, turn, call_id, tool, arguments):
    return (conv, turn, "call", "assistant", None, call_id, tool, arguments, "clash")


def result(conv, turn, call_id, content):
    return (conv, turn, "result", "tool", content, call_id, None, None, "clash")


def chat(spark, rows):
    return format_tool_chat(spark.createDataFrame(rows, DDL).repartition(4), TOOLS).collect()


def test_statuses(spark):
    cases = {
        '{"b": 2, "a": 1.5}': "valid",
        '{"a":1,"b":2,"note":"x"}': "valid",
        '{"a":1}': "missing:b",
        '{"a":1,"b":"2"}': "wrong_type:b",
        '{"a":null,"b":2}': "wrong_type:a",
        '{"a":1,"b":2,"c":3}': "unexpected",
        "{": "invalid_json",
        "[1]": "invalid_json",
        "": "invalid_json",
    }
    rows = [call(1, i, f"x{i}", "add", a) for i, a in enumerate(cases)]
    rows += [call(1, 50, "n", "add", None), call(1, 51, "o", "nope", "{}"), call(1, 52, "p", None, "{}")]
    rows += [call(1, 53, "q", "run", '{"opts":{},"list":[1],"on":true,"z":0}'), call(1, 54, "r", "run", '{"on":1}')]
    got = {r.turn: r.status for r in chat(spark, rows)}
    assert [got[i] for i in range(len(cases))] == list(cases.values())
    assert [got[i] for i in range(50, 55)] == ["invalid_json", "unknown_tool", "unknown_tool", "valid", "wrong_type:on"]


def test_links_order_and_canonical_json(spark):
    odd = 'é漢😀 "q" \\ \n\t\x01 </x>'
    rows = [
        (1, 0, "message", "user", odd, None, None, None, ""),
        result(1, 1, "late", "before its call"),
        call(1, 2, "late", "add", '{"b": [{"y":1,"x":"' + "z" * 3 + '"}], "a": 1}'),
        call(1, 3, "late", "add", '{"a":1,"b":1}'),
        result(1, 4, "late", odd),
        result(1, 4, "late", odd),
        result(1, 5, "none", None),
        result(2, 5, "late", "other conversation"),
        result(None, 5, None, "x"),
        call(None, 4, None, "add", "not json"),
    ]
    got = chat(spark, rows)
    assert len(got) == len(rows)
    one = [(r.turn, r.kind, r.status) for r in got if r.conv_id == 1]
    assert one == [
        (0, "message", None), (2, "call", "wrong_type:b"), (1, "result", "linked"), (3, "call", "valid"),
        (4, "result", "linked"), (4, "result", "linked"), (5, "result", "orphan"),
    ]
    assert {r.status for r in got if r.conv_id is None or r.conv_id == 2} == {"orphan", "invalid_json"}
    for r in got:
        value = json.loads(r.json)
        assert json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r.json
    assert json.loads(got[-1].json)["role"] and any(json.loads(r.json).get("content") == odd for r in got)


def test_conversation_tables(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", None), (1, 2, "assistant", ""), (1, 3, "assistant", "again"), (2, 0, None, "x"), (2, 0, None, "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    from promolens.llm.tool_chat import ASK

    got = [(r.conv_id, r.turn, r.kind, r.status) for r in format_tool_chat(events_of(df), ASK).collect()]
    assert got == [
        (1, 0, "message", None), (1, 1, "call", "wrong_type:n_chars"), (1, 2, "result", "linked"), (1, 3, "result", "orphan"),
        (2, 0, "message", None), (2, 0, "message", None),
    ]
    assert format_tool_chat(events_of(df.limit(0)), ASK).count() == 0
