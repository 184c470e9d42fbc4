"""Chat formatting with linked tool calls, with DataFrame functions only.

Calls and results meet in a hash join on (conversation, identifier). A result may have been logged before its call: in
the topological order it follows the call. Arguments are parsed as variants, checked against the schema of their tool,
and serialised as canonical JSON: sorted keys, no white space, nothing left out. Rows are dealt out by ranges of the
order, so a conversation of any length is never held by one task.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm.common import keep

# JSON types and the variant types they appear as.
TYPES = {
    "string": "STRING",
    "integer": "BIGINT",
    "number": "BIGINT|DOUBLE|FLOAT|DECIMAL.*",
    "boolean": "BOOLEAN",
    "object": "OBJECT.*",
    "array": "ARRAY.*",
    "null": "VOID",
}


@dataclass(frozen=True)
class Tool:
    """Arguments of a tool by JSON type; ``extra`` allows others besides."""

    required: dict[str, str] = field(default_factory=dict)
    optional: dict[str, str] = field(default_factory=dict)
    extra: bool = False


def _argument(args: Column, name: str) -> Column:
    quoted = name.replace("\\", "\\\\").replace("'", "\\'")
    return F.variant_get(args, f"$['{quoted}']", "variant")


def _status(tools: dict[str, Tool]) -> Column:
    """First failure of a call: unknown_tool, invalid_json, missing:NAME, wrong_type:NAME, unexpected; else valid."""
    args = F.col("args")
    out = F.when(~F.coalesce(F.col("tool").isin(*tools), F.lit(False)), F.lit("unknown_tool"))
    out = out.when(args.isNull() | ~F.schema_of_variant(args).startswith("OBJECT"), F.lit("invalid_json"))
    for name, tool in sorted(tools.items()):
        mine = F.col("tool") == name
        for key in sorted(tool.required):
            out = out.when(mine & _argument(args, key).isNull(), F.lit(f"missing:{key}"))
        for key, kind in sorted({**tool.required, **tool.optional}.items()):
            value = _argument(args, key)
            out = out.when(mine & value.isNotNull() & ~F.schema_of_variant(value).rlike(f"^({TYPES[kind]})$"), F.lit(f"wrong_type:{key}"))
        if not tool.extra:
            known = F.array(*(F.lit(k) for k in sorted({*tool.required, *tool.optional}))).cast("array<string>")
            given = F.map_keys(F.from_json("arguments", "map<string,string>"))
            out = out.when(mine & (F.size(F.array_except(given, known)) > 0), F.lit("unexpected"))
    return out.otherwise(F.lit("valid"))


def _quoted(value: Column) -> Column:
    """A string as JSON; a missing one as null."""
    listed = F.to_json(F.array(value))
    return F.when(value.isNull(), F.lit("null")).otherwise(F.substring(listed, F.lit(2), F.length(listed) - 2))


def format_tool_chat(events: DataFrame, tools: dict[str, Tool]) -> DataFrame:
    """Link, order, validate and serialise chat events.

    ``events`` has conv_id, turn, kind (call, result or anything else for a plain message), role, content, call_id,
    tool and arguments (JSON text). Returns one row per event, ordered by the output's order_turn, order_step and json
    within conv_id: conv_id, turn, order_turn, order_step, kind, call_id, status, json. Status of a call is what
    ``_status`` says; of a result, linked or orphan; of a message, null. Of several calls with one identifier in a
    conversation the one of the earliest turn counts; several results of a call all link to it. A null conv_id or call_id
    links with nothing. Arguments that are no JSON are kept as a JSON string. Repeated rows stay; other columns are not
    read; an empty table gives no rows.
    """
    e = events.select("conv_id", "turn", "kind", "role", "content", "call_id", "tool", "arguments")
    called = e.filter(F.col("kind") == "call").groupBy("conv_id", "call_id").agg(F.min("turn").alias("call_turn"), F.count("*").alias("n_calls"))
    called = keep(called.filter(F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()), "calls")
    results = e.filter(F.col("kind") == "result").join(called.hint("shuffle_hash"), ["conv_id", "call_id"], "left")
    order_turn = F.greatest("turn", "call_turn")
    linked = results.select(
        "conv_id",
        "turn",
        order_turn.alias("order_turn"),
        F.lit(1).alias("order_step"),
        "kind",
        "call_id",
        F.when(F.col("n_calls").isNotNull(), F.lit("linked")).otherwise(F.lit("orphan")).alias("status"),
        F.concat(F.lit('{"content":'), _quoted(F.col("content")), F.lit(',"role":"tool","tool_call_id":'), _quoted(F.col("call_id")), F.lit("}")).alias("json"),
    )
    rest = e.filter(F.coalesce(F.col("kind") != "result", F.lit(True))).withColumn("args", F.try_parse_json("arguments"))
    is_call = F.coalesce(F.col("kind") == "call", F.lit(False))
    shown = F.coalesce(F.to_json("args"), _quoted(F.col("arguments")))
    as_call = F.concat(
        F.lit('{"arguments":'), shown, F.lit(',"id":'), _quoted(F.col("call_id")), F.lit(',"name":'), _quoted(F.col("tool")), F.lit(',"role":"assistant"}')
    )
    as_message = F.concat(F.lit('{"content":'), _quoted(F.col("content")), F.lit(',"role":'), _quoted(F.col("role")), F.lit("}"))
    others = rest.select(
        "conv_id",
        "turn",
        F.col("turn").alias("order_turn"),
        F.lit(0).alias("order_step"),
        "kind",
        "call_id",
        F.when(is_call, _status(tools)).alias("status"),
        F.when(is_call, as_call).otherwise(as_message).alias("json"),
    )
    return linked.unionByName(others).orderBy("conv_id", "order_turn", "order_step", "json")


ASK = {"ask": Tool(required={"n_chars": "integer", "text": "string"})}


def events_of(conversations: DataFrame) -> DataFrame:
    """The turns of a conversation table as events: a user's turn calls the tool ``ask``, the assistant's turn after it
    holds the result, other turns are messages."""
    user, assistant = F.col("role") == "user", F.col("role") == "assistant"
    call_turn = F.when(user, F.col("turn")).when(assistant, F.col("turn") - 1)
    arguments = F.to_json(F.struct(F.col("text"), F.length("text").alias("n_chars")), {"ignoreNullFields": "false"})
    return conversations.select(
        "conv_id",
        "turn",
        F.when(user, F.lit("call")).when(assistant, F.lit("result")).otherwise(F.lit("message")).alias("kind"),
        "role",
        F.col("text").alias("content"),
        F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), call_turn.cast("string")).alias("call_id"),
        F.when(user, F.lit("ask")).alias("tool"),
        F.when(user, arguments).alias("arguments"),
    )


def op10_tool_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_tool_chat(events_of(spark.read.parquet(f"{sf_dir}/conversations.parquet")), ASK)


OP10_SQL = """
WITH e AS (
    SELECT conv_id, turn, role, text,
           CASE role WHEN 'user' THEN 'call' WHEN 'assistant' THEN 'result' ELSE 'message' END AS kind,
           CASE role WHEN 'user' THEN 'c' || conv_id || '-' || turn
                     WHEN 'assistant' THEN 'c' || conv_id || '-' || (turn - 1) END AS call_id
    FROM conversations
), called AS (
    SELECT conv_id, call_id, min(turn) AS call_turn FROM e
    WHERE kind = 'call' AND conv_id IS NOT NULL AND call_id IS NOT NULL GROUP BY ALL
)
SELECT e.conv_id, e.turn, e.kind, e.call_id,
       CASE WHEN kind = 'result' THEN greatest(e.turn, call_turn) ELSE e.turn END AS order_turn,
       CASE WHEN kind = 'result' THEN 1 ELSE 0 END AS order_step,
       CASE WHEN kind = 'call' AND text IS NULL THEN 'wrong_type:n_chars' WHEN kind = 'call' THEN 'valid'
            WHEN kind = 'result' AND call_turn IS NULL THEN 'orphan' WHEN kind = 'result' THEN 'linked' END AS status,
       CASE kind
           WHEN 'call' THEN '{"arguments":{"n_chars":' || coalesce(length(text)::VARCHAR, 'null') || ',"text":'
                || coalesce(to_json(text)::VARCHAR, 'null') || '},"id":' || to_json(e.call_id)::VARCHAR
                || ',"name":"ask","role":"assistant"}'
           WHEN 'result' THEN '{"content":' || coalesce(to_json(text)::VARCHAR, 'null') || ',"role":"tool","tool_call_id":'
                || to_json(e.call_id)::VARCHAR || '}'
           ELSE '{"content":' || coalesce(to_json(text)::VARCHAR, 'null') || ',"role":'
                || coalesce(to_json(role)::VARCHAR, 'null') || '}'
       END AS json
FROM e LEFT JOIN called ON kind = 'result' AND e.conv_id = called.conv_id AND e.call_id = called.call_id
"""
