"""Chat formatting: tool calls linked to their results, with DataFrame functions only.

Messages: conv_id, turn, role, text. An assistant's text may be JSON with
`tool_calls: [{id, name, arguments, after: [ids]}]`, a tool's text JSON with `tool_call_id`
and `content`. Calls and results are hash-joined by conversation and identifier; calls are
ordered topologically (by level: a call comes after all those that it names in `after`), arguments are validated against the tools' schemas, and each pair is serialised
as canonical JSON (sorted keys, no spaces).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

CALLS = "struct<content:string,tool_calls:array<struct<id:string,name:string,arguments:string,after:array<string>>>>"
RESULT = "struct<tool_call_id:string,content:string>"
TYPES = {"number": "BIGINT|DECIMAL.*|DOUBLE|FLOAT", "string": "STRING", "boolean": "BOOLEAN", "array": "ARRAY.*", "object": "OBJECT.*"}

# Tools of the query below: field -> (type, required).
TURN_TOOLS = {
    "answer": {"question": ("string", True), "turn": ("integer", True), "language_hint": ("string", False)},
    "set_system": {"prompt": ("string", True), "turn": ("integer", True)},
}


def canonical(json: Column) -> Column:
    """Canonical JSON of a JSON text (a variant keeps an object's keys in order); null if it isn't JSON."""
    return F.to_json(F.try_parse_json(json))


def whole_number(value: Column, field: str, kind: Column) -> Column:
    """Whether a field is an integer, however long and however written (1e2, 1.0)."""
    number = F.try_variant_get(value, f"$.{field}", "double")
    written = kind.rlike(r"^(DECIMAL.*|DOUBLE|FLOAT)$") & F.coalesce(number == F.floor(number), F.lit(False))
    return kind.rlike(r"^(BIGINT|DECIMAL\(\d+,0\))$") | written


def argument_errors(name: Column, arguments: Column, tools: dict[str, dict[str, tuple[str, bool]]]) -> Column:
    """What is wrong with a call's arguments, as a comma-separated text; empty if nothing."""
    value = F.try_parse_json(arguments)
    kind = F.schema_of_variant(value)
    keys = F.map_keys(F.from_json(arguments, "map<string,string>"))
    is_object = F.coalesce(kind.startswith("OBJECT"), F.lit(False))
    found = [
        F.when(~name.isin(*tools) | name.isNull(), F.lit("unknown tool")),
        F.when(~is_object, F.lit("arguments are no object")),
    ]
    for tool, fields in tools.items():
        mine = (name == tool) & is_object
        for field, (wanted, required) in sorted(fields.items()):
            actual = F.schema_of_variant(F.try_variant_get(value, f"$.{field}", "variant"))
            absent = actual.isNull() | (actual == "VOID")
            if required:
                found.append(F.when(mine & absent, F.lit(f"no {field}")))
            fits = whole_number(value, field, actual) if wanted == "integer" else actual.rlike(f"^({TYPES[wanted]})$")
            found.append(F.when(mine & ~absent & ~fits, F.lit(f"{field} is no {wanted}")))
        extra = F.array_sort(F.array_except(keys, F.array(*[F.lit(f) for f in fields])))
        found.append(F.when(mine & (F.size(extra) > 0), F.concat(F.lit("unknown "), F.array_join(extra, " "))))
    return F.array_join(F.array_compact(F.array(*found)), ",")


def levels(calls: DataFrame) -> DataFrame:
    """conv_id, id, level: 0 for a call that comes after no other, else one more than the highest
    level it comes after; -1 for calls on or behind a cycle. Names of calls that the
    conversation hasn't got are passed over.

    A level is the length of the longest walk back. Walks of exactly 1, 2, 4, ... steps are kept
    by their two ends, each table the last one joined with itself, so there are as many rounds as
    the logarithm of the longest walk, whatever the graph; a table has at most a row for each call
    and each that stands before it. A call's longest walk of less than 2n steps takes n steps, if
    a walk of n starts there, and goes on with the longest of less than n. A walk of as many steps
    as there are calls goes round a cycle.
    """
    key = ["conv_id", "id"]
    named = calls.select(*key, F.explode("after").alias("parent")).distinct()
    walks = stored(named.join(end_of(calls), at_end("parent")).select(*key, "parent"), "call-walks")
    most = calls.groupBy("conv_id").count().agg(F.max("count").alias("n")).first()["n"] or 0
    placed, steps = stored(calls.select(*key, F.lit(0).alias("level")), "call-levels"), 1
    while steps < most and not walks.isEmpty():
        further = walks.join(end_of(placed, "level"), at_end("parent")).groupBy(*key).agg((F.max("end_level") + steps).alias("end_level"))
        longer = placed.join(further.withColumnsRenamed({"conv_id": "c", "id": "p"}), at_end("id"), "left")
        placed = stored(longer.select(*key, F.coalesce("end_level", "level").alias("level")), "call-levels")
        joined = walks.join(end_of(walks, "parent"), at_end("parent"))
        walks, steps = stored(joined.select(*key, F.col("end_parent").alias("parent")).distinct(), "call-walks"), 2 * steps
    cyclic = walks.select(F.col("conv_id").alias("c"), F.col("id").alias("p"), F.lit(-1).alias("cycle")).distinct()
    return placed.join(cyclic, at_end("id"), "left").select(*key, F.coalesce("cycle", "level").alias("level"))


def end_of(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.select(F.col("conv_id").alias("c"), F.col("id").alias("p"), *[F.col(x).alias(f"end_{x}") for x in columns])


def at_end(name: str) -> Column:
    """A null conv_id is a conversation of its own."""
    return F.col("conv_id").eqNullSafe(F.col("c")) & (F.col(name) == F.col("p"))


def link_tool_calls(messages: DataFrame, tools: dict[str, dict[str, tuple[str, bool]]]) -> DataFrame:
    """One row for each call of a conversation: conv_id, call_id, turn, place, level, name,
    n_calls, n_results, status, errors, json.

    Order a conversation by level, turn, place. Calls that share an identifier are one, the
    first by turn and place, n_calls tells how many there were; likewise results. status:
    `linked`, `no call` (a result alone), `no result`, `early` (the result's turn isn't
    after the call's) or `cycle`. A message that is null, empty or no JSON of the above
    shape has no calls, and so has one with a null role; JSON may stand in white space; a null conv_id is a conversation of its own, calls without id are
    left out. Groups are aggregated before they are shuffled. Other columns are ignored,
    an empty table gives an empty result.
    """
    own = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.col("text").cast("string").alias("text"))
    json_object = F.col("text").rlike(r"^[ \t\r\n]*\{")
    said = own.where((F.col("role") == "assistant") & json_object).select("conv_id", "turn", F.from_json("text", CALLS)["tool_calls"].alias("calls"))
    listed = said.select("conv_id", "turn", F.posexplode("calls").alias("place", "call")).where("call.id IS NOT NULL")
    first = F.min(F.struct("turn", "place", "call.name", "call.arguments", "call.after")).alias("first")
    calls = stored(
        listed.groupBy("conv_id", F.col("call.id").alias("id")).agg(first, F.count("*").alias("n_calls")).select("conv_id", "id", "first.*", "n_calls"),
        "calls",
    )
    told = own.where((F.col("role") == "tool") & json_object).select("conv_id", "turn", F.from_json("text", RESULT).alias("r")).where("r.tool_call_id IS NOT NULL")
    results = told.groupBy(F.col("conv_id").alias("c"), F.col("r.tool_call_id").alias("i")).agg(
        F.min(F.struct("turn", "r.content")).alias("result"), F.count("*").alias("n_results")
    )
    placed = levels(calls).select(F.col("conv_id").alias("lc"), F.col("id").alias("li"), "level")
    ordered = calls.join(placed, F.col("conv_id").eqNullSafe(F.col("lc")) & (F.col("id") == F.col("li"))).drop("lc", "li")
    joined = ordered.join(results, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("id") == F.col("i")), "full")
    status = (
        F.when(F.col("id").isNull(), "no call")
        .when(F.col("level") < 0, "cycle")
        .when(F.col("i").isNull(), "no result")
        .when(F.col("result.turn") <= F.col("turn"), "early")
        .otherwise("linked")
    )
    errors = F.when(F.col("id").isNull(), F.lit("")).otherwise(argument_errors(F.col("name"), F.col("arguments"), tools))
    call_id, conv = F.coalesce("id", "i"), F.when(F.col("id").isNull(), F.col("c")).otherwise(F.col("conv_id"))
    json = F.to_json(F.struct(call_id.alias("id"), F.col("name"), F.col("result.content").alias("result"), F.col("arguments").alias("raw")))
    with_arguments = F.when(
        F.try_parse_json(F.col("arguments")).isNotNull(),
        F.concat(F.lit('{"arguments":'), F.coalesce("arguments", F.lit("null")), F.lit(","), F.substring(F.to_json(F.struct(call_id.alias("id"), F.col("name"), F.col("result.content").alias("result"))), 2, 2**31 - 1)),
    ).otherwise(json)
    return joined.select(
        conv.alias("conv_id"), call_id.alias("call_id"), F.coalesce("turn", "result.turn").alias("turn"),
        F.coalesce("place", F.lit(0)).alias("place"), F.coalesce("level", F.lit(0)).alias("level"), "name",
        F.coalesce("n_calls", F.lit(0)).alias("n_calls"), F.coalesce("n_results", F.lit(0)).alias("n_results"),
        status.alias("status"), errors.alias("errors"), canonical(with_arguments).alias("json"),
    )


def turns_as_calls(conversations: DataFrame) -> DataFrame:
    """The same conversations as tool use: each turn of a user or the system becomes an
    assistant's call (with the turn two before it, if any, in `after`), each turn of an
    assistant the result for the turn before it. A turn with a null role counts as a user's."""
    answers = F.col("role").eqNullSafe(F.lit("assistant"))
    ident = lambda turn: F.concat(F.lit("t"), turn.cast("string"))
    is_system = F.col("role") == "system"
    arguments = F.when(is_system, F.to_json(F.struct(F.col("turn"), F.col("text").alias("prompt")))).otherwise(
        F.to_json(F.struct(F.col("turn"), F.col("text").alias("question")))
    )
    name = F.when(is_system, "set_system").otherwise("answer")
    head = F.to_json(F.struct(ident(F.col("turn")).alias("id"), name.alias("name"), F.array(ident(F.col("turn") - 2)).alias("after")))
    call = F.concat(F.lit('{"tool_calls":['), F.expr("substring(head, 1, length(head) - 1)"), F.lit(',"arguments":'), F.col("arguments"), F.lit("}]}"))
    asked = conversations.where(~answers).withColumn("head", head).withColumn("arguments", arguments)
    told = F.to_json(F.struct(ident(F.col("turn") - 1).alias("tool_call_id"), F.col("text").alias("content")))
    return asked.select("conv_id", "turn", F.lit("assistant").alias("role"), call.alias("text")).unionByName(
        conversations.where(answers).select("conv_id", "turn", F.lit("tool").alias("role"), told.alias("text"))
    )


def op7_tool_calls(spark, sf_dir: str) -> DataFrame:
    return link_tool_calls(turns_as_calls(spark.read.parquet(f"{sf_dir}/conversations.parquet")), TURN_TOOLS)


OP7_SQL = """
WITH c AS (SELECT conv_id, turn, min(CASE WHEN role = 'system' THEN 'set_system' ELSE 'answer' END) AS name, min(text) AS text, count(*) AS n
  FROM conversations WHERE role IS DISTINCT FROM 'assistant' GROUP BY conv_id, turn),
r AS (SELECT conv_id, turn - 1 AS call_turn, min(turn) AS turn, min(text) AS text, count(*) AS n
  FROM conversations WHERE role = 'assistant' GROUP BY conv_id, turn),
l AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn % 2, grp ORDER BY turn) - 1 AS level FROM (
  SELECT *, turn // 2 - row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS grp FROM c))
SELECT coalesce(l.conv_id, r.conv_id) AS conv_id, 't' || coalesce(l.turn, r.call_turn) AS call_id, coalesce(l.turn, r.turn) AS turn,
  0 AS place, CAST(coalesce(level, 0) AS INTEGER) AS level, name, coalesce(l.n, 0) AS n_calls, coalesce(r.n, 0) AS n_results,
  CASE WHEN l.turn IS NULL THEN 'no call' WHEN r.turn IS NULL THEN 'no result' ELSE 'linked' END AS status, '' AS errors,
  '{' || CASE WHEN l.turn IS NULL THEN '' WHEN name = 'answer' THEN '"arguments":{"question":' || CAST(to_json(l.text) AS VARCHAR) || ',"turn":' || l.turn || '},'
    ELSE '"arguments":{"prompt":' || CAST(to_json(l.text) AS VARCHAR) || ',"turn":' || l.turn || '},' END
  || '"id":"t' || coalesce(l.turn, r.call_turn) || '"' || CASE WHEN name IS NULL THEN '' ELSE ',"name":"' || name || '"' END
  || CASE WHEN r.text IS NULL THEN '' ELSE ',"result":' || CAST(to_json(r.text) AS VARCHAR) END || '}' AS json
FROM l FULL JOIN r ON l.conv_id = r.conv_id AND l.turn = r.call_turn
"""
