"""Tool-call linking with DataFrame functions alone.

Calls and results meet in a hash join on (conversation, call id), after the results of one
id are aggregated, so the built side has one row an id. Calls that build on other calls are
put in topological order: a call's depth is the number of calls it rests on, found by
pointer doubling (each round halves the way to the root), and (depth, turn, id) orders a
conversation. Arguments are parsed as JSON variants and checked against the tool's schema;
each call is written as one line of canonical JSON (keys sorted, no blanks).

Statuses, the first that holds: ``no_id`` (null conversation or id), ``cycle`` (the call
rests on itself), ``unknown_tool``, ``bad_json`` (arguments are no JSON object, or repeat a
key), ``invalid`` (see ``errors``), ``no_result``, ``ok``; a result without a call is
``orphan_result``, one row an id. ``errors`` lists ``missing:p``, ``type:p`` and
``unknown:p`` in order. A parent that doesn't exist counts as none.

Edge cases: repeated rows of one call id are one call, the earliest (then the smallest
name and arguments) and of several results the first by turn, then content; null arguments
are ``bad_json``; null contents of results are results; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickweave.llm.common import store

#: Turns that one cell of the position count spans.
CELL_TURNS = 1024

#: JSON types of a schema, as patterns of the variant's type name.
TYPES = {"string": "STRING", "integer": r"BIGINT|DECIMAL\(\d+,0\)", "number": r"BIGINT|DOUBLE|DECIMAL\(.*\)", "boolean": "BOOLEAN",
         "array": "ARRAY<.*>", "object": "OBJECT<.*>", "null": "VOID"}


def depths(calls: DataFrame) -> DataFrame:
    """conv_id, call_id, depth (null on or above a cycle) of calls (conv_id, call_id,
    depends_on), one row an id."""
    ids = calls.select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"))
    now = store(calls.select("conv_id", "call_id", "depends_on").join(ids, F.expr("conv_id = c and depends_on = i"), "left")
                .select("conv_id", "call_id", F.col("i").alias("up"), F.when(F.col("i").isNull(), 0).otherwise(1).cast("long").alias("depth")), "depths")
    n = now.count()
    span = 1
    while span <= n and now.where("up is not null").limit(1).count():
        above = now.select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"), F.col("up").alias("next"), F.col("depth").alias("more"))
        now = store(now.join(above, F.expr("conv_id = c and up = i"), "left").select(
            "conv_id", "call_id", F.col("next").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), "depths")
        span *= 2
    return now.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def _errors(types: F.Column, schema: F.Column) -> F.Column:
    """missing, type and unknown parameters of one call; ``types`` maps its arguments to
    variant type names, ``schema`` maps parameters to (pattern, required)."""
    missing = F.transform(F.filter(F.map_keys(schema), lambda p: F.element_at(schema, p)["required"] & ~F.map_contains_key(types, p)),
                          lambda p: F.concat(F.lit("missing:"), p))
    wrong = F.transform(F.filter(F.map_keys(types), lambda p: F.map_contains_key(schema, p)
                                 & ~F.regexp_like(F.element_at(types, p), F.concat(F.lit("^("), F.element_at(schema, p)["pattern"], F.lit(")$")))),
                        lambda p: F.concat(F.lit("type:"), p))
    unknown = F.transform(F.filter(F.map_keys(types), lambda p: ~F.map_contains_key(schema, p)), lambda p: F.concat(F.lit("unknown:"), p))
    return F.array_sort(F.concat(missing, wrong, unknown))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """conv_id, position, call_id, name, depth, status, errors, n_results, message.

    ``calls``: conv_id, turn, call_id, name, arguments (JSON), depends_on (a call id);
    ``results``: conv_id, turn, call_id, content; ``schemas``: name, parameter, type (a key of
    TYPES), required. ``position`` counts a conversation's calls from 1, parents first; calls
    on cycles follow, and orphan results have none."""
    first = calls.groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "name", "arguments", "depends_on")).alias("first")) \
        .select("conv_id", "call_id", "first.*")
    named = store(first.where("conv_id is not null and call_id is not null"), "calls")
    answers = results.groupBy("conv_id", "call_id").agg(F.count("*").alias("n_results"), F.min(F.struct("turn", "content")).alias("answer")) \
        .select("conv_id", "call_id", "n_results", F.col("answer.content").alias("content"))
    tools = schemas.groupBy("name").agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct(
        "parameter", F.struct(F.coalesce(*[F.when(F.col("type") == t, F.lit(p)) for t, p in TYPES.items()], F.lit("$.")).alias("pattern"),
                              F.coalesce("required", F.lit(False)).alias("required")))))).alias("schema"))
    deep = named.join(depths(named), ["conv_id", "call_id"])
    cell = Window.partitionBy("conv_id", "deep", "span")
    celled = deep.withColumn("deep", F.coalesce("depth", F.lit((1 << 62)))).withColumn("span", F.floor(F.coalesce("turn", F.lit(0)) / CELL_TURNS))
    before = celled.groupBy("conv_id", "deep", "span").count().select(
        "conv_id", "deep", "span", (F.sum("count").over(Window.partitionBy("conv_id").orderBy("deep", "span")) - F.col("count")).alias("before"))
    placed = celled.withColumn("nth", F.row_number().over(cell.orderBy("turn", "call_id"))).join(before, ["conv_id", "deep", "span"]) \
        .select("conv_id", "call_id", "turn", "name", "arguments", "depth", (F.col("before") + F.col("nth")).cast("long").alias("position"),
                F.lit(True).alias("has_id"))
    lost = first.where("conv_id is null or call_id is null").select(
        "conv_id", "call_id", "turn", "name", "arguments", F.lit(None).cast("long").alias("depth"), F.lit(None).cast("long").alias("position"),
        F.lit(False).alias("has_id"))
    ask = placed.unionByName(lost).withColumn("is_call", F.lit(True))
    both = ask.join(answers.hint("shuffle_hash"), ["conv_id", "call_id"], "full_outer").join(tools, "name", "left")
    value = both.withColumn("value", F.try_parse_json("arguments"))
    value = value.withColumn("object", F.coalesce(F.startswith(F.schema_of_variant("value"), F.lit("OBJECT<")), F.lit(False)))
    checked = value.withColumn("errors", F.when(F.col("object") & F.col("schema").isNotNull(), _errors(
        F.transform_values(F.from_json("arguments", "map<string, variant>"), lambda k, v: F.schema_of_variant(v)), F.col("schema"))))
    status = (F.when(F.col("is_call").isNull(), "orphan_result").when(~F.col("has_id"), "no_id").when(F.col("depth").isNull(), "cycle")
              .when(F.col("schema").isNull(), "unknown_tool").when(~F.col("object"), "bad_json").when(F.size("errors") > 0, "invalid")
              .when(F.col("n_results").isNull(), "no_result").otherwise("ok"))
    message = F.to_json(F.struct(F.when(F.col("object"), F.col("value")).alias("arguments"), F.col("call_id").alias("id"), "name",
                                 F.col("content").alias("result"), F.col("status")), {"ignoreNullFields": "false"})
    return checked.withColumn("status", status).select(
        "conv_id", "position", "call_id", "name", "depth", "status", F.array_join(F.coalesce("errors", F.array().cast("array<string>")), ",").alias("errors"),
        F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"), message.alias("message"))


#: The tools that the registered query derives calls for.
SCHEMAS = [("search", "query", "string", True), ("search", "limit", "integer", False), ("summarize", "text", "string", True),
           ("summarize", "ratio", "number", True), ("translate", "text", "string", True), ("translate", "options", "object", False)]


def calls_of_conversations(spark: SparkSession, turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(calls, results, schemas) of a table conv_id, turn, role, text: every assistant turn is
    a call whose arguments carry the whole text and that builds on the assistant turn two
    before; every other turn answers the turn before it. Which tool, and what is wrong with
    the arguments, follows from ids and lengths."""
    call_id = lambda t: F.concat(F.lit("call-"), F.col("conv_id").cast("string"), F.lit("-"), t.cast("string"))
    n = F.length("text")
    tool = F.element_at(F.array(*map(F.lit, ("search", "summarize", "translate", "draw"))), (F.pmod(F.col("conv_id") + F.col("turn"), F.lit(4)) + 1).cast("int"))
    odd = F.when(F.pmod(n, F.lit(7)) == 0, F.lit("seven")).otherwise(F.col("text"))
    arguments = (F.when(F.col("text").isNull(), None)
                 .when(F.pmod(n, F.lit(13)) == 0, F.concat(F.lit("{broken "), F.substring("text", 1, 9)))
                 .when(F.col("name") == "search", F.to_json(F.struct(F.col("text").alias("query"), F.when(F.pmod(n, F.lit(5)) == 0, n.cast("string")).alias("limit"))))
                 .when(F.col("name") == "summarize", F.to_json(F.struct(odd.alias("text"), F.when(F.pmod(n, F.lit(3)) > 0, F.lit(0.5)).alias("ratio"))))
                 .otherwise(F.to_json(F.struct(F.col("text").alias("text"), F.struct(F.lit("en").alias("to"), n.alias("chars")).alias("options"),
                                               F.when(F.pmod(n, F.lit(11)) == 0, F.lit(True)).alias("extra")))))
    calls = turns.where("role = 'assistant'").withColumn("name", tool).select(
        "conv_id", "turn", call_id(F.col("turn")).alias("call_id"), "name", arguments.alias("arguments"), call_id(F.col("turn") - 2).alias("depends_on"))
    results = turns.where("role != 'assistant' and turn > 0").select("conv_id", "turn", call_id(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    return calls, results, spark.createDataFrame(SCHEMAS, "name string, parameter string, type string, required boolean")
