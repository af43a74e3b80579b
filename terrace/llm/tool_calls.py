"""Chat formatting: link tool calls to their results, order, validate and serialise them.

Messages (conv_id, turn, role, text) carry calls in assistant messages, as JSON
``{"tool_calls": [{"id", "name", "arguments"}]}``, and results in tool messages, as
``{"tool_call_id", "content"}``. An argument ``"$result:<id>"`` uses the result of another
call of the conversation.

1. Calls and results join by (conversation, id, n-th use of the id), so a conversation with a
   third of all messages spreads over its ids.
2. The order key of a call is (turn from which all it needs is known, steps after that,
   turn, position). It grows along every dependency, so sorting by it is a topological order
   that stays as close as it can to the order of the messages. Only dependencies on later
   calls move a key; rounds go on until no key changes. A key's steps lead over calls that moved,
   so a step beyond their number in the conversation shows a circle; that call and all that
   need it, near or far, are marked. Rounds grow with the longest such chain, not with the data.
3. Arguments are parsed as variants and checked against (name, parameter, type, required).
4. The record is written as canonical JSON: keys sorted, no white space, one form of numbers.

Defined cases. Messages that are not such JSON, NULL texts and other roles: no call. A
repeated id: its n-th call belongs to its n-th result. A result without a call: a row with
status ``orphan_result``. A call without a result: ``missing_result``. A result before its
call: ``early_result``. Arguments that are no JSON object: invalid, kept as text. An unknown
tool: invalid. Calls on or behind a circle of dependencies: ordered by turn with ``ordered``
false. A dependency on an unknown id: no constraint, reported. Messages of one turn are told
apart by their content, so reruns agree. A schema row that repeats a (name, parameter): required
if any row says so, the type that sorts first; a NULL type allows any; a NULL parameter only
names the tool. Empty tables: empty result. NULL conv_id: a conversation of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm.common import staged

REFERENCE = r'"\$result:([^"]+)"'
CALLS = "tool_calls array<struct<id: string, name: string, arguments: string>>"


def _nth(df: DataFrame, *content: str) -> DataFrame:
    use = Window.partitionBy("conv", "id").orderBy("turn", "position", *content)
    return df.withColumn("nth", F.row_number().over(use))


def calls(messages: DataFrame) -> DataFrame:
    """conv, id, nth, turn, position, name, arguments of every call."""
    said = messages.filter("role = 'assistant' and text is not null").select(
        F.col("conv_id").alias("conv"), "turn", F.from_json("text", CALLS).alias("m")
    )
    each = said.select("conv", "turn", F.posexplode("m.tool_calls").alias("position", "c"))
    return _nth(each.select("conv", F.col("c.id").alias("id"), "turn", "position", F.col("c.name").alias("name"), F.col("c.arguments").alias("arguments")), "name", "arguments")


def results(messages: DataFrame) -> DataFrame:
    """conv, id, nth, turn, content of every result."""
    said = messages.filter("role = 'tool' and text is not null").select(
        F.col("conv_id").alias("conv"), "turn", F.lit(0).alias("position"),
        F.from_json("text", "tool_call_id string, content string").alias("m"),
    )
    return _nth(said.filter("m.tool_call_id is not null").select(
        "conv", F.col("m.tool_call_id").alias("id"), "turn", "position", F.col("m.content").alias("content")
    ), "content")


def link(messages: DataFrame) -> DataFrame:
    """One row per call with its result, and per result without a call."""
    c = calls(messages).alias("c")
    r = results(messages).withColumnRenamed("turn", "result_turn").alias("r")
    on = F.col("c.conv").eqNullSafe(F.col("r.conv")) & (F.col("c.id") == F.col("r.id")) & (F.col("c.nth") == F.col("r.nth"))
    status = (
        F.when(F.col("c.turn").isNull(), "orphan_result")
        .when(F.col("r.result_turn").isNull(), "missing_result")
        .when(F.col("r.result_turn") <= F.col("c.turn"), "early_result")
        .otherwise("linked")
    )
    return c.join(r, on, "full_outer").select(
        F.coalesce("c.conv", "r.conv").alias("conv"), F.coalesce("c.id", "r.id").alias("id"),
        F.coalesce("c.nth", "r.nth").alias("nth"), F.col("c.turn").alias("turn"), "c.position",
        F.col("c.name").alias("name"), "c.arguments", "r.result_turn", "r.content", status.alias("status"),
    )


def order_keys(linked: DataFrame) -> DataFrame:
    """conv, id, nth, since, step, ordered, unknown (dependencies on no call) of every call."""
    nodes = linked.filter("turn is not null").select("conv", "id", "nth", "turn", "arguments")
    key = F.struct(F.col("turn").alias("since"), F.lit(0).alias("step"))
    needs = nodes.select(
        "conv", "id", "nth", "turn", F.explode(F.array_distinct(F.regexp_extract_all("arguments", F.lit(REFERENCE), F.lit(1)))).alias("needed")
    )
    # A reference means the first call of that id.
    firsts = nodes.filter("nth = 1").select("conv", F.col("id").alias("needed"), F.col("turn").alias("needed_turn"))
    n, f = needs.alias("n"), firsts.alias("f")
    same = F.col("n.conv").eqNullSafe(F.col("f.conv")) & (F.col("n.needed") == F.col("f.needed"))
    needs = staged(n.join(f, same, "left").select("n.*", "needed_turn"), "calls-needs")
    unknown = needs.filter("needed_turn is null").groupBy("conv", "id", "nth").agg(F.sort_array(F.collect_set("needed")).alias("unknown"))
    edges = needs.filter("needed_turn is not null")
    no = F.lit(False)
    state = staged(
        nodes.select("conv", "id", "nth", "turn", key.alias("key"), no.alias("moved"), no.alias("circular"), no.alias("changed")), "calls-order"
    )
    while True:
        s = state.filter("nth = 1").select("conv", F.col("id").alias("needed"), F.col("key").alias("needed_key"), "circular").alias("s")
        e = edges.alias("e")
        same = F.col("e.conv").eqNullSafe(F.col("s.conv")) & (F.col("e.needed") == F.col("s.needed"))
        after = F.struct(F.col("needed_key.since").alias("since"), (F.col("needed_key.step") + 1).alias("step"))
        pull = e.join(s, same).groupBy("e.conv", "e.id", "e.nth").agg(F.max(after).alias("pull"), F.bool_or("circular").alias("behind")).alias("p")
        chains = state.filter("moved").groupBy("conv").agg(F.count(F.lit(1)).alias("longest")).alias("m")
        t = state.alias("t")
        same = F.col("t.conv").eqNullSafe(F.col("p.conv")) & (F.col("t.id") == F.col("p.id")) & (F.col("t.nth") == F.col("p.nth"))
        moves = F.coalesce(F.col("p.pull") > F.col("t.key"), no) & ~F.col("t.circular")
        step = F.when(moves, F.col("p.pull.step")).otherwise(F.col("t.key.step"))
        # The count is of the round before, when this call may not have moved yet.
        circular = F.col("t.circular") | F.coalesce(F.col("p.behind"), no) | (step > F.coalesce(F.col("m.longest"), F.lit(0)) + 1)
        state = staged(
            t.join(pull, same, "left").join(chains, F.col("t.conv").eqNullSafe(F.col("m.conv")), "left").select(
                "t.conv", "t.id", "t.nth", "t.turn", F.when(moves, F.col("p.pull")).otherwise(F.col("t.key")).alias("key"),
                (F.col("t.moved") | moves).alias("moved"), circular.alias("circular"), (moves | (circular & ~F.col("t.circular"))).alias("changed"),
            ),
            "calls-order",
        )
        if state.filter("changed").isEmpty():
            break
    s, u = state.alias("s"), unknown.alias("u")
    same = F.col("s.conv").eqNullSafe(F.col("u.conv")) & (F.col("s.id") == F.col("u.id")) & (F.col("s.nth") == F.col("u.nth"))
    final = F.when(F.col("s.circular"), F.struct(F.col("s.turn").alias("since"), F.lit(0).alias("step"))).otherwise(F.col("s.key"))
    return s.join(u, same, "left").select(
        "s.conv", "s.id", "s.nth", final["since"].alias("since"), final["step"].alias("step"), (~F.col("s.circular")).alias("ordered"), "u.unknown"
    )


def _type(value: Column) -> Column:
    """JSON type of a variant."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array")
        .when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean").when(kind == "VOID", "null")
        .when(kind == "BIGINT", "integer").when(kind.rlike(r"^DECIMAL\([0-9]+,0\)$"), "integer").otherwise("number")
    )


def validate(linked: DataFrame, schemas: DataFrame) -> DataFrame:
    """conv, id, nth, errors of every call against ``schemas`` (name, parameter, type, required)."""
    once = schemas.filter("name is not null").groupBy("name", "parameter").agg(
        F.min("type").alias("type"), F.coalesce(F.bool_or("required"), F.lit(False)).alias("required")
    )
    entry = F.when(F.col("parameter").isNotNull(), F.struct("parameter", F.struct("type", "required")))
    tools = once.groupBy("name").agg(F.map_from_entries(F.collect_list(entry)).alias("spec"))
    c = linked.filter("turn is not null").select("conv", "id", "nth", "name", F.try_parse_json("arguments").alias("v"))
    c = c.join(tools, "name", "left")
    is_object = F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False))
    # An object's top-level values keep their JSON form in a map of variants.
    values = F.when(is_object, F.col("v").try_cast("map<string, variant>"))
    c = c.withColumn("is_object", is_object).withColumn("given", values)
    given = F.coalesce(F.map_keys("given"), F.array().cast("array<string>"))
    known = F.map_keys("spec")
    required = F.map_keys(F.map_filter("spec", lambda k, s: s["required"]))
    wrong = F.filter(
        F.array_intersect(given, known),
        lambda k: ~(
            (_type(F.try_element_at("given", k)) == F.try_element_at("spec", k)["type"])
            | ((F.try_element_at("spec", k)["type"] == "number") & (_type(F.try_element_at("given", k)) == "integer"))
        ),
    )
    note = lambda what, names: F.transform(names, lambda n: F.concat(F.lit(what + ":"), n))
    errors = (
        F.when(F.col("spec").isNull(), F.array(F.lit("unknown_tool")))
        .when(~F.col("is_object"), F.array(F.lit("not_an_object")))
        .otherwise(F.array_sort(F.concat(
            note("missing", F.array_except(required, given)), note("unexpected", F.array_except(given, known)), note("type", wrong)
        )))
    )
    return c.select("conv", "id", "nth", errors.alias("errors"))


def format_calls(messages: DataFrame, schemas: DataFrame) -> DataFrame:
    """Linked, ordered, validated calls with their canonical JSON record, one row per call or orphan result."""
    linked = staged(link(messages), "calls-linked")
    o, v = order_keys(linked).alias("o"), validate(linked, schemas).alias("v")

    def same(x: str):
        on = F.col("l.conv").eqNullSafe(F.col(f"{x}.conv")) & (F.col("l.id") == F.col(f"{x}.id"))
        return on & (F.col("l.nth") == F.col(f"{x}.nth")) & F.col("l.turn").isNotNull()

    canonical = F.coalesce(F.to_json(F.try_parse_json("l.arguments")), F.to_json(F.struct("l.arguments")))
    record = F.concat(
        F.lit('{"arguments":'), F.coalesce(canonical, F.lit("null")),
        F.lit(',"id":'), F.coalesce(_quoted(F.col("l.id")), F.lit("null")), F.lit(',"name":'), F.coalesce(_quoted(F.col("l.name")), F.lit("null")),
        F.lit(',"result":'), F.coalesce(_quoted(F.col("l.content")), F.lit("null")), F.lit("}"),
    )
    return linked.alias("l").join(o, same("o"), "left").join(v, same("v"), "left").select(
        F.col("l.conv").alias("conv_id"), F.col("l.id").alias("call_id"), F.col("l.nth").alias("nth"), F.col("l.name").alias("name"),
        F.col("l.turn").alias("turn"), F.col("l.position").alias("position"), F.col("l.result_turn").alias("result_turn"), "status",
        "since", "step", "ordered", "unknown", F.coalesce("errors", F.array().cast("array<string>")).alias("errors"),
        (F.size(F.coalesce("errors", F.array(F.lit("orphan")))) == 0).alias("valid"), record.alias("record"),
    )


def _quoted(text: Column) -> Column:
    """A string as JSON text; NULL for NULL."""
    return F.when(text.isNotNull(), F.regexp_extract(F.to_json(F.struct(text.alias("s"))), r'(?s)^\{"s":(.*)\}$', 1))
