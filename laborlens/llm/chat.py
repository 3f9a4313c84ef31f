"""Tool calls of chats: linked with their results, ordered, checked and written as canonical JSON.

Calls and results are joined by conversation and identifier. A call whose arguments name another call of its
conversation, at any depth, waits for that call's result; levels order the calls topologically. Arguments are checked
against a table of properties, nested ones too. All of it is Spark SQL: one row a call, so a long conversation is never
gathered; a short one whose calls hang on earlier ones only is ordered in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import stored

#: The kinds of JSON values, by the type that Spark gives them.
KINDS = {"STRING": "string", "BIGINT": "integer", "BOOLEAN": "boolean", "VOID": "null", "DOUBLE": "number", "FLOAT": "number"}
CYCLE = -1
#: Waiting calls of a conversation that may be ordered in one row.
SHORT = 2000
#: A JSON string, and the pieces of a JSON text: strings, numbers, anything else. No part is tried twice, so long texts are safe.
STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
PIECES = STRING + r'|-?[0-9][0-9.eE+-]*+|[^"0-9-]++|-'


def _canonical(value: Column) -> Column:
    """JSON text of a variant: sorted keys, no white space, one spelling for equal numbers."""
    def spelled(piece: Column) -> Column:
        number = piece.try_cast("double")
        whole = (F.abs(number) < 1e15) & (number == F.floor(number))
        as_number = F.when(whole, number.cast("bigint").cast("string")).when(piece.rlike("^-?[0-9]+$"), piece).otherwise(number.cast("string"))
        return F.when(piece.rlike("^-?[0-9]"), as_number).otherwise(piece)

    text = F.to_json(value)
    # whole numbers are spelled alike already, but for the sign of zero
    return F.when(text.rlike(r"[0-9][.eE]|-0"), F.array_join(F.transform(F.regexp_extract_all(text, F.lit(PIECES), F.lit(0)), spelled), "")).otherwise(text)


def _kind(value):
    """string, integer, number, boolean, null, array or object."""
    name = F.schema_of_variant(value)
    known = F.coalesce(*[F.when(name == k, F.lit(v)) for k, v in KINDS.items()])
    return F.coalesce(known, F.when(name.startswith("ARRAY"), F.lit("array")), F.when(name.startswith("OBJECT"), F.lit("object")),
                      F.when(name.startswith("DECIMAL"), F.lit("number")))


def _ordered(needs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Levels of the short conversations whose calls hang on earlier ones, and the needs of all others.

    ``needs``: ``conv_id, call_id, place, need, need_place`` with the calls' order in their conversation; a need's place is
    null where that call needs nothing itself.
    """
    counts = needs.groupBy("conv_id").agg(
        F.count_distinct("call_id").alias("n"), F.bool_or(F.coalesce(F.col("need_place") >= F.col("place"), F.lit(False))).alias("back"))
    plain = stored(counts.filter((F.col("n") <= SHORT) & ~F.col("back")).select("conv_id"), "short")
    of_call = needs.join(plain, "conv_id", "left_semi").groupBy("conv_id", "call_id", "place").agg(F.collect_set("need_place").alias("on"))
    numbered = of_call.withColumn("i", F.row_number().over(W.partitionBy("conv_id").orderBy("place")))
    rows = numbered.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", "call_id", "on"))).alias("calls"))
    places = F.transform("calls", lambda c: c["place"])

    def following(levels: Column, call: Column) -> Column:
        held = F.transform(call["on"], lambda p: F.get(levels, F.array_position(places, p).cast("int") - 1))
        return F.concat(levels, F.array(F.coalesce(F.array_max(held), F.lit(0)) + 1))

    levels = F.aggregate("calls", F.array().cast("array<int>"), following)
    done = rows.withColumn("levels", levels).select("conv_id", F.inline(F.arrays_zip(F.col("calls.call_id").alias("call_id"), F.col("levels").alias("level"))))
    return done, needs.join(plain, "conv_id", "left_anti").select("conv_id", "call_id", "need")


def _levels(calls: DataFrame, needs: DataFrame) -> DataFrame:
    """conv_id, call_id, level: 0 without needs, else one more than the highest needed; -1 in and behind a cycle.

    Short conversations whose calls need earlier ones take one step. For the others, each row is a path from a call to
    one that it hangs on, with its length; a path without end has the call's level. Every round a path to a call with
    one path is lengthened by that, so a chain of n calls takes about log n rounds, and calls with several needs one
    round for each step between them. A path longer than there are waiting calls meets one of them twice; what is left
    when no path grows hangs on a cycle.
    """
    key = ["conv_id", "call_id"]
    places = needs.select("conv_id", F.col("call_id").alias("need"), F.col("place").alias("need_place")).distinct()
    placed = stored(needs.join(places, ["conv_id", "need"], "left"), "placed-needs")
    short, left = _ordered(placed)
    waiting = stored(left.select(*key, "need", F.lit(1).cast("bigint").alias("length")), "needs")
    found = stored(short, "short-levels")
    if not waiting.isEmpty():
        found = found.union(_by_rounds(waiting))
    return calls.select(*key).join(found, key, "left").select(*key, F.coalesce("level", F.lit(0)).alias("level"))


def _by_rounds(waiting: DataFrame) -> DataFrame:
    """conv_id, call_id, level of waiting calls by lengthening paths."""
    key = ["conv_id", "call_id"]
    longest = waiting.select(*key).distinct().count()
    # calls without needs are paths' ends
    ends = waiting.select("conv_id", F.col("call_id").alias("need")).distinct().withColumn("waits", F.lit(True))
    paths = stored(waiting.join(ends, ["conv_id", "need"], "left").groupBy(
        *key, F.when(F.col("waits"), F.col("need")).alias("need")).agg(F.max("length").alias("length")), "paths")
    while True:
        single = paths.groupBy(*key).agg(F.count("*").alias("n"), F.first("need").alias("next"), F.first("length").alias("more")).filter("n = 1")
        single = single.select("conv_id", F.col("call_id").alias("need"), "next", "more", F.lit(True).alias("grown"))
        grown = paths.join(single, ["conv_id", "need"], "left").withColumn("grown", F.coalesce("grown", F.lit(False)))
        length = F.col("length") + F.coalesce("more", F.lit(0))
        endless = length > longest
        grown = grown.select(
            *key, F.when(~endless, F.when(F.col("grown"), F.col("next")).otherwise(F.col("need"))).alias("need"),
            F.when(endless, longest + 1).otherwise(length).alias("length"), "grown")
        paths = stored(grown.groupBy(*key, "need").agg(F.max("length").alias("length"), F.bool_or("grown").alias("grown")), "paths")
        if paths.filter("grown").isEmpty():
            break
        paths = paths.drop("grown")
    known = (F.count("need") == 0) & (F.max("length") <= longest)
    return paths.groupBy(*key).agg(F.when(known, F.max("length")).otherwise(CYCLE).cast("int").alias("level"))


def _described(properties: DataFrame) -> DataFrame:
    """The properties with their optional columns, and the path that each is a part of."""
    for name, kind in (("allowed", "array<string>"), ("low", "double"), ("high", "double")):
        if name not in properties.columns:
            properties = properties.withColumn(name, F.lit(None).cast(kind))
    parent = F.regexp_replace("property", r"(\[\]|\.?[^.\[\]]+)$", "")
    return properties.select("name", "property", "kind", "required", "allowed", "low", "high", parent.alias("parent"))


def _checked(shaped: DataFrame, properties: DataFrame) -> DataFrame:
    """``conv_id, call_id, what`` for everything wrong with the arguments of known tools, a level of nesting at a time."""
    key = ["conv_id", "call_id"]
    rules = _described(properties)
    depth = rules.agg(F.max(F.size(F.split("property", r"\.|(?=\[\])")))).first()[0] or 0
    parents = rules.select("name", F.col("parent").alias("path")).distinct()
    level, found = shaped.select(*key, "name", F.lit("").alias("path"), F.col("v").alias("value")), None
    for _ in range(depth):
        opened = level.join(parents, ["name", "path"], "left_semi").withColumn("kind", _kind(F.col("value")))
        fields = F.when(F.col("kind") == "object", F.try_variant_get("value", "$", "map<string,variant>"))
        items = F.when(F.col("kind") == "array", F.try_variant_get("value", "$", "array<variant>"))
        held = opened.select(*key, "name", "path", fields.alias("fields"), items.alias("items"))
        child = F.concat("path", F.when(F.col("path") == "", "").otherwise("."), F.col("field"))
        inside = held.select(*key, "name", "path", F.explode("fields").alias("field", "value")).select(*key, "name", child.alias("path"), "value").union(
            held.select(*key, "name", F.concat("path", F.lit("[]")).alias("path"), F.explode("items").alias("value")))
        asked = held.filter("fields IS NOT NULL").join(rules.filter("required").withColumnRenamed("parent", "path"), ["name", "path"])
        last = F.regexp_extract("property", r"([^.\[\]]+)$", 1)
        missing = asked.filter(~F.map_contains_key("fields", last)).select(*key, F.concat(F.lit("missing "), "property").alias("what"))
        judged = inside.withColumn("got", _kind(F.col("value"))).join(rules.withColumnRenamed("property", "path"), ["name", "path"], "left")
        fits = (F.col("kind") == F.col("got")) | ((F.col("kind") == "number") & (F.col("got") == "integer"))
        number = F.try_variant_get("value", "$", "double")
        beyond = F.coalesce(number < F.col("low"), F.lit(False)) | F.coalesce(number > F.col("high"), F.lit(False))
        wrong = judged.select(*key, F.when(F.col("kind").isNull(), F.concat(F.lit("unknown "), "path")).when(
            ~F.coalesce(fits, F.lit(False)), F.concat("path", F.lit(" is no "), "kind")).when(
            F.col("allowed").isNotNull() & ~F.coalesce(F.array_contains("allowed", _canonical(F.col("value"))), F.lit(False)), F.concat("path", F.lit(" is none of its values"))).when(
            beyond, F.concat("path", F.lit(" is out of range"))).alias("what"))
        part = missing.union(wrong).dropna()
        found = part if found is None else found.union(part)
        level = judged.select(*key, "name", "path", "value")
    return found if found is not None else shaped.select(*key, F.lit("").alias("what")).limit(0)


def link_calls(calls: DataFrame, results: DataFrame, properties: DataFrame) -> DataFrame:
    """One row for every call and for every result without a call.

    ``calls``: ``conv_id, call_id, turn, name, arguments`` (JSON text); ``results``: ``conv_id, call_id, turn,
    content``; ``properties``: ``name, property, kind, required`` and, if wanted, ``allowed`` (JSON texts), ``low`` and
    ``high``. A property is a path: ``place.city`` is a field of the object ``place``, ``tags[]`` an item of the list
    ``tags``, ``rows[].id`` a field of such an item; names hold no dots or brackets. What a path's fields or items must
    be is checked where at least one of them is described. Returns ``conv_id, call_id, name, call_turn, result_turn,
    level, status, violations, json``.

    ``status`` is ``linked``, ``unanswered`` (no result), ``orphan`` (no call) or ``early`` (the result stands before
    the call). Of calls, or results, with one identifier the earliest counts, ties by text; rows without conversation
    or identifier are left out, they can't be linked. ``violations`` names what is wrong with the arguments, in order:
    ``not an object``, ``repeated key`` (JSON in which an object has a key twice), ``unknown tool``, ``missing p``,
    ``unknown p``, ``p is no kind``, ``p is none of its values`` and ``p is out of range``; an integer is a number
    too. A call needs another one of its conversation whose identifier is a string at any depth of its arguments,
    whatever the tool.

    ``json`` has sorted keys, no white space and one spelling for equal numbers: whole ones below 10^15 without a
    fraction, others as doubles; larger whole numbers that are written as such keep their digits. Arguments that
    aren't JSON or have a repeated key stay text. Further columns are left out.
    """
    key = ["conv_id", "call_id"]
    call = calls.dropna(subset=key).groupBy(*key).agg(F.min(F.struct("turn", "name", "arguments")).alias("c")).select(
        *key, F.col("c.turn").alias("call_turn"), "c.name", "c.arguments")
    call = stored(call, "calls")
    result = results.dropna(subset=key).groupBy(*key).agg(F.min(F.struct("turn", "content")).alias("r")).select(
        *key, F.col("r.turn").alias("result_turn"), "r.content")

    parsed = call.withColumn("v", F.try_parse_json("arguments"))
    is_object = F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False))
    tools = properties.select("name").distinct().withColumn("known", F.lit(True))
    shaped = parsed.withColumn("object", is_object).join(tools, "name", "left")
    twice = F.col("v").isNull() & F.get_json_object("arguments", "$").isNotNull()
    general = shaped.select(*key, F.when(twice, "repeated key").when(~F.col("object"), "not an object").when(F.col("known").isNull(), "unknown tool").alias("what"))
    wrong = _checked(shaped.filter("object AND known").select(*key, "name", "v"), properties)
    violations = general.dropna().union(wrong).groupBy(*key).agg(F.array_sort(F.collect_set("what")).alias("violations"))

    # a string that is the identifier of another call of the conversation is a need; both are compared as JSON writes them
    def written(column: str) -> Column:
        text = F.to_json(F.array(column))
        return F.substring(text, F.lit(3), F.length(text) - 4)

    names = call.select("conv_id", F.col("call_id").alias("need"), written("call_id").alias("named"))
    longest = names.agg(F.max(F.length("named"))).scalar()
    # a string before a colon is a key
    values = F.filter(F.regexp_extract_all(F.to_json("v"), F.lit(STRING + ":?"), F.lit(0)), lambda t: ~t.endswith(":"))
    strings = F.array_distinct(F.transform(values, lambda t: F.substring(t, F.lit(2), F.length(t) - 2)))
    named = parsed.select(*key, "call_turn", F.explode(strings).alias("named")).filter(F.length("named") <= longest)
    needs = named.join(names, ["conv_id", "named"]).filter("need <> call_id")
    # the order of calls: by turn, then by identifier
    needs = needs.select(*key, F.struct(F.coalesce("call_turn", F.lit(-1)).alias("turn"), "call_id").alias("place"), "need").distinct()
    levels = _levels(call, needs)

    joined = call.join(result, key, "full").join(levels, key, "left").join(violations, key, "left")
    answered = F.when(F.col("call_turn").isNull() & F.col("name").isNull() & F.col("arguments").isNull(), "orphan").when(
        F.col("result_turn").isNull() & F.col("content").isNull(), "unanswered").when(F.col("result_turn") < F.col("call_turn"), "early").otherwise("linked")
    given = F.coalesce(_canonical(F.try_parse_json("arguments")), F.to_json(F.struct(F.col("arguments").alias("text"))))
    part = [F.concat(F.lit('"arguments":'), given), _field("content"), _field("id", "call_id"), _field("name")]
    return joined.select(
        *key, "name", "call_turn", "result_turn", "level", answered.alias("status"),
        F.coalesce("violations", F.array().cast("array<string>")).alias("violations"),
        F.concat(F.lit("{"), F.concat_ws(",", *part), F.lit("}")).alias("json"))


def messages(turns: DataFrame) -> DataFrame:
    """Turns that are neither calls nor results, in the columns of ``link_calls`` with status ``message``.

    ``turns``: ``conv_id, call_id, turn, role, content``; every row is kept, nulls are left out of its JSON.
    """
    parts = F.concat_ws(",", _field("content"), _field("id", "call_id"), _field("role"))
    none = F.lit(None)
    return turns.select(
        "conv_id", "call_id", none.cast("string").alias("name"), F.col("turn").alias("call_turn"), none.cast("bigint").alias("result_turn"),
        F.lit(0).alias("level"), F.lit("message").alias("status"), F.array().cast("array<string>").alias("violations"),
        F.concat(F.lit("{"), parts, F.lit("}")).alias("json"))


def _field(name: str, column: str | None = None):
    """``"name":text``, or null without a value."""
    value = F.to_json(F.struct(F.col(column or name).cast("string").alias(name)))
    return F.when(F.col(column or name).isNotNull(), F.substring(value, F.lit(2), F.length(value) - 2))
