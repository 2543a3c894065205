"""Tool calls of conversations, linked, ordered, checked and written in one form.

Calls and results meet by identifier in a hash join, the k-th call of an identifier with
its k-th result. Calls that use results of other calls come after them: chains of calls that
wait for one other each shrink by doubling, and rounds are left for calls that wait for
several. Arguments are checked against the tool's schema, objects and items of arrays within
them included; JSON is written with sorted keys. Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillhouse.llm.batches import stored

#: Tools whose schemas are sent to all tasks, at most; more are joined by a shuffle.
BROADCAST_TOOLS = 10_000

# The type names of a schema, and the stored types that satisfy each.
KINDS = {
    "integer": ("BIGINT",),
    "number": ("BIGINT", "DOUBLE", "DECIMAL", "FLOAT"),
    "string": ("STRING",),
    "boolean": ("BOOLEAN",),
    "array": ("ARRAY",),
    "object": ("OBJECT",),
}

KEY = ["conv_id", "call_id"]


def numbered(rows: DataFrame) -> DataFrame:
    """``nth``: the how manieth row of its conversation and identifier, by turn. Rows
    without an identifier are not numbered."""
    order = Window.partitionBy(*KEY).orderBy(*[c for c in rows.columns if c not in KEY])
    named = rows.where("call_id is not null").withColumn("nth", F.row_number().over(order))
    return named.unionByName(
        rows.where("call_id is null").withColumn("nth", F.lit(None).cast("int"))
    )


def canonical(text: str) -> str:
    """SQL of a JSON text with sorted keys and no spaces; null if it is not JSON."""
    return f"to_json(try_parse_json({text}))"


def linked(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Calls (conv_id, call_id, turn, tool, arguments, after) and results (conv_id, call_id,
    turn, content) side by side, with a ``status``: linked, unanswered (a call without a
    result), orphan (a result without a call), early (a result before its call).

    Rows with a null identifier or conversation meet nothing. A repeated identifier is
    linked in the order of turns. Empty tables give the rows of the other one.
    """
    left = numbered(calls).withColumnRenamed("turn", "call_turn")
    right = numbered(results).withColumnRenamed("turn", "result_turn")
    joined = left.join(right, [*KEY, "nth"], "full_outer")
    status = (
        F.when(F.col("result_turn").isNull() & F.col("content").isNull(), "unanswered")
        .when(F.col("call_turn").isNull() & F.col("tool").isNull(), "orphan")
        .when(F.col("result_turn") < F.col("call_turn"), "early")
        .otherwise("linked")
    )
    return joined.withColumn("status", status)


def levels(links: DataFrame) -> DataFrame:
    """``level``: 0 for calls that need no other, else one more than the highest level of
    the calls named in ``after`` (array of identifiers of the same conversation); null for
    calls in a cycle or behind one. Named calls that do not exist are not waited for.

    Calls that need exactly one other are hung below the first call on their way that needs
    none or several, in as many rounds as the length of the longest such way has binary digits.
    Then the calls that need several are placed, all those per round whose needs are placed.
    """
    calls = links.where("status <> 'orphan' and call_id is not null")
    ids = calls.select(*KEY).distinct()
    needs = calls.select(*KEY, F.explode("after").alias("need")).distinct().join(
        ids.select(F.col("conv_id"), F.col("call_id").alias("need")), ["conv_id", "need"]
    )
    needs = stored(needs, "needs")
    counted = needs.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.min("need").alias("top"))
    hung = _hung(stored(counted.where("n = 1").select(*KEY, "top"), "single"))
    free = ids.join(counted, KEY, "left_anti").withColumn("level", F.lit(0))

    # What calls with several needs wait for: tops, and how far below a top the need hangs.
    several = needs.join(counted.where("n > 1").select(*KEY), KEY)
    below = hung.select("conv_id", F.col("call_id").alias("need"), "top", "far")
    waits = several.join(below, ["conv_id", "need"], "left").groupBy(
        *KEY, F.coalesce("top", "need").alias("top")
    ).agg((F.max(F.coalesce("far", F.lit(0))) + 1).alias("far"))
    waits = stored(waits.withColumn("level", F.lit(None).cast("int")), "waits")
    last = free = stored(free, "free")
    placed = [free]
    while not waits.isEmpty():
        tops = last.select("conv_id", F.col("call_id").alias("top"), F.col("level").alias("at"))
        level = F.coalesce("level", F.col("at") + F.col("far")).cast("int")
        waits = stored(
            waits.join(tops, ["conv_id", "top"], "left").withColumn("level", level).drop("at"),
            "waits",
        )
        ready = waits.groupBy(*KEY).agg(
            F.max("level").alias("level"), F.count_if(F.col("level").isNull()).alias("open")
        ).where("open = 0").drop("open")
        last = stored(ready, "ready")
        if last.isEmpty():  # what is left waits for itself
            break
        placed.append(last)
        waits = stored(waits.join(last.select(*KEY), KEY, "left_anti"), "waits")
    tops = placed[0]
    for part in placed[1:]:
        tops = tops.unionByName(part)
    under = hung.join(tops.withColumnRenamed("call_id", "top"), ["conv_id", "top"]).select(
        *KEY, (F.col("level") + F.col("far")).cast("int").alias("level")
    )
    return tops.unionByName(under)


def _hung(single: DataFrame) -> DataFrame:
    """For calls that need only ``top``: the first call on the way up that is not such a call,
    as ``top``, and how ``far`` it is. Calls whose way never ends are left out."""
    most = single.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0
    hung = single.withColumns({"far": F.lit(1).cast("bigint"), "open": F.lit(True)})
    for _ in range(most.bit_length() + 1):
        up = hung.select(
            "conv_id", F.col("call_id").alias("top"), F.col("top").alias("next"),
            F.col("far").alias("more"),
        )
        hung = stored(
            hung.join(up, ["conv_id", "top"], "left").select(
                *KEY, F.coalesce("next", "top").alias("top"),
                (F.col("far") + F.coalesce("more", F.lit(0))).alias("far"),
                F.col("next").isNotNull().alias("open"),
            ),
            "hung",
        )
        if hung.where("open").isEmpty():
            break
    return hung.where("not open").drop("open")


def _described(schemas: DataFrame) -> DataFrame:
    """A row per tool: maps from paths to kind, choices, least and most, the required paths
    with the path above and the last name, and the paths that have others below."""
    for name, kind in (("choices", "array<string>"), ("least", "double"), ("most", "double")):
        if name not in schemas.columns:
            schemas = schemas.withColumn(name, F.lit(None).cast(kind))
    rows = schemas.where("tool is not null and parameter is not null").groupBy(
        "tool", "parameter"
    ).agg(
        F.max("kind").alias("kind"), F.max(F.coalesce("required", F.lit(False))).alias("required"),
        F.max("choices").alias("choices"), F.max("least").alias("least"),
        F.min("most").alias("most"),
    )
    inner = F.instr("parameter", "/") > 0
    above = F.when(inner, F.regexp_extract("parameter", "^([\\s\\S]*)/", 1)).otherwise("")
    entry = F.struct("parameter", F.struct("kind", "choices", "least", "most"))
    need = F.struct(
        above.alias("above"), F.substring_index("parameter", "/", -1).alias("name"),
        F.col("parameter").alias("path"),
    )
    return rows.groupBy("tool").agg(
        F.map_from_entries(F.collect_list(entry)).alias("known"),
        F.collect_list(F.when(F.col("required"), need)).alias("needed"),
        F.collect_set(above).alias("parents"),
    )


def checked(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """``errors`` of the arguments, sorted, each once: ``unknown tool``, ``not an object``, and
    for a path ``missing``, ``unexpected``, ``not <type>``, ``not a choice``, ``too small`` or
    ``too large``.

    ``schemas`` has a row (tool, parameter, kind, required) per parameter, and may have
    ``choices`` (JSON texts, as ``to_json`` writes them) and ``least`` and ``most`` for
    numbers. A parameter is a path: names within objects follow after ``/``, items of an array
    are ``[]``; ``~`` and ``/`` in names are written ``~0`` and ``~1``. Only what a schema
    describes below a path is looked into, and there every name must be described. Of repeated
    rows the greatest kind, choices and least and the smallest most hold, and the path is
    required if any says so; a null kind allows all. An unknown tool is the only error of its
    call; without schemas all tools are unknown. The depth of schemas, not of arguments, bounds
    the work.
    """
    tools = _described(schemas)
    steps = F.size(F.split("parameter", "/"))
    depth = schemas.agg(F.max(steps)).first()[0] or 1
    if tools.limit(BROADCAST_TOOLS + 1).count() <= BROADCAST_TOOLS:
        tools = F.broadcast(tools)
    parsed = calls.join(tools, "tool", "left").withColumn(
        "given", F.expr("if(ltrim(arguments) like '{%' and try_parse_json(arguments) is not null, "
                        "from_json(arguments, 'map<string,variant>'), null)")
    )
    named = "replace(replace(c.key, '~', '~0'), '/', '~1')"
    # Values and the names of objects by level: a level is made of the one above.
    parsed = parsed.withColumn(
        "level1", F.expr(f"transform(map_entries(given), c -> struct({named} as path, c.value as value))")
    ).withColumn("names0", F.expr(
        f"array(struct('' as path, transform(map_entries(given), c -> {named}) as names))"
    ))
    objects = "schema_of_variant(e.value) like 'OBJECT%' and array_contains(parents, e.path)"
    arrays = "schema_of_variant(e.value) like 'ARRAY%' and array_contains(parents, e.path)"
    inside = "map_entries(cast(e.value as map<string,variant>))"
    for level in range(1, depth):
        parsed = parsed.withColumns({
            f"names{level}": F.expr(
                f"transform(filter(level{level}, e -> {objects}), e -> struct(e.path as path, "
                f"transform({inside}, c -> {named}) as names))"
            ),
            f"level{level + 1}": F.expr(
                f"concat(flatten(transform(filter(level{level}, e -> {objects}), e -> transform("
                f"{inside}, c -> struct(concat(e.path, '/', {named}) as path, c.value as value)))), "
                f"flatten(transform(filter(level{level}, e -> {arrays}), e -> transform("
                "cast(e.value as array<variant>), "
                "c -> struct(concat(e.path, '/[]') as path, c as value)))))"
            ),
        })
    every = ", ".join(f"level{level}" for level in range(1, depth + 1))
    names = ", ".join(f"names{level}" for level in range(depth))
    fits = " ".join(
        f"when '{kind}' then " + " or ".join(f"schema_of_variant(e.value) like '{t}%'" for t in types)
        for kind, types in KINDS.items()
    )
    number = "try_variant_get(e.value, '$', 'double')"
    numeric = "schema_of_variant(e.value) rlike '^(BIGINT|DOUBLE|DECIMAL|FLOAT)'"
    told = (
        "case when not map_contains_key(known, e.path) then concat(e.path, ' unexpected') "
        f"when not (case known[e.path].kind {fits} else true end) "
        "then concat(e.path, ' not ', known[e.path].kind) "
        "when not coalesce(array_contains(known[e.path].choices, "
        "to_json(e.value)), true) then concat(e.path, ' not a choice') "
        f"when {numeric} and {number} < known[e.path].least then concat(e.path, ' too small') "
        f"when {numeric} and {number} > known[e.path].most then concat(e.path, ' too large') end"
    )
    missing = (
        f"flatten(transform(concat({names}), o -> transform(filter(needed, n -> n.above = o.path "
        "and not array_contains(o.names, n.name)), n -> concat(n.path, ' missing'))))"
    )
    errors = F.expr(
        "case when known is null then array('unknown tool') "
        "when given is null then array('not an object') else sort_array(array_distinct(concat("
        f"{missing}, filter(transform(concat({every}), e -> {told}), t -> t is not null)))) end"
    )
    return parsed.withColumn("errors", errors).select(*calls.columns, "errors")


def tool_log(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """Every call and every orphan result once: conv_id, call_id, nth, tool, status,
    level (order by it, then by call_turn), call_turn, result_turn, errors, and ``record``,
    the call and its result as one canonical JSON text. Texts that are not JSON are written
    as JSON strings."""
    links = stored(linked(calls, results), "links")
    ordered = links.join(levels(links), KEY, "left")
    full = checked(ordered.where("status <> 'orphan'"), schemas).unionByName(
        ordered.where("status = 'orphan'").withColumn(
            "errors", F.lit(None).cast("array<string>")
        )
    )

    def value(column: str) -> str:
        quoted = f"to_json(named_struct('x', {column}))"
        as_text = f"substring({quoted}, 6, char_length({quoted}) - 6)"
        return f"coalesce({canonical(column)}, if({column} is null, 'null', {as_text}))"

    record = F.expr(
        f"concat('{{\"arguments\":', {value('arguments')}, ',\"call_id\":', {value('call_id_json')}, "
        f"',\"result\":', {value('content')}, ',\"tool\":', {value('tool_json')}, '}}')"
    )
    named = full.withColumns({
        "call_id_json": F.expr("to_json(named_struct('x', call_id))"),
        "tool_json": F.expr("to_json(named_struct('x', tool))"),
    }).withColumns({
        name: F.expr(f"if({name} = '{{}}', null, substring({name}, 6, char_length({name}) - 6))")
        for name in ("call_id_json", "tool_json")
    })
    return named.select(
        *KEY, "nth", "tool", "status", "level", "call_turn", "result_turn", "errors",
        record.alias("record"),
    )
