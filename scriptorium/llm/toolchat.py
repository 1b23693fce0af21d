"""Chat formatting with tool calls: linking, ordering, validation, canonical JSON.

Messages are rows (conv_id, turn, role, text).  An assistant's text that is a JSON object
with ``tool_calls`` holds calls (id, name, arguments as a JSON string, ``after``: ids of
calls that must come first); a tool's text that is a JSON object with ``tool_call_id``
and ``content`` holds a result; all other messages are plain.  Calls and results of a
conversation are hash-joined by their identifier, arguments are held against the tools'
schemas, and every message is written as canonical JSON: keys in order, no spaces.
DataFrame functions only.

Topological order: a call stands at its own place (turn, number in the message) unless a
call it needs, directly or not, stands later; then it waits for the latest of them (its
moment), and calls of one moment come in the order of their chains (``wait``).  So a
conversation without such a late call is in order as it is, whatever its length; only
those with one are ordered by a fold over their calls, in an array of at most
``fold_calls`` calls, and longer ones in rounds over tables with the same result.

``tool_chat`` gives a row for each message, with the columns that order it, so that no
conversation has to fit in one task; ``documents`` joins them to one text a conversation.

Defined results
---------------
* a call without a result is ``unanswered``; results without a call, and all but the first
  by turn of one call, aren't written: one row an identifier counts them (``orphan``,
  ``repeated``; ``n`` results, no message).  Of several calls with one id the first by
  place counts, the others are written and never linked.
* a call without an id is written, never linked; ids in ``after`` that no call has don't
  hold a call back; calls on a cycle and what needs them are ``cyclic`` and come last.
* null texts are empty plain messages, null roles are ``user``, null turns are turn -1;
  a row without a conv_id belongs to no conversation: it is written, never linked;
  repeated rows are repeated messages.
* an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: tool -> argument -> (JSON type, required)
SCHEMAS = {
    "configure": {"instruction": ("string", True), "turn": ("integer", True)},
    "reply": {"prompt": ("string", True), "turn": ("integer", True)},
}
_KINDS = {"string": "^STRING$", "integer": "^(BIGINT|DECIMAL\\(\\d+,0\\))$", "number": "^(BIGINT|DOUBLE|DECIMAL.*)$", "boolean": "^BOOLEAN$", "object": "^OBJECT.*$", "array": "^ARRAY.*$"}
_CALLS = "struct<tool_calls: array<struct<id: string, name: string, arguments: string, after: array<string>>>>"
_RESULT = "struct<tool_call_id: string, content: string>"


def argument_issue(name: Column, arguments: Column, schemas: dict) -> Column:
    """Null for arguments that fit the tool's schema, else what is wrong with them."""
    value = F.try_parse_json(arguments)
    out = F.when(~name.isin(list(schemas)) | name.isNull(), F.lit("unknown tool"))
    out = out.when(value.isNull() | ~F.schema_of_variant(value).startswith("OBJECT"), F.lit("not an object"))
    for tool, parameters in schemas.items():
        extra = F.size(F.array_except(F.json_object_keys(arguments), F.array(*map(F.lit, parameters)))) > 0
        out = out.when((name == tool) & extra, F.lit("unknown argument"))
        for parameter, (kind, required) in parameters.items():
            found = F.schema_of_variant(F.try_variant_get(value, f"$.{parameter}", "variant"))
            if required:
                out = out.when((name == tool) & found.isNull(), F.lit(f"missing {parameter}"))
            out = out.when((name == tool) & ~found.rlike(_KINDS[kind]), F.lit(f"{parameter} isn't {kind}"))
    return out


def canonical(json: Column) -> Column:
    """The same JSON with keys in order and no spaces; null if it isn't JSON."""
    return F.to_json(F.try_parse_json(json))


def _named(calls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(calls that are the first of their id, all others)."""
    can = F.col("conv_id").isNotNull() & F.col("id").isNotNull()
    named = calls.where(can)
    first = named.groupBy("conv_id", "id").agg(F.min(F.struct("turn", "k")).alias("first")).select("conv_id", "id", F.col("first.turn").alias("turn"), F.col("first.k").alias("k"))
    keys = ["conv_id", "id", "turn", "k"]  # the place as well, so that an id that many calls have is no hot key
    return named.join(first, keys, "left_semi"), named.join(first, keys, "left_anti").select(*calls.columns).unionByName(calls.where(~can))


def fold_places(groups: DataFrame) -> DataFrame:
    """(conv_id, turn, k, at_turn, at_call, wait, cyclic) of conversations (conv_id, calls:
    array of (turn, k, deps: array of (turn, k))).

    The state holds, for each call in order of place, its moment's index and its wait, or
    null while a call it needs has none; a round fills in all that can be.
    """
    calls = F.array_sort("calls")
    place = F.transform(calls, lambda c: F.struct(c["turn"].alias("turn"), c["k"].alias("k")))
    needs = F.transform(calls, lambda c: F.transform(c["deps"], lambda d: F.array_position(F.col("place"), d).cast("int") - 1))
    df = groups.withColumn("place", place).withColumn("needs", needs)
    entry = lambda m, w: F.struct(m.cast("int").alias("m"), w.cast("int").alias("w"))

    def step(state: Column, _: Column) -> Column:
        def one(deps: Column, i: Column) -> Column:
            moment = F.greatest(i, F.coalesce(F.array_max(F.transform(deps, lambda j: F.get(state, j)["m"])), i))
            chain = F.array_max(F.transform(deps, lambda j: F.when(F.get(state, j)["m"] == moment, F.get(state, j)["w"])))
            found = entry(moment, F.when(moment == i, F.lit(0)).otherwise(chain + 1))
            known = F.forall(deps, lambda j: F.get(state, j).isNotNull())
            return F.when(F.get(state, i).isNotNull(), F.get(state, i)).when(known, found)

        return F.transform("needs", one)

    start = F.transform("needs", lambda deps, i: F.when(F.size(deps) == 0, entry(i, F.lit(0))))
    df = df.withColumn("state", F.aggregate(F.sequence(F.lit(1), F.size("needs")), start, step))
    df = df.select("conv_id", "place", F.posexplode("state").alias("i", "at"))
    own, moment = F.get("place", F.col("i")), F.get("place", F.coalesce("at.m", "i"))
    return df.select("conv_id", own["turn"].alias("turn"), own["k"].alias("k"), moment["turn"].alias("at_turn"), moment["k"].alias("at_call"), F.coalesce("at.w", F.lit(0)).cast("long").alias("wait"), F.col("at").isNull().alias("cyclic"))


def round_places(calls: DataFrame, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """The same for calls (conv_id, turn, k) and edges (conv_id, turn, k, d_turn, d_k), as
    many rounds as the longest chain has calls; the driver sees whether a round found any."""
    own = ["conv_id", "turn", "k"]
    at = F.struct(F.col("turn").alias("turn"), F.col("k").alias("k"))
    edges = scratch.write(edges, "edges")
    done = scratch.write(calls.join(edges, own, "left_anti").select(*own, at.alias("moment"), F.lit(0).cast("long").alias("wait")), "placed")
    ready, open_ = done, edges
    while not ready.isEmpty():
        open_ = scratch.write(open_.join(ready.select("conv_id", F.col("turn").alias("d_turn"), F.col("k").alias("d_k")), ["conv_id", "d_turn", "d_k"], "left_anti").select(*own, "d_turn", "d_k"), "open")
        free = calls.join(open_, own, "left_anti").join(done, own, "left_anti")
        of = done.select("conv_id", F.col("turn").alias("d_turn"), F.col("k").alias("d_k"), "moment", "wait")
        last = free.join(edges, own).join(of, ["conv_id", "d_turn", "d_k"]).groupBy(*own).agg(F.max(F.struct("moment", "wait")).alias("last"))
        late = F.col("last.moment") > at
        found = last.select(*own, F.when(late, F.col("last.moment")).otherwise(at).alias("moment"), F.when(late, F.col("last.wait") + 1).otherwise(F.lit(0)).cast("long").alias("wait"))
        ready = scratch.write(found, "placed")
        done = done.unionByName(ready)
    cyclic = calls.join(done, own, "left_anti").select(*own, at.alias("moment"), F.lit(0).cast("long").alias("wait"), F.lit(True).alias("cyclic"))
    out = done.withColumn("cyclic", F.lit(False)).unionByName(cyclic)
    return out.select(*own, F.col("moment.turn").alias("at_turn"), F.col("moment.k").alias("at_call"), "wait", "cyclic")


def places(calls: DataFrame, scratch: Scratch, fold_calls: int = 256) -> DataFrame | None:
    """Places of the calls (conv_id, id, turn, k, after) of conversations in which a call
    needs a later one; None if there is no such conversation."""
    known = calls.select("conv_id", F.col("id").alias("dep"), F.col("turn").alias("d_turn"), F.col("k").alias("d_k")).distinct()
    needs = calls.select("conv_id", "turn", "k", F.explode(F.array_distinct(F.coalesce("after", F.array()))).alias("dep"))
    edges = scratch.write(needs.join(known, ["conv_id", "dep"]).select("conv_id", "turn", "k", "d_turn", "d_k").distinct(), "edges")
    late = scratch.write(edges.where(F.struct("d_turn", "d_k") >= F.struct(F.col("turn").alias("d_turn"), F.col("k").alias("d_k"))).select("conv_id").distinct(), "late")
    if late.isEmpty():
        return None
    held = calls.select("conv_id", "turn", "k").distinct().join(late, "conv_id", "left_semi")
    sizes = scratch.write(held.groupBy("conv_id").agg(F.count(F.lit(1)).alias("calls")), "sizes")
    small, long = (sizes.where(cond).select("conv_id") for cond in (F.col("calls") <= fold_calls, F.col("calls") > fold_calls))
    deps = edges.join(small, "conv_id", "left_semi").groupBy("conv_id", "turn", "k").agg(F.collect_list(F.struct(F.col("d_turn").alias("turn"), F.col("d_k").alias("k"))).alias("deps"))
    none = F.array().cast(deps.schema["deps"].dataType)
    nodes = held.join(small, "conv_id", "left_semi").join(deps, ["conv_id", "turn", "k"], "left").select("conv_id", F.struct("turn", "k", F.coalesce("deps", none).alias("deps")).alias("c"))
    # A fold costs much for its few bytes: tasks aren't merged by size here.
    tasks = int(calls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = fold_places(nodes.repartition(tasks, "conv_id").groupBy("conv_id").agg(F.collect_list("c").alias("calls")))
    if not long.isEmpty():
        out = out.unionByName(round_places(held.join(long, "conv_id", "left_semi"), edges.join(long, "conv_id", "left_semi"), scratch))
    return out


#: The order of a conversation's messages.
ORDER = ("cyclic", "at_turn", "at_call", "wait", "turn", "call_no", "kind")


def tool_chat(messages: DataFrame, schemas: dict = SCHEMAS, fold_calls: int = 256, scratch: Scratch | None = None) -> DataFrame:
    """One row per message: conv_id, turn, call_no (-1 for plain messages), kind (0 a
    message or call, 1 a result, 2 results not written), state, issue (what is wrong with a
    call's arguments), cyclic, at_turn, at_call, wait, n, message (canonical JSON)."""
    scratch = scratch or Scratch(messages.sparkSession, "toolchat")
    m = messages.select("conv_id", F.coalesce(F.col("turn").cast("long"), F.lit(-1)).alias("turn"), F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    m = m.withColumn("calls", F.when((F.col("role") == "assistant") & F.col("text").startswith("{"), F.from_json("text", _CALLS)["tool_calls"]))
    m = m.withColumn("result", F.when((F.col("role") == "tool") & F.col("text").startswith("{"), F.from_json("text", _RESULT)))
    m = scratch.write(m.withColumn("result", F.when(F.col("result.tool_call_id").isNotNull(), F.col("result"))), "messages")
    each = m.where(F.size("calls") > 0).select("conv_id", "turn", F.posexplode("calls").alias("k", "call"))
    each = each.select("conv_id", "turn", F.col("k").cast("long").alias("k"), "call.id", "call.name", "call.arguments", "call.after")
    first, others = _named(each)
    first = scratch.write(first, "first")
    results = m.where(F.col("result").isNotNull()).select("conv_id", "turn", F.col("result.tool_call_id").alias("id"), F.col("result.content").alias("content"))
    lost = results.where("conv_id is null").select("conv_id", "id", F.struct("turn", "content").alias("r"), F.lit(1).cast("long").alias("n"))
    answer = results.where("conv_id is not null").groupBy("conv_id", "id").agg(F.min(F.struct("turn", "content")).alias("r"), F.count(F.lit(1)).alias("n"))
    linked = first.withColumn("called", F.lit(True)).join(answer.hint("shuffle_hash"), ["conv_id", "id"], "full")
    found = places(first, scratch, fold_calls)
    if found is not None:
        linked = linked.join(scratch.write(found, "places"), ["conv_id", "turn", "k"], "left")
    else:
        linked = linked.withColumns({"at_turn": F.lit(None).cast("long"), "at_call": F.lit(None).cast("long"), "wait": F.lit(0).cast("long"), "cyclic": F.lit(False)})
    nothing = {"called": F.lit(True), "r": F.lit(None).cast(answer.schema["r"].dataType), "n": F.lit(0).cast("long")}
    empty = {c: F.lit(None).cast(linked.schema[c].dataType) for c in linked.columns}
    rows = linked.unionByName(others.select(*[nothing[c].alias(c) if c in nothing else F.col(c) if c in others.columns else empty[c].alias(c) for c in linked.columns]))
    rows = rows.unionByName(lost.select(*[F.col(c) if c in lost.columns else empty[c].alias(c) for c in linked.columns]))
    issue = argument_issue(F.col("name"), F.col("arguments"), schemas)
    rows = rows.withColumns({"issue": F.when(F.col("called"), issue), "n": F.coalesce("n", F.lit(0))})
    call = F.struct(
        F.coalesce(canonical(F.col("arguments")), F.col("arguments")).alias("arguments"), F.col("id").alias("call_id"), F.col("name").alias("name"), F.lit("assistant").alias("role"), F.col("issue").isNull().alias("valid")
    )
    given = F.struct(F.col("id").alias("call_id"), F.col("r.content").alias("content"), F.lit("tool").alias("role"))
    no = F.lit(None).cast("string")
    part = lambda kind, state, turn, k, n, json, issue=no: F.struct(F.lit(kind).alias("kind"), state.alias("state"), turn.alias("turn"), k.alias("call_no"), n.cast("long").alias("n"), issue.alias("issue"), json.alias("message"))
    turn, k, one, n = F.col("turn"), F.col("k"), F.lit(1), F.col("n")
    called, answered = F.col("called").isNotNull(), F.col("r").isNotNull()
    parts = F.array_compact(
        F.array(
            F.when(called, part(0, F.when(answered, "answered").otherwise("unanswered"), turn, k, one, F.to_json(call), F.col("issue"))),
            F.when(called & answered, part(1, F.lit("result"), turn, k, one, F.to_json(given))),
            F.when(called & (n > 1), part(2, F.lit("repeated"), turn, k, n - 1, no)),
            F.when(~called, part(2, F.lit("orphan"), F.col("r.turn"), F.lit(-1).cast("long"), n, no)),
        )
    )
    place = lambda c, otherwise: F.coalesce(F.col(c), otherwise).alias(c)
    from_calls = rows.select("conv_id", "cyclic", "at_turn", "at_call", "wait", F.explode(parts).alias("p")).select("conv_id", "cyclic", "at_turn", "at_call", "wait", "p.*")
    said = F.to_json(F.struct(F.col("text").alias("content"), F.col("role")))
    plain = m.where(F.col("result").isNull() & (F.coalesce(F.size("calls"), F.lit(-1)) <= 0))
    plain = plain.select("conv_id", F.explode(F.array(part(0, F.lit("plain"), turn, F.lit(-1).cast("long"), one, said))).alias("p")).select("conv_id", "p.*")
    out = from_calls.unionByName(plain, allowMissingColumns=True)
    return out.select(
        "conv_id", "turn", "call_no", "kind", "state", "issue", F.coalesce("cyclic", F.lit(False)).alias("cyclic"),
        place("at_turn", F.col("turn")), place("at_call", F.col("call_no")), F.coalesce("wait", F.lit(0)).cast("long").alias("wait"), "n", "message",
    )


def documents(chat: DataFrame) -> DataFrame:
    """conv_id, n_messages, chat_json: the written messages of ``tool_chat`` as one JSON
    array a conversation, for conversations that fit in a row."""
    entry = F.struct(*ORDER, "message")
    whole = chat.where(F.col("message").isNotNull()).groupBy("conv_id").agg(F.array_sort(F.collect_list(entry)).alias("e"))
    joined = F.concat(F.lit("["), F.array_join(F.transform("e", lambda x: x["message"]), ","), F.lit("]"))
    return whole.select("conv_id", F.size("e").cast("long").alias("n_messages"), joined.alias("chat_json"))


def turns_as_tools(conversations: DataFrame) -> DataFrame:
    """Plain conversations as tool traffic, varied by conversation and turn.

    A system turn calls ``configure``, a user turn ``reply``; an assistant's turn is the
    result of the turn before it.  Some calls name an unknown tool, have no id or have
    arguments that break the schema; ``after`` makes chains, reversed chains, cycles and
    calls that need two others.
    """
    role, turn, text = F.col("role"), F.col("turn").cast("long"), F.coalesce(F.col("text"), F.lit(""))
    c = F.coalesce(F.col("conv_id").cast("long"), F.lit(0))
    ident = lambda t: F.concat(F.lit("c"), c.cast("string"), F.lit("-"), t.cast("string"))
    main = F.when(role == "system", "instruction").otherwise("prompt")
    quoted = F.substring(F.to_json(F.array(text)), F.lit(2), F.length(F.to_json(F.array(text))) - 2)
    member = lambda value: F.concat(F.lit('"'), main, F.lit('": '), value)
    last = F.concat(F.lit(', "turn" : '), turn.cast("string"), F.lit("}"))
    kind = F.pmod(5 * c + 3 * turn, F.lit(11))
    arguments = (
        F.when(kind == 1, F.concat(F.lit("{"), member(turn.cast("string")), last))
        .when(kind == 2, F.concat(F.lit("{"), member(quoted), F.lit("}")))
        .when(kind == 3, F.concat(F.lit('{"extra": true, '), member(quoted), last))
        .when(kind == 4, F.concat(F.lit("["), quoted, F.lit("]")))
        .otherwise(F.concat(F.lit("{"), member(quoted), last))
    )
    shape, start = F.pmod(c, F.lit(7)), F.lit(0)
    after = (
        F.when(shape.isin(1, 2), F.array(ident(turn - 2)))
        .when((shape == 3) & (turn > 0), F.array(ident(start)))
        .when(shape == 4, F.array(ident(turn + 2)))
        .when(shape == 5, F.array(F.when(turn < 4, ident(turn + 2)).otherwise(ident(turn - 4))))
        .when((shape == 6) & (turn > 0), F.array(ident(start), ident(turn + 2)))
        .otherwise(F.array().cast("array<string>"))
    )
    name = F.when(F.pmod(7 * c + turn, F.lit(23)) == 5, "search").when(role == "system", "configure").otherwise("reply")
    call = F.struct(F.when(F.pmod(c + turn, F.lit(29)) != 7, ident(turn)).alias("id"), name.alias("name"), arguments.alias("arguments"), after.alias("after"))
    as_call = F.to_json(F.struct(F.array(call).alias("tool_calls")))
    as_result = F.to_json(F.struct(ident(turn - 1).alias("tool_call_id"), text.alias("content")))
    answer = role == "assistant"
    return conversations.select("conv_id", "turn", F.when(answer, "tool").otherwise("assistant").alias("role"), F.when(answer, as_result).otherwise(as_call).alias("text"))


#: DuckDB's form of ``tool_chat(turns_as_tools(conversations))``, for one row a turn.
SQL = """
with recursive m as (
  select conv_id, turn, role, coalesce(text, '') as text, 'c' || conv_id || '-' as head, (5 * conv_id + 3 * turn) % 11 as kind, conv_id % 7 as shape from conversations
), calls as (
  select *, case when (conv_id + turn) % 29 <> 7 then head || turn end as id,
    case when (7 * conv_id + turn) % 23 = 5 then 'search' when role = 'system' then 'configure' else 'reply' end as name,
    case when role = 'system' then 'instruction' else 'prompt' end as main,
    case when shape in (1, 2) then [turn - 2] when shape = 3 and turn > 0 then [0] when shape = 4 then [turn + 2]
      when shape = 5 and turn < 4 then [turn + 2] when shape = 5 then [turn - 4] when shape = 6 and turn > 0 then [0, turn + 2] else [] end as needs
  from m where role <> 'assistant'
), told as (
  select *, case when kind = 1 then '{"' || main || '":' || turn || ',"turn":' || turn || '}' when kind = 2 then '{"' || main || '":' || to_json(text) || '}'
      when kind = 3 then '{"extra":true,"' || main || '":' || to_json(text) || ',"turn":' || turn || '}' when kind = 4 then '[' || to_json(text) || ']'
      else '{"' || main || '":' || to_json(text) || ',"turn":' || turn || '}' end as arguments,
    case when name = 'search' then 'unknown tool' when kind = 4 then 'not an object' when (name = 'configure') <> (main = 'instruction') or kind = 3 then 'unknown argument'
      when kind = 1 then main || ' isn''t string' when kind = 2 then 'missing turn' end as issue
  from calls
), known as (select conv_id, turn from calls where id is not null),
edges as (
  select e.conv_id, e.turn, k.turn as dep from (select conv_id, turn, unnest(needs) as dep from calls where id is not null) e join known k on k.conv_id = e.conv_id and k.turn = e.dep
), reach as (
  select conv_id, turn, dep from edges union select r.conv_id, r.turn, e.dep from reach r join edges e on e.conv_id = r.conv_id and e.turn = r.dep
), cyclic as (
  select distinct a.conv_id, a.turn from reach a join reach b on b.conv_id = a.conv_id and b.turn = b.dep and (a.dep = b.turn or a.turn = b.turn)
), moments as (
  select k.conv_id, k.turn, greatest(k.turn, coalesce(max(r.dep), k.turn)) as moment from known k left join reach r using (conv_id, turn)
  where not exists (select 1 from cyclic c where c.conv_id = k.conv_id and c.turn = k.turn) group by 1, 2
), chains as (
  select conv_id, turn, moment, 0 as wait from moments where moment = turn
  union select a.conv_id, a.turn, a.moment, c.wait + 1 from chains c join edges e on e.conv_id = c.conv_id and e.dep = c.turn join moments a on a.conv_id = e.conv_id and a.turn = e.turn and a.moment = c.moment
), placed as (select conv_id, turn, moment, max(wait) as wait from chains group by 1, 2, 3),
results as (select conv_id, turn, head || (turn - 1) as id, text from m where role = 'assistant'),
linked as (
  select t.*, r.id is not null as answered, r.text as content, c.turn is not null as cyclic, coalesce(p.moment, t.turn) as at_turn, coalesce(p.wait, 0) as wait
  from told t left join results r on r.conv_id = t.conv_id and r.id = t.id left join cyclic c on c.conv_id = t.conv_id and c.turn = t.turn and t.id is not null
  left join placed p on p.conv_id = t.conv_id and p.turn = t.turn and t.id is not null
)
select conv_id, turn, cast(0 as bigint) as call_no, 0 as kind, case when answered then 'answered' else 'unanswered' end as state, issue, cyclic, at_turn, cast(0 as bigint) as at_call, cast(wait as bigint) as wait, cast(1 as bigint) as n,
  '{"arguments":' || to_json(arguments) || coalesce(',"call_id":' || to_json(id), '') || ',"name":"' || name || '","role":"assistant","valid":' || case when issue is null then 'true' else 'false' end || '}' as message
from linked
union all
select conv_id, turn, 0, 1, 'result', null, cyclic, at_turn, 0, wait, 1, '{"call_id":' || to_json(id) || ',"content":' || to_json(content) || ',"role":"tool"}' from linked where answered
union all
select conv_id, turn, -1, 2, 'orphan', null, false, turn, -1, 0, 1, null from results r where not exists (select 1 from calls c where c.conv_id = r.conv_id and c.id = r.id)
"""
