"""Operator 8: the order of calls against a plain restatement; folds and rounds agree."""

import json
import random

import pytest

pytest.importorskip("public_tokenizers")
from scriptorium.llm import toolchat  # noqa: E402
from scriptorium.llm.common import Scratch  # noqa: E402

CALLS = "conv_id int, id string, turn long, k long, after array<string>"


def _restated(calls):
    """(conv, turn) -> (moment, wait, cyclic), by walking each call's needs."""
    out = {}
    for conv in {c[0] for c in calls}:
        own = {c[1]: c for c in calls if c[0] == conv}
        needs = {c[2]: {own[d][2] for d in c[4] if d in own} for c in own.values()}
        reach = {t: set(n) for t, n in needs.items()}
        for _ in needs:
            for t in reach:
                reach[t] |= set().union(*(reach[d] for d in reach[t])) if reach[t] else set()
        ring = {t for t in reach if t in reach[t]}
        cyclic = {t for t in reach if t in ring or reach[t] & ring}
        moment = {t: max({t} | reach[t]) for t in reach}
        wait = {}

        def chain(t):
            if t not in wait:
                wait[t] = 0 if moment[t] == t else 1 + max(chain(d) for d in needs[t] if moment[d] == moment[t])
            return wait[t]

        for t in reach:
            out[conv, t] = (t, 0, True) if t in cyclic else (moment[t], chain(t), False)
    return out


def _graphs():
    rng = random.Random(3)
    calls = [(0, f"c{t}", t, 0, [f"c{t + 1}"]) for t in range(40)]  # a chain in reverse
    calls += [(1, f"c{t}", t, 0, [f"c{t - 1}"]) for t in range(40)]  # in order: nothing waits
    calls += [(2, "a", 0, 0, ["a"]), (2, "b", 1, 0, ["a"]), (2, "c", 2, 0, []), (2, "d", 3, 0, ["c", "gone"])]
    for conv in range(3, 30):
        n = rng.randint(2, 14)
        for t in range(n):
            calls.append((conv, f"c{t}", t, 0, [f"c{d}" for d in rng.sample(range(n), rng.randint(0, 2)) if d > t - 3]))
    return calls


@pytest.mark.parametrize("fold_calls", [1000, 12, 0])
def test_places(spark, fold_calls):
    calls = _graphs()
    want = _restated(calls)
    found = toolchat.places(spark.createDataFrame(calls, CALLS), Scratch(spark, "places"), fold_calls).collect()
    got = {(r["conv_id"], r["turn"]): (r["at_turn"], r["wait"], r["cyclic"]) for r in found}
    late = {c for c, t in want if want[c, t][0] > t or want[c, t][2]}
    assert 1 not in late and {c for c, _ in got} == late
    assert got == {k: v for k, v in want.items() if k[0] in late}
    assert all(want[k][:2] == (k[1], 0) for k in want if k[0] not in late)


def test_in_order_needs_no_fold(spark):
    calls = [(1, f"c{t}", t, 0, [f"c{t - 1}"]) for t in range(1200)]
    assert toolchat.places(spark.createDataFrame(calls, CALLS), Scratch(spark, "places")) is None


def test_reversed_chain_is_written_in_order(spark):
    call = lambda t, after: json.dumps({"tool_calls": [{"id": f"c{t}", "name": "reply", "arguments": json.dumps({"turn": t, "prompt": "p"}), "after": after}]})
    rows = [(1, 2 * t, "assistant", call(t, [f"c{t + 1}"] if t < 59 else [])) for t in range(60)]
    rows += [(1, 1, "user", "hello"), (1, 119, "user", "bye"), (None, 0, "assistant", call(7, [])), (None, 0, "tool", '{"tool_call_id":"c7","content":"x"}')]
    chat = toolchat.tool_chat(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"))
    whole = {r["conv_id"]: json.loads(r["chat_json"]) for r in toolchat.documents(chat).collect()}
    assert [m.get("call_id") for m in whole[1]] == [None, *[f"c{t}" for t in range(59, -1, -1)], None]
    assert [m["call_id"] for m in whole[None]] == ["c7"]  # belongs to no conversation: not linked
    assert {r["state"] for r in chat.where("conv_id is null").collect()} == {"unanswered", "orphan"}


def test_nothing(spark):
    empty = spark.createDataFrame([], "conv_id int, turn int, role string, text string")
    assert toolchat.tool_chat(empty).count() == 0 and toolchat.documents(toolchat.tool_chat(empty)).count() == 0
