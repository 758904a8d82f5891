"""Tool-call linking against a plain version."""

from __future__ import annotations

import json
import random
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
from tickweave.llm import queries, tool_calls  # noqa: E402

CALLS = "conv_id long, turn long, call_id string, name string, arguments string, depends_on string, status string, value int"
RESULTS = "conv_id long, turn long, call_id string, content string, name string, depth long"


def json_type(v):
    return {bool: "boolean", int: "integer", float: "number", str: "string", list: "array", dict: "object", type(None): "null"}[type(v)]


def plain(calls, results, schemas):
    tools = {}
    for n, p, t, r in schemas:
        tools.setdefault(n, {})[p] = (t, r)
    by_id, answers = {}, {}
    low = lambda x: tuple((v is not None, v if v is not None else 0) for v in x)
    for c in calls:
        k = (c[0], c[2])
        if k not in by_id or low((c[1], c[3], c[4], c[5])) < low((by_id[k][1], by_id[k][3], by_id[k][4], by_id[k][5])):
            by_id[k] = c
    for r in results:
        answers.setdefault((r[0], r[2]), []).append(r)

    def depth(k):
        seen = []
        while True:
            if k in seen:
                return None
            seen.append(k)
            up = (k[0], by_id[k][5])
            if up not in by_id or by_id[k][5] is None:
                return len(seen) - 1
            k = up

    out, order = [], {}
    whole = [k for k in by_id if None not in k]
    deep = {k: depth(k) for k in whole}
    for k in sorted(whole, key=lambda k: (k[0], deep[k] is None, deep[k] or 0, by_id[k][1], k[1])):
        order[k] = order.get(k[0], 0) + 1
        order[k[0]] = order[k]
    for k, c in by_id.items():
        try:
            def pairs(x):
                assert len(dict(x)) == len(x)
                return dict(x)
            args = json.loads(c[4], object_pairs_hook=pairs)
            args = args if isinstance(args, dict) else None
        except (TypeError, ValueError, AssertionError):
            args = None
        found = answers.get(k, []) if None not in k else []
        errors, tool = [], tools.get(c[3])
        if tool is not None and args is not None:
            errors += [f"missing:{p}" for p, (_, r) in tool.items() if r and p not in args]
            errors += [f"type:{p}" for p, v in args.items() if p in tool and json_type(v) != tool[p][0] and not (tool[p][0] == "number" and json_type(v) == "integer")]
            errors += [f"unknown:{p}" for p in args if p not in tool]
        status = ("no_id" if None in k else "cycle" if deep[k] is None else "unknown_tool" if tool is None else "bad_json" if args is None
                  else "invalid" if errors else "no_result" if not found else "ok")
        content = min(found, key=lambda r: low((r[1], r[3])))[3] if found else None
        out.append((k[0], order.get(k) if None not in k else None, k[1], c[3], deep.get(k), status, ",".join(sorted(errors)), len(found),
                    {"arguments": args, "id": k[1], "name": c[3], "result": content, "status": status}))
    for k, found in answers.items():
        if k not in by_id or None in k:
            content = min(found, key=lambda r: low((r[1], r[3])))[3]
            out.append((k[0], None, k[1], None, None, "orphan_result", "", len(found),
                        {"arguments": None, "id": k[1], "name": None, "result": content, "status": "orphan_result"}))
    return sorted(out, key=str)


def read(df):
    rows = df.collect()
    for r in rows:
        again = json.dumps(json.loads(r["message"]), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        assert "." in r["message"] or again == r["message"]
    return sorted(((*r[:8], json.loads(r["message"])) for r in rows), key=str)


def test_linking(spark):
    rng = random.Random(1)
    args = ['{"query": "a\\n\\"é", "limit": 3}', '{"limit": 3}', '{"query": 1}', '{"query": "x", "z": {"b": 1, "a": [1, null, true]}}', "nope", None, "[1]",
            '{"query": "x", "query": "y"}', "{}", '{"ratio": 2, "text": ""}', '{"ratio": 0.5, "text": "t"}']
    calls, results = [], []
    for c in range(12):
        n = rng.choice((1, 3, 9, 40))
        for i in range(n):
            calls.append((c, i, f"c{i}", rng.choice(("search", "summarize", "other", None)), rng.choice(args),
                          rng.choice((None, f"c{rng.randrange(n)}", f"c{i - 1}", f"c{i - 1}", "none")), "s", 1))
        for i in range(n + 2):
            results += [(c, 100 + j, f"c{i}", rng.choice(("r", "", None, "ü")), "n", 2) for j in range(rng.choice((0, 1, 1, 3)))]
    calls += calls[:5] + [(1, 3, None, "search", args[0], None, "s", 1), (None, 3, "c1", "search", args[0], None, "s", 1), (50, 0, "me", "search", args[0], "me", "s", 1)]
    calls += [(60, i, f"c{i}", "search", args[0], f"c{i - 1}", "s", 1) for i in range(70)]
    results += [(None, 1, "c1", "x", "n", 2), (1, 1, None, "x", "n", 2)]
    got = read(tool_calls.link_tool_calls(spark.createDataFrame(calls, CALLS), spark.createDataFrame(results, RESULTS),
                                          spark.createDataFrame(tool_calls.SCHEMAS, "name string, parameter string, type string, required boolean")))
    want = plain(calls, results, tool_calls.SCHEMAS)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g == w
    assert {r[5] for r in got} == {"ok", "no_id", "cycle", "unknown_tool", "bad_json", "invalid", "no_result", "orphan_result"}
    assert max(r[4] or 0 for r in got) == 69


def test_parents_come_first(spark):
    rows = queries.op7_tool_calls(spark, "/root/testdata/sf0.001").collect()
    calls, results, _ = (x.collect() if i < 2 else None for i, x in enumerate(
        tool_calls.calls_of_conversations(spark, spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))))
    assert read(queries.op7_tool_calls(spark, "/root/testdata/sf0.001")) == plain([tuple(c) for c in calls], [tuple(r) for r in results], tool_calls.SCHEMAS)
    assert {r["status"] for r in rows} >= {"ok", "invalid", "unknown_tool", "bad_json"}


def test_edges(spark):
    schema = "conv_id long, turn long, role string, text string, name string"
    turns = spark.createDataFrame([(1, 0, "user", "q", "x"), (1, 1, "assistant", None, "x"), (1, 2, "user", None, "x"), (1, 1, "assistant", None, "x"),
                                   (None, 1, "assistant", "t", "x"), (2, None, "assistant", "t", "x"), (3, 1, None, "t", "x"), (4, 1, "assistant", "é" * 50_000, "x")], schema)
    got = read(tool_calls.link_tool_calls(*tool_calls.calls_of_conversations(spark, turns)))
    assert len(got) == 4
    none = turns.where("false")
    assert tool_calls.link_tool_calls(*tool_calls.calls_of_conversations(spark, none)).count() == 0


def test_plan_is_native(spark):
    df = queries.op7_tool_calls(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "ShuffledHashJoin" in plan
