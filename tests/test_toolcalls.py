from qaloom.operators import toolcalls

CASES = [
    ('x <tool_call>{"name": "w", "arguments": {"query": "q1"}}</tool_call> y', "ok", "q1"),
    ('<tool_call>{"arguments": {"query": "first"}}</tool_call><tool_call>{"arguments": {"query": "second"}}</tool_call>', "ok", "first"),
    ('<tool_call>\n{"name": "w",\n "arguments": {"query": "Хэн \\"x\\""}}\n</tool_call>', "ok", 'Хэн "x"'),
    ("no call at all", "none", None),
    ('<tool_call>["query"]</tool_call>', "none", None),
    ('<tool_call>{"name": }</tool_call>', "bad_json", None),
    ('<tool_call>{"arguments": {"query": "q"}} trailing}</tool_call>', "bad_json", None),
    ('<tool_call>{ }</tool_call>', "bad_json", None),
    ('<tool_call>{"a": 1}], [{"b": 2}</tool_call>', "bad_json", None),
    ('<tool_call>{"name": "w", "arguments": {}}</tool_call>', "no_query", None),
    ('<tool_call>{"name": "w", "arguments": "query"}</tool_call>', "no_query", None),
    ('<tool_call>{"name": "w"}</tool_call>', "no_query", None),
    ("", "none", None),
]


def test_status_and_query(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, output string")
    rows = toolcalls.tool_call_check(df).orderBy("i").collect()
    assert [(r.status, r.query) for r in rows] == [c[1:] for c in CASES]
    assert rows[0].raw_call == '<tool_call>{"name": "w", "arguments": {"query": "q1"}}</tool_call>'
    assert rows[3].raw_call is None


def test_counts(spark):
    df = spark.createDataFrame([("t", c[0]) for c in CASES], "split string, output string")
    got = {r.status: r.n_rows for r in toolcalls.tool_call_counts(toolcalls.tool_call_check(df), "split").collect()}
    assert got == {"ok": 3, "none": 3, "bad_json": 4, "no_query": 3}
