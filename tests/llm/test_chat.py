import json

from tabularium.llm import chat, queries

SCHEMAS = {"add": {"required": ["x"], "properties": {"x": {"type": "integer"}, "note": {"type": "string"}}}}


def call(key, x=1, after=(), name="add"):
    return json.dumps({"id": key, "name": name, "arguments": {"x": x}, "after": list(after)})


def answer(key, content="ok"):
    return json.dumps({"call_id": key, "content": content})


ROWS = [
    (1, 0, "assistant", call("b", 2, ["a", "gone"])), (1, 1, "assistant", call("a", "text")), (1, 2, "tool", answer("a", '{"z":1,"a":"é"}')),
    (1, 4, "tool", answer("b", "late")), (1, 3, "tool", answer("b", "early")), (1, 5, "assistant", call("a", 9)),
    (1, 6, "assistant", "plain words"), (1, 7, "assistant", None), (1, 8, "user", call("u")), (1, 9, "assistant", call("n", name="other")),
    (2, 0, "assistant", call("p", 1, ["q"])), (2, 1, "assistant", call("q", 1, ["p"])), (2, 2, "assistant", call("r", 1, ["q"])),
    (2, 3, "assistant", call("s")), (2, 3, "assistant", call("s")),
    (None, None, "assistant", call("a", 5)), (None, 1, "tool", answer("a")),
]


def test_links_order_and_checks(spark):
    messages = spark.createDataFrame([(*r, 0) for r in ROWS], "conv_id long, turn long, role string, text string, rank int")
    rows = {(r.conv_id, r.turn, r.id): r for r in chat.link_calls(messages, SCHEMAS, depth=5).collect()}
    assert len(rows) == 9
    got = {k: (r.status, r.rank, r.problems) for k, r in rows.items()}
    assert got == {
        (1, 1, "a"): ("linked", 1, ["type x"]), (1, 0, "b"): ("linked", 2, []), (1, 9, "n"): ("unanswered", 3, ["unknown tool"]),
        (1, 5, "a"): ("repeated", None, []),
        (2, 0, "p"): ("cyclic", None, []), (2, 1, "q"): ("cyclic", None, []), (2, 2, "r"): ("unanswered", 1, []),
        (2, 3, "s"): ("unanswered", 2, []), (None, None, "a"): ("linked", 1, []),
    }
    assert rows[(1, 1, "a")].line == '{"arguments":{"x":"text"},"id":"a","name":"add","result":{"a":"\\u00e9","z":1}}'
    assert json.loads(rows[(1, 0, "b")].line)["result"] == "early"


def test_chains_longer_than_the_rounds_are_no_cycles(spark):
    n = 70
    rows = [(1, 0, "assistant", call(f"c{k:02}", after=[f"c{k + 1:02}"])) for k in range(n)]  # one turn, backwards
    rows += [(2, k, "assistant", call(f"c{k:02}", after=[f"c{k + 1:02}"])) for k in range(n)]  # forward in time
    rows += [(3, 0, "assistant", call("a", after=["b"])), (3, 0, "assistant", call("b", after=["a"])), (3, 0, "assistant", call("w", after=["a"])), (3, 1, "assistant", call("z", after=["a"]))]
    rows += [(4, None, "assistant", call("y", after=["x"])), (4, None, "assistant", call("x"))]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r.conv_id, r.id): (r.status, r.rank) for r in chat.link_calls(messages, SCHEMAS, depth=3).collect()}
    assert all(got[c, f"c{k:02}"] == ("unanswered", n - k) for c in (1, 2) for k in range(n))
    assert [got[3, k] for k in "abwz"] == [("cyclic", None)] * 3 + [("unanswered", 1)]
    assert got[4, "x"] == ("unanswered", 1) and got[4, "y"] == ("unanswered", 2)


def test_problems():
    assert chat.problems_of('{"x": true, "y": 1}', SCHEMAS["add"]) == ["extra y", "type x"]
    assert chat.problems_of("{}", SCHEMAS["add"]) == ["missing x"]
    assert chat.problems_of(None, SCHEMAS["add"]) == ["not json"] == chat.problems_of("[1]", SCHEMAS["add"])


def test_empty(spark):
    messages = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.link_calls(messages, SCHEMAS).count() == 0


def test_registered_query_against_brute_force(spark, data):
    rows = [r.asDict() for r in spark.read.parquet(f"{data}/conversations.parquet").collect()]
    want = {}
    for r in rows:
        if r["role"] == "user":
            told = [x for x in rows if x["conv_id"] == r["conv_id"] and x["turn"] == r["turn"] + 1 and x["role"] == "assistant"]
            want[r["conv_id"], r["turn"]] = (r["text"], min((x["text"] or "" for x in told), default=None))
    got = queries.QUERIES["op9_chat_tools"](spark, data).where("status <> 'repeated'").collect()
    assert {(r.conv_id, r.turn) for r in got} == set(want)
    by_conversation = {}
    for r in got:
        line = json.loads(r.line)
        text, result = want[r.conv_id, r.turn]
        assert line["arguments"]["question"] == (text or "")
        assert (r.status == "unanswered") == (result is None)
        by_conversation.setdefault(r.conv_id, []).append((r.rank, r.turn))
    for places in by_conversation.values():
        assert [t for _, t in sorted(places)] == sorted(t for _, t in places)
        assert [k for k, _ in sorted(places)] == list(range(1, len(places) + 1))
