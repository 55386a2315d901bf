import io
import json
import urllib.error
from urllib import request as urllib_request

import pytest
import xxhash

from dayloom.operators import chat
from dayloom.operators.parts import heavy_keys, ordered_parts, split_by_keys
from dayloom.plans import chat_queries
from plan_text import executed_plan

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
TURNS = [
    (1, 1, "assistant", "hello \"you\"\n"), (1, 0, "user", "Say exactly: Hello"), (1, 2, "user", "é\t/ ok"),
    (2, 0, "user", ""), (3, 0, "user", None),
]


def turns(spark, rows=TURNS):
    return spark.createDataFrame(rows, SCHEMA)


def bodies_of(requests):
    """Fragments joined in part order, per conversation."""
    parts = {}
    for row in sorted(requests.collect(), key=lambda r: (r.conv_id is None, r.conv_id, r.part)):
        parts.setdefault(row.conv_id, []).append(row)
    for rows in parts.values():
        assert [r.closes for r in rows] == [False] * (len(rows) - 1) + [True]
    return {key: "".join(r.request for r in rows) for key, rows in parts.items()}


def test_messages_and_request(spark):
    messages = chat.build_messages(turns(spark))
    requests = chat.build_request(messages, "small", params={
        "temperature": chat.F.lit(0.2), "model": chat.F.lit("other"), "stream": chat.F.lit(True)})
    assert requests.columns == ["conv_id", "part", "closes", "request", "error"]
    first = json.loads(bodies_of(requests)[1])
    assert first == {
        "model": "small", "stream": False, "temperature": 0.2,
        "messages": [{"role": "user", "content": "Say exactly: Hello"},
                     {"role": "assistant", "content": 'hello "you"\n'}, {"role": "user", "content": "é\t/ ok"}],
    }
    assert json.loads(bodies_of(requests)[3])["messages"] == [{"role": "user", "content": None}]


def test_no_messages_gives_the_error_record(spark):
    messages = spark.sql("""SELECT 1L AS conv_id, 0L AS part, true AS closes,
        cast(array() AS array<struct<role:string,content:string>>) AS messages
        UNION ALL SELECT 2L, 0L, true, NULL""")
    rows = chat.build_request(messages, "small").collect()
    assert [r.request for r in rows] == [None, None]
    assert {r.error for r in rows} == {"input.messages is required (OpenAI chat format)."}


def hot_rows():
    """One conversation holds most rows, with many copies of one row, next to small ones."""
    rows = [(7, n, "user" if n % 2 else "assistant", "word " * (n % 9)) for n in range(300)]
    rows += [(7, 50, "user", "the same again")] * 400
    rows += [(None, n, "user", "no key " * n) for n in range(40)]
    rows += [(n, t, "user", f"{n}-{t}") for n in range(100, 130) for t in range(3)]
    return rows


def in_order(row):
    """Turn, role, then the signed hash of the text that settles the order within a turn."""
    tie = xxhash.xxh64_intdigest(row[3], seed=42)
    return row[1], row[2], tie - 2**64 if tie >= 2**63 else tie


def size(row):
    return len((row[2] or "").encode()) + len((row[3] or "").encode()) + chat.FRAMING_BYTES


@pytest.mark.parametrize("limit", [40, 333, 5000])
def test_long_conversations_come_in_parts_and_stay_whole(spark, limit):
    rows = hot_rows()
    messages = chat.build_messages(turns(spark, rows).repartition(5), max_bytes=limit)
    got = {}
    for row in messages.collect():
        got.setdefault(row.conv_id, {})[row.part] = (row.closes, [tuple(m) for m in row.messages])
    expected = {}
    for key in {r[0] for r in rows}:
        ordered = sorted((r for r in rows if r[0] == key), key=in_order)
        total, parts, before = sum(map(size, ordered)), {}, 0
        for row in ordered:
            part = before // limit if total > limit else 0
            parts.setdefault(part, (total <= limit, []))[1].append(row[2:])
            before += size(row)
        if total > limit:
            parts[total // limit + 1] = (True, [])
        expected[key] = parts
    assert got == expected
    whole = bodies_of(chat.build_request(chat.build_messages(turns(spark, rows)), "small"))
    assert bodies_of(chat.build_request(messages, "small")) == whole


def test_usual_case_is_one_shuffle(spark):
    plan = executed_plan(chat.build_messages(turns(spark)))
    assert plan.count("Exchange") == 1


@pytest.mark.parametrize("few", [True, False])
def test_split_by_keys(spark, few):
    df = turns(spark, hot_rows())
    heavy = heavy_keys(df, "conv_id", chat.F.lit(1), 30)
    others, these = split_by_keys(df, heavy, "conv_id", few)
    assert {r.conv_id for r in these.select("conv_id").distinct().collect()} == {7, None}
    assert (these.count(), others.count()) == (740, 90)


@pytest.mark.parametrize("few", [True, False])
def test_parts_of_equal_rows_split_over_borders(spark, few):
    df = spark.createDataFrame([("k", 1)] * 1000 + [("k", 0)], "k string, v int")
    parts = ordered_parts(df, "k", ["v"], chat.F.lit(3).cast("bigint"), 10, few)
    rows = parts.collect()
    assert sum(r.copies for r in rows) == 1001
    assert max(r.copies for r in rows) <= 4
    assert sorted({r.part for r in rows}) == list(range(301))


def test_pinned_bodies(spark):
    given = [
        '{"messages":[{"role":"user","content":"hi"}],"model":"x","stream":true,"temperature":0.2,"deep":{"a":[1,null]}}',
        '{"messages":[]}', "{}", None, "null", '{"messages":null,"model":"y"}', "[1]", "no json",
    ]
    df = spark.createDataFrame(list(enumerate(given)), "conv_id int, input string")
    rows = sorted(chat.pin_request(df, "small").collect())
    assert json.loads(rows[0].request) == {
        "messages": [{"role": "user", "content": "hi"}], "model": "small", "stream": False, "temperature": 0.2,
        "deep": {"a": [1, None]}}
    assert [r.error for r in rows] == [None] + [chat.MISSING_MESSAGES] * 5 + [chat.NOT_AN_OBJECT] * 2
    assert all(r.request is None for r in rows[1:])


def echo_connect():
    """A model that answers with the last message; nested, so that workers need not import this file."""
    def connect():
        def complete(bodies):
            return [json.dumps({"choices": [{"finish_reason": "stop", "index": 0, "message": {
                "role": "assistant", "content": json.loads(b)["messages"][-1]["content"]}}],
                "usage": {"total_tokens": len(b)}}) for b in bodies]
        return complete
    return connect


def test_score_and_parse(spark):
    requests = chat.build_request(chat.build_messages(turns(spark)), "small")
    empty = spark.sql("SELECT 9L AS conv_id, 0L AS part, true AS closes, cast(NULL AS string) AS request, 'nothing' AS error")
    scored = chat.score(requests.unionByName(empty), echo_connect(), concurrency=2)
    rows = {r.conv_id: r for r in chat.parse_response(scored).collect()}
    assert (rows[1].answer, rows[1].finish_reason) == ("é\t/ ok", "stop")
    assert rows[1].total_tokens == len(bodies_of(requests)[1])
    assert (rows[9].error, rows[9].response, rows[9].answer) == ("nothing", None, None)


def joining_connect():
    """A model that answers with the hash of the body, whole or in fragments."""
    def connect():
        from hashlib import sha256

        return lambda bodies: [sha256("".join(body).encode()).hexdigest() for body in bodies]
    return connect


@pytest.mark.parametrize("concurrency", [None, 2])
def test_a_body_in_parts_gets_the_response_of_the_whole(spark, concurrency):
    cut = chat.build_request(chat.build_messages(turns(spark, hot_rows()), max_bytes=333), "small")
    whole = chat.build_request(chat.build_messages(turns(spark, hot_rows())), "small")
    assert cut.count() > whole.count() + 10
    rows = [chat.score(r, joining_connect(), concurrency=concurrency).collect() for r in (cut, whole)]
    assert [sorted(((r.conv_id, r.response, r.error) for r in side), key=repr) for side in rows][0] == \
        sorted(((r.conv_id, r.response, r.error) for r in rows[1]), key=repr)


def test_a_body_in_parts_must_be_read_to_its_end(spark):
    def lazy():
        return lambda bodies: ["x" if isinstance(b, str) else next(b) for b in bodies]

    cut = chat.build_request(chat.build_messages(turns(spark, hot_rows()), max_bytes=333), "small")
    with pytest.raises(Exception, match="not read to its end"):
        chat.score(cut, lazy).collect()


def test_fields_of_each_caller(spark):
    messages = chat.build_messages(turns(spark))
    own = spark.createDataFrame([(1, 0.9, "x", None), (2, None, None, "me")], "conv_id long, temperature double, model string, user string")
    bodies = bodies_of(chat.build_request(messages, "small", params={"temperature": chat.F.lit(0.1), "n": chat.F.lit(1)}, fields=own))
    first = json.loads(bodies[1])
    assert (first["temperature"], first["model"], first["n"], "user" in first) == (0.9, "small", 1, False)


def test_bodies_beyond_the_decoder(spark):
    """Repeated names and numbers that the JVM's decoder does not take."""
    given = ['{"messages":[],"model":"a","messages":["hi"],"model":"b"}', '{"messages":["hi"],"n":' + "9" * 45 + "}",
             '{"messages":[],"n":' + "9" * 45 + "}", "[" + "9" * 45 + "]"]
    rows = sorted(chat.pin_request(spark.createDataFrame(list(enumerate(given)), "conv_id int, input string"), "small").collect())
    assert [r.error for r in rows] == [None] * 2 + [chat.MISSING_MESSAGES, chat.NOT_AN_OBJECT]
    assert json.loads(rows[0].request) == {"messages": ["hi"], "model": "small", "stream": False}
    assert json.loads(rows[1].request)["n"] == int("9" * 45)


@pytest.mark.parametrize("messages,size", [(1, 40_000_000), (130, 1_000_000)])
def test_large_bodies(spark, messages, size):
    """Sizes that the JVM's decoder does not take."""
    body = spark.sql(f"""SELECT 1 AS conv_id, concat('{{"messages":[', array_join(
        transform(sequence(1, {messages}), i -> concat('{{"content":"', repeat('y', {size}), '"}}')), ','), ']}}') AS input""")
    row = chat.pin_request(body, "small").select(chat.F.length("request"), chat.F.right("request", chat.F.lit(40)), "error").first()
    assert row[0] == messages * (size + 14) + messages - 1 + len('{"messages":[],"model":"small","stream":false}')
    assert row[1].endswith('"}],"model":"small","stream":false}') and row[2] is None


def test_long_answers_are_read(spark):
    answer = spark.sql("""SELECT concat('{"choices":[{"message":{"content":"', repeat('z', 21000000), '"}}]}') AS response""")
    assert chat.parse_response(answer).select(chat.F.length("answer")).first()[0] == 21_000_000


def test_score_fails_when_the_model_fails(spark):
    def broken():
        def complete(bodies):
            raise RuntimeError("status 500")
        return complete

    with pytest.raises(Exception, match="status 500"):
        chat.score(chat.build_request(chat.build_messages(turns(spark)), "small"), broken).collect()


def test_http_post(monkeypatch):
    sent = []

    def urlopen(call, timeout):
        sent.append((call.full_url, call.get_method(), call.data, call.headers, timeout))
        if b"bad" in call.data:
            raise urllib.error.HTTPError(call.full_url, 500, "no", {}, io.BytesIO())
        return io.BytesIO('{"é": 1}'.encode())

    monkeypatch.setattr(urllib_request, "urlopen", urlopen)
    complete = chat.http_connect("http://model/v1/chat/completions")()
    assert complete(['{"a": "é"}']) == ['{"é": 1}']
    assert sent[0] == ("http://model/v1/chat/completions", "POST", '{"a": "é"}'.encode(),
                       {"Content-type": "application/json"}, 300)
    with pytest.raises(urllib.error.HTTPError):
        complete(["bad"])


def test_both_response_shapes(spark):
    texts = [
        '{"choices":[{"finish_reason":"stop","index":0,"message":{"content":"Hello","role":"assistant"}}],'
        '"model":"m","object":"chat.completion","usage":{"total_tokens":20}}',
        '{"output":[{"choices":[{"text":"legacy","finish_reason":"length"}],"usage":{"total_tokens":7}}]}',
        '{"choices":[]}', "not json", None, '{"choices":[{"text":"plain"}]}',
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, response string")
    rows = sorted(tuple(r)[0:1] + tuple(r)[2:] for r in chat.parse_response(df).collect())
    assert rows == [(0, "Hello", "stop", 20), (1, "legacy", "length", 7), (2, None, None, None),
                    (3, None, None, None), (4, None, None, None), (5, "plain", None, None)]


@pytest.mark.parametrize("piece", [None, 2])
def test_request_parts_come_with_the_joined_body(spark, tmp_path, monkeypatch, piece):
    if piece:
        monkeypatch.setattr(chat_queries, "PIECE_PARTS", piece)
    rows = TURNS + [(9, k, "user", "word " * (k % 7) * 40) for k in range(30)] + [(None, 0, "user", "none " * 200), (None, 1, "user", "end")]
    turns(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    whole = bodies_of(chat.build_request(chat.build_messages(turns(spark, rows)), chat_queries.MODEL))
    got = chat_queries.chat_request_parts(spark, str(tmp_path))
    assert bodies_of(got) == whole
    held = {}
    for row in got.collect():
        held.setdefault(row.conv_id, []).append(row)
    for key, parts in held.items():
        heads = sorted((r for r in parts if r.body is not None), key=lambda r: r.part)
        assert "".join(r.body for r in heads) == whole[key]
        assert {(r.parts, r.last_part) for r in heads} == {(len(parts), max(r.part for r in parts))}
        assert len(heads) == (len({r.part // piece for r in parts}) if piece else 1)
    assert max(map(len, held.values())) > 5
