"""Registered queries: chat requests over the conversations table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from dayloom.operators import chat
from dayloom.operators.digests import text_digests
from dayloom.plans.registry import query, table
from dayloom.session import fresh_database, written

MODEL = "small-instruct"
PART_BYTES = 600  # so small that most conversations come in several parts
PIECE_PARTS = chat.REQUEST_BYTES // PART_BYTES  # parts that one row can hold joined


def messages(spark, folder, **options) -> DataFrame:
    return chat.build_messages(table(spark, folder, "conversations"), **options)


MESSAGES_SQL = """listed AS (
    SELECT conv_id, to_json(list(struct_pack(role := role, content := text) ORDER BY turn)) AS messages
    FROM conversations GROUP BY conv_id)"""


@query("chat_messages", f"""WITH {MESSAGES_SQL}
    SELECT conv_id, CAST(0 AS BIGINT) AS part, CAST(messages AS VARCHAR) AS messages FROM listed""")
def chat_messages(spark, folder):
    """The messages of every conversation in turn order."""
    return messages(spark, folder).select("conv_id", "part", F.to_json("messages").alias("messages"))


PARTS_SQL = f"""sized AS (
    SELECT *, strlen(role) + strlen(text) + 32 AS bytes FROM conversations), placed AS (
    SELECT *, sum(bytes) OVER (PARTITION BY conv_id) AS total,
           coalesce(sum(bytes) OVER (PARTITION BY conv_id ORDER BY turn
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sized), parts AS (
    SELECT conv_id, CAST(CASE WHEN total > {PART_BYTES} THEN before // {PART_BYTES} ELSE 0 END AS BIGINT) AS part,
           total <= {PART_BYTES} AS closes, count(*) AS message_count,
           string_agg(text, '|' ORDER BY turn) AS texts FROM placed GROUP BY ALL
    UNION ALL SELECT conv_id, CAST(any_value(total) // {PART_BYTES} + 1 AS BIGINT), TRUE, 0, ''
    FROM placed WHERE total > {PART_BYTES} GROUP BY conv_id)"""


@query("chat_message_parts", f"WITH {PARTS_SQL} SELECT * FROM parts")
def chat_message_parts(spark, folder):
    """Long conversations cut into ordered parts of bounded size."""
    cut = messages(spark, folder, max_bytes=PART_BYTES)
    return cut.select(
        "conv_id", "part", "closes", F.size("messages").cast("bigint").alias("message_count"),
        F.array_join("messages.content", "|").alias("texts"))


def requests(spark, folder) -> DataFrame:
    return chat.build_request(messages(spark, folder), MODEL, params={
        "temperature": F.lit(0.2), "max_tokens": F.lit(64), "model": F.lit("other"), "stream": F.lit(True)})


REQUESTS_SQL = MESSAGES_SQL + f""", requests AS (
    SELECT conv_id, '{{"model":"{MODEL}","stream":false,"temperature":0.2,"max_tokens":64,"messages":'
                    || CAST(messages AS VARCHAR) || '}}' AS request FROM listed)"""


@query("chat_requests", f"WITH {REQUESTS_SQL} SELECT conv_id, request, CAST(NULL AS VARCHAR) AS error FROM requests")
def chat_requests(spark, folder):
    """One request body per conversation: model pinned, streaming off, other parameters kept."""
    return requests(spark, folder).select("conv_id", "request", "error")


FRAGMENTS_SQL = f"""{PARTS_SQL}, inner_messages AS (
    SELECT conv_id, CAST(CASE WHEN total > {PART_BYTES} THEN before // {PART_BYTES} ELSE 0 END AS BIGINT) AS part,
           CAST(to_json(list(struct_pack(role := role, content := text) ORDER BY turn)) AS VARCHAR) AS listed
    FROM placed GROUP BY ALL), fragments AS (
    SELECT conv_id, part, closes, CASE WHEN part = 0 THEN '{{"model":"{MODEL}","stream":false,"messages":[' WHEN listed IS NULL THEN '' ELSE ',' END
           || coalesce(substring(listed, 2, length(listed) - 2), '') || CASE WHEN closes THEN ']}}' ELSE '' END AS request
    FROM parts LEFT JOIN inner_messages USING (conv_id, part))"""


@query("chat_request_parts", f"""WITH {MESSAGES_SQL}, {FRAGMENTS_SQL}, counted AS (
    SELECT conv_id, count(*) AS parts, max(part) AS last_part FROM parts GROUP BY conv_id), pieces AS (
    SELECT conv_id, min(part) AS part, string_agg(request, '' ORDER BY part) AS joined FROM fragments GROUP BY conv_id, part // {PIECE_PARTS})
    SELECT fragments.conv_id, fragments.part, closes, request, parts, last_part,
           CASE WHEN last_part < {PIECE_PARTS} THEN '{{"model":"{MODEL}","stream":false,"messages":' || CAST(messages AS VARCHAR) || '}}' ELSE joined END AS body
    FROM fragments LEFT JOIN pieces ON fragments.conv_id = pieces.conv_id AND fragments.part = pieces.part
    LEFT JOIN counted ON pieces.conv_id = counted.conv_id LEFT JOIN listed ON pieces.conv_id = listed.conv_id""")
def chat_request_parts(spark, folder):
    """The bodies of long conversations as fragments, which joined in order are the whole body.

    The first fragment has the number of parts, the last one and the body joined from them. A body too long for a row
    is joined in pieces, each beside its first fragment: no group holds more than ``REQUEST_BYTES`` and one message.
    """
    fragments = written(chat.build_request(messages(spark, folder, max_bytes=PART_BYTES), MODEL).select(
        "conv_id", "part", "closes", "request"), "fragments")
    in_order = F.array_sort(F.collect_list(F.struct("part", "request")))
    pieces = fragments.groupBy("conv_id", F.expr(f"part div {PIECE_PARTS}").alias("piece")).agg(
        F.min("part").alias("first"), F.array_join(F.transform(in_order, lambda f: f["request"]), "").alias("body"))
    counted = fragments.groupBy(F.col("conv_id").alias("counted_id")).agg(
        F.count(F.lit(1)).alias("parts"), F.max("part").alias("last_part"))
    heads = pieces.join(counted, F.col("conv_id").eqNullSafe(F.col("counted_id"))).select(
        F.col("conv_id").alias("head_id"), "first", "parts", "last_part", "body")
    return fragments.join(heads, F.col("conv_id").eqNullSafe(F.col("head_id")) & (F.col("part") == F.col("first")), "left").select(
        "conv_id", "part", "closes", "request", "parts", "last_part", "body")


@query("chat_body_digests", f"""WITH {MESSAGES_SQL}
    SELECT conv_id, CAST(strlen('{{"model":"{MODEL}","stream":false,"messages":' || CAST(messages AS VARCHAR) || '}}') AS BIGINT) AS bytes,
           TRUE AS same FROM listed""")
def chat_body_digests(spark, folder):
    """Two cuts of every body, one of them whole, have one digest: compared without a row that joins the fragments."""
    cuts = [text_digests(chat.build_request(messages(spark, folder, **options), MODEL), "conv_id", "part", "request")
            for options in ({"max_bytes": PART_BYTES}, {})]
    other = cuts[1].select(F.col("conv_id").alias("other_id"), F.col("digest").alias("other_digest"), F.col("bytes").alias("other_bytes"))
    same = (F.col("digest") == F.col("other_digest")) & (F.col("bytes") == F.col("other_bytes"))
    return cuts[0].join(other, F.col("conv_id") == F.col("other_id")).select("conv_id", "bytes", same.alias("same"))


@query("chat_request_fields", f"""WITH {MESSAGES_SQL} SELECT conv_id,
    '{{"model":"{MODEL}","stream":false,"max_tokens":64'
    || CASE WHEN conv_id % 3 = 0 THEN ',"temperature":0.5' ELSE ',"temperature":0.2' END
    || CASE WHEN conv_id % 2 = 0 THEN ',"user":"u' || conv_id || '"' ELSE '' END
    || ',"messages":' || CAST(messages AS VARCHAR) || '}}' AS request FROM listed""")
def chat_request_fields(spark, folder):
    """Bodies with fields that each conversation's caller has set, beside the common ones."""
    own = table(spark, folder, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select(
        "conv_id", F.when(F.col("conv_id") % 3 == 0, F.lit(0.5)).alias("temperature"),
        F.when(F.col("conv_id") % 2 == 0, F.concat(F.lit("u"), F.col("conv_id").cast("string"))).alias("user"))
    built = chat.build_request(messages(spark, folder), MODEL, fields=own,
                               params={"max_tokens": F.lit(64), "temperature": F.lit(0.2)})
    return built.select("conv_id", "request")


def caller_bodies(spark, folder) -> DataFrame:
    """Bodies as callers send them: one per turn, with their own model; system turns send no messages."""
    given = F.when(F.col("role") != "system", F.array(F.struct("role", F.col("text").alias("content"))))
    body = F.struct(given.alias("messages"), F.lit("theirs").alias("model"), F.lit(True).alias("stream"),
                    F.length("text").alias("max_tokens"))
    return table(spark, folder, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("request_id"), F.to_json(body).alias("input"))


@query("chat_pinned_requests", f"""SELECT concat(conv_id, '-', turn) AS request_id,
    CASE WHEN role <> 'system' THEN '{MODEL}' END AS model, CASE WHEN role <> 'system' THEN 'false' END AS stream,
    CASE WHEN role <> 'system' THEN CAST(length(text) AS VARCHAR) END AS max_tokens,
    CASE WHEN role <> 'system' THEN text END AS content,
    CASE WHEN role = 'system' THEN '{chat.MISSING_MESSAGES}' END AS error FROM conversations""")
def chat_pinned_requests(spark, folder):
    """Caller-made bodies with model and streaming overwritten, or the error record."""
    pinned = chat.pin_request(caller_bodies(spark, folder), MODEL, key="request_id")

    def part(path: str, name: str):
        return F.get_json_object("request", path).alias(name)

    return pinned.select("request_id", part("$.model", "model"), part("$.stream", "stream"),
                         part("$.max_tokens", "max_tokens"), part("$.messages[0].content", "content"), "error")


def measuring_connect():
    """A model that answers with the length of the body; stands in for an endpoint."""
    def connect():
        def complete(bodies: list[str]) -> list[str]:
            return ['{"choices":[{"finish_reason":"stop","index":0,"message":{"role":"assistant","content":"%d"}}],'
                    '"usage":{"total_tokens":%d}}' % (size, size // 4) for size in map(length, bodies)]
        return complete

    def length(body) -> int:
        return len(body) if isinstance(body, str) else sum(map(len, body))
    return connect


@query("chat_score", f"""WITH {REQUESTS_SQL} SELECT conv_id, CAST(length(request) AS VARCHAR) AS answer,
    'stop' AS finish_reason, CAST(length(request) // 4 AS BIGINT) AS total_tokens, CAST(NULL AS VARCHAR) AS error
    FROM requests""")
def chat_score(spark, folder):
    """Every request sent to a model, and the responses read."""
    scored = chat.score(requests(spark, folder), measuring_connect())
    return chat.parse_response(scored).select("conv_id", "answer", "finish_reason", "total_tokens", "error")


@query("chat_score_parts", f"""WITH {MESSAGES_SQL}, bodies AS (
    SELECT conv_id, length('{{"model":"{MODEL}","stream":false,"messages":' || CAST(messages AS VARCHAR) || '}}') AS size FROM listed)
    SELECT conv_id, CAST(size AS VARCHAR) AS answer, 'stop' AS finish_reason, CAST(size // 4 AS BIGINT) AS total_tokens,
           CAST(NULL AS VARCHAR) AS error FROM bodies""")
def chat_score_parts(spark, folder):
    """Long conversations sent in parts, as one body each, with one response."""
    built = chat.build_request(messages(spark, folder, max_bytes=PART_BYTES), MODEL)
    scored = chat.score(built, measuring_connect())
    return chat.parse_response(scored).select("conv_id", "answer", "finish_reason", "total_tokens", "error")


@query("chat_score_resumed", f"""WITH {REQUESTS_SQL} SELECT conv_id, CAST(length(request) AS VARCHAR) AS answer,
    'stop' AS finish_reason, CAST(length(request) // 4 AS BIGINT) AS total_tokens, CAST(NULL AS VARCHAR) AS error
    FROM requests""")
def chat_score_resumed(spark, folder):
    """A run that has answers for half of the requests, as one that was stopped leaves them, taken up by another."""
    answers = f"{fresh_database(spark, 'scored')}.answers"
    asked = requests(spark, folder)
    chat.score_once(asked.where("conv_id % 2 = 0"), measuring_connect(), answers, chunks=2)
    scored = chat.score_once(asked, measuring_connect(), answers, chunks=2)
    return chat.parse_response(scored).select("conv_id", "answer", "finish_reason", "total_tokens", "error")


@query("chat_responses", """SELECT conv_id, turn, CASE WHEN role = 'system' THEN NULL ELSE text END AS answer,
    CASE role WHEN 'assistant' THEN 'stop' WHEN 'user' THEN 'length' END AS finish_reason,
    CASE WHEN role <> 'system' THEN length(text) END AS total_tokens FROM conversations""")
def chat_responses(spark, folder):
    """Responses of both shapes, and text that is none."""
    usage = F.struct(F.length("text").alias("total_tokens"))
    chat_shape = F.struct(
        F.array(F.struct(F.lit("stop").alias("finish_reason"), F.lit(0).alias("index"), F.struct(
            F.col("text").alias("content"), "role").alias("message"))).alias("choices"), usage.alias("usage"))
    legacy = F.struct(F.array(F.struct(
        F.array(F.struct(F.lit("length").alias("finish_reason"), "text")).alias("choices"),
        usage.alias("usage"))).alias("output"))
    response = F.when(F.col("role") == "assistant", F.to_json(chat_shape)).when(
        F.col("role") == "user", F.to_json(legacy)).otherwise(F.col("text"))
    responses = table(spark, folder, "conversations").select("conv_id", "turn", response.alias("response"))
    return chat.parse_response(responses).drop("response")
