"""Chat requests in bulk: assemble messages, build request bodies, score, read the responses."""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Callable, Iterator
from itertools import chain, groupby

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from dayloom.operators.digests import text_digests
from dayloom.operators.parts import heavy_keys, ordered_parts, split_by_keys
from dayloom.operators.sizes import measured
from dayloom.session import staged, written

# Fixed value: the answer to a request without messages.
MISSING_MESSAGES = "input.messages is required (OpenAI chat format)."

REQUEST_BYTES = 64 * 1024 * 1024  # one row holds at most this much of a conversation
FRAMING_BYTES = 32  # quotes, braces and names around one message
TIMEOUT_SECONDS = 300
LONGEST_STRING = str(2**31 - 1)  # of the decoder; its default is 20 million characters
PINNED = ("model", "stream")


def message_bytes() -> Column:
    sizes = [F.coalesce(F.octet_length(c), F.lit(0)) for c in ("role", "content")]
    return (sizes[0] + sizes[1] + FRAMING_BYTES).cast("bigint")


def _collected(rows: DataFrame, by: list[str], entry: list[str], unpack: Callable) -> DataFrame:
    """One array of entries per group, in the order of their fields."""
    entries = F.sort_array(F.collect_list(F.struct(*entry)))
    return rows.groupBy(*by).agg(entries.alias("entries")).withColumn("messages", unpack(F.col("entries")))


def build_messages(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text", max_bytes: int = REQUEST_BYTES) -> DataFrame:
    """``(key, part, closes, messages)``: the messages of each conversation in turn order.

    A conversation of up to ``max_bytes`` is one row: part 0, and it closes. A longer one comes
    as parts that follow each other, cut at every ``max_bytes``, and an empty last part that
    closes, so that no task ever holds a whole one. The parts in order are the conversation:
    nothing is dropped. Messages of one turn are ordered by role and a hash of the text.
    Conversations are measured first; without long ones, the usual case, the rest is a single
    shuffle.
    """
    rows = turns.select(F.col(key), F.col(turn).alias("turn"), F.col(role).alias("role"),
                        F.xxhash64(text).alias("tie"), F.col(text).alias("content"))
    order = ["turn", "role", "tie"]
    heavy = heavy_keys(rows, key, message_bytes(), max_bytes)

    def message(entry: Column) -> Column:
        return F.struct(entry["role"].alias("role"), entry["content"].alias("content"))

    def in_one_row(conversations: DataFrame) -> DataFrame:
        return _collected(
            conversations, [key], [*order, "content"], lambda e: F.transform(e, message),
        ).select(key, F.lit(0).cast("bigint").alias("part"), F.lit(True).alias("closes"), "messages")

    if heavy is None:
        return in_one_row(rows)
    size = measured(heavy)
    light, oversized = split_by_keys(rows, heavy, key, size.is_small())
    cut = ordered_parts(oversized, key, order, message_bytes(), max_bytes, size.is_small())
    parts = _collected(
        cut, [key, "part"], [*order, "content", "copies"],
        lambda e: F.flatten(F.transform(
            e, lambda entry: F.array_repeat(message(entry), entry["copies"].cast("int")))),
    ).select(key, "part", F.lit(False).alias("closes"), "messages")
    none = F.array().cast("array<struct<role:string,content:string>>")
    ends = heavy.select(key, F.expr(f"total div {max_bytes} + 1").alias("part"),
                        F.lit(True).alias("closes"), none.alias("messages"))
    return in_one_row(light).unionByName(parts).unionByName(ends)


def build_request(messages: DataFrame, model: str, key: str = "conv_id",
                  params: dict[str, Column] | None = None, fields: DataFrame | None = None) -> DataFrame:
    """``(key, part, closes, request, error)``: one JSON body per conversation, from ``build_messages``.

    ``model`` is pinned and ``stream`` is off whatever ``params`` say; other parameters are kept.
    ``fields`` has the key and the fields that each conversation's caller has set, one row per
    conversation; a NULL there is a field not set, and a field set wins over ``params``.
    Without messages there is the error record instead of a body. The body of a conversation in
    several parts is cut with it: the fragments joined in part order are the body. Only the key
    and prompt text go along.
    """
    keep_nulls = {"ignoreNullFields": "false"}
    reserved = (*PINNED, "messages")
    own = [] if fields is None else [c for c in fields.columns if c not in (key, *reserved)]
    kept = [value.alias(name) for name, value in (params or {}).items() if name not in (*reserved, *own)]
    plain = settings = F.to_json(F.struct(F.lit(model).alias("model"), F.lit(False).alias("stream"), *kept), keep_nulls)
    if own:
        # a field that is set, else the parameter of that name, else nothing
        chosen = [F.coalesce(F.col(f"_own.{c}"), params[c]) if c in (params or {}) else F.col(f"_own.{c}") for c in own]
        extra = F.to_json(F.struct(*(v.alias(c) for c, v in zip(own, chosen, strict=True))), {"ignoreNullFields": "true"})
        settings = F.when(extra == "{}", F.col("_settings")).otherwise(
            F.concat(F.expr("left(_settings, length(_settings) - 1)"), F.lit(","), F.substring(extra, 2, 2**31 - 1)))
        given = fields.select(F.col(key).alias("_key"), F.struct(*own).alias("_own"))
        messages = messages.join(given, F.col(key).eqNullSafe(F.col("_key")), "left").withColumn(
            "_settings", plain)
    empty = F.coalesce(F.size("messages"), F.lit(0)) == 0
    nothing = empty & (F.col("part") == 0)
    opening = F.when(F.col("part") == 0, F.concat(
        F.expr("left(settings, length(settings) - 1)"), F.lit(',"messages":['))).otherwise(
        F.when(empty, "").otherwise(","))
    listed = F.expr("substring(listed, 2, length(listed) - 2)")
    closing = F.when(F.col("closes"), "]}").otherwise("")
    return (
        messages.withColumn("settings", settings)
        .withColumn("listed", F.when(empty, "[]").otherwise(F.to_json("messages", keep_nulls)))
        .select(key, "part", "closes",
                F.when(~nothing, F.concat(opening, listed, closing)).alias("request"),
                F.when(nothing, F.lit(MISSING_MESSAGES)).alias("error"))
    )


# JSON texts that count as "nothing given".
FALSY_JSON = ("null", "false", "0", "0.0", '""', "[]", "{}")
NOT_AN_OBJECT = "input must be a JSON object."
LARGE_BODY = 16 * 1024 * 1024  # beyond this the JVM's decoder gives up; which decoder reads a body changes no result


def _pinned_by_hand(text: str, model: str) -> tuple[str | None, str | None]:
    """``(request, error)`` of one body, for those that the JVM's decoder refuses."""
    try:
        given = json.loads(text)
    except (ValueError, RecursionError):
        return None, NOT_AN_OBJECT
    if not given:
        return None, MISSING_MESSAGES
    if not isinstance(given, dict):
        return None, NOT_AN_OBJECT
    if not given.get("messages"):
        return None, MISSING_MESSAGES
    return json.dumps({**given, "model": model, "stream": False}, ensure_ascii=False, separators=(",", ":")), None


def pin_request(bodies: DataFrame, model: str, key: str = "conv_id", body: str = "input") -> DataFrame:
    """``(key, request, error)`` from caller-made JSON bodies: ``model`` and ``stream`` are overwritten.

    Every other field is kept with its JSON type. A body that is NULL or empty, or has no
    messages, gives the error record; so does one that is no JSON object. Of repeated names the
    last one counts. Bodies are decoded once and written in two lanes: those that the JVM's decoder takes
    stay in it; those it refuses or would round (too large, names that repeat, very long numbers) go
    through a decoder without its limits, in a branch of their own that reads no others.
    """
    @F.pandas_udf("request string, error string")
    def by_hand(refused: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_pinned_by_hand(text, model) for text in refused], columns=["request", "error"])

    given = F.coalesce(body, F.lit("{}"))
    large = F.octet_length("given") > LARGE_BODY
    decoded = bodies.select(key, given.alias("given")).select(
        key, "given", F.explode(F.array(F.try_parse_json(F.when(~large, F.col("given"))))).alias("value"))
    refused = large | F.col("value").isNull() | F.col("given").rlike("[0-9]{39}")
    lanes = written(decoded.select(
        key, F.when(refused, F.col("given")).alias("given"), F.when(~refused, F.col("value")).alias("value"),
        refused.alias("refused")), "bodies", "refused")
    other = lanes.where("refused").select(key, by_hand("given").alias("made")).select(key, "made.request", "made.error")
    taken = lanes.where("NOT refused")
    fields = taken.select(
        key, F.coalesce(F.to_json("value"), F.lit("?")).isin(*FALSY_JSON).alias("nothing"),
        F.try_variant_get("value", "$", "map<string,variant>").alias("fields"))  # NULL unless it is an object
    others = F.map_filter("fields", lambda name, _: ~name.isin(*PINNED))
    pinned = F.create_map(F.lit("model"), F.lit(model).cast("variant"),
                          F.lit("stream"), F.lit(False).cast("variant"))
    messages = F.coalesce(F.to_json(F.try_element_at("fields", F.lit("messages"))), F.lit("null"))
    error = F.when(F.col("nothing"), MISSING_MESSAGES).when(F.col("fields").isNull(), NOT_AN_OBJECT).when(
        messages.isin(*FALSY_JSON), MISSING_MESSAGES)
    made = fields.select(key, F.to_json(F.map_concat(others, pinned)).alias("request"), error.alias("error"))
    return made.select(key, F.when(F.col("error").isNull(), F.col("request")).alias("request"), "error").unionByName(other)


def score(requests: DataFrame, connect: Callable[[], Callable[[list[str]], list[str]]],
          key: str = "conv_id", concurrency: int | None = None, profile=None) -> DataFrame:
    """``(key, part, response, error)``: send every body, return the response body unchanged.

    ``connect`` is called once per task and returns ``complete(bodies) -> responses``; an
    exception in it fails the job. Error records are passed on unsent. A body in several parts is
    sent as one, and has one row: ``complete`` gets it as an iterator of its fragments in order,
    which are read as they are sent, so that no task holds a whole one. ``concurrency`` caps the number of tasks that call the model;
    where the cluster schedules by resource, a ``profile`` with several cores per task caps it too
    and leaves the tasks small, so that less is sent again when an executor is lost. Each evaluation
    of the result calls the model anew, so write it before using it twice. ``complete`` gets as
    many bodies at a time as Spark puts into one Arrow batch (64 MiB by default).
    """
    if "part" not in requests.columns:
        requests = requests.withColumn("part", F.lit(0).cast("bigint")).withColumn("closes", F.lit(True))
    whole = (F.col("part") == 0) & F.col("closes")
    prompts = requests.where(whole).select(key, "part", "request", "error")
    fragments = requests.where(~whole).select(key, "part", "request")
    if concurrency is not None:
        prompts, fragments = prompts.repartition(concurrency), fragments.repartition(concurrency, key)
    else:
        fragments = fragments.repartition(key)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        complete = connect()
        for batch in batches:
            ready = batch["error"].isna()
            bodies = batch.loc[ready, "request"].tolist()
            answers = complete(bodies) if bodies else []
            if len(answers) != len(bodies):
                raise ValueError(f"{len(bodies)} requests got {len(answers)} responses")
            response = pd.Series(None, index=batch.index, dtype=object)
            response.loc[ready] = answers
            yield batch[[key, "part", "error"]].assign(response=response)[[key, "part", "response", "error"]]

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        complete = connect()
        rows = (row for batch in batches for row in batch.itertuples(index=False, name=None))
        for _, parts in groupby(rows, lambda row: row[0] if row[0] == row[0] else None):
            first = next(parts)
            answers = complete([chain([first[2]], (row[2] for row in parts))])
            if len(answers) != 1 or next(parts, None) is not None:
                raise ValueError("a request in parts was not read to its end, or got no response of its own")
            yield pd.DataFrame({key: [first[0]], "part": [0], "response": answers, "error": pd.Series([None], dtype=object)})

    schema = T.StructType([
        requests.schema[key], T.StructField("part", T.LongType()),
        T.StructField("response", T.StringType()), T.StructField("error", T.StringType()),
    ])
    ordered = fragments.sortWithinPartitions(key, "part")
    return prompts.mapInPandas(send, schema, profile=profile).unionByName(
        ordered.mapInPandas(stream, schema, profile=profile))


class ScoringStopped(Exception):
    """The model failed for some requests; what it answered is kept, and the next call sends only the others."""

    def __init__(self, answered: int, failures: list[str]):
        self.answered, self.failures = answered, failures
        super().__init__(f"{len(failures)} tasks stopped after {answered} answers: {failures[0]}")


REQUEST_HASH = "request_hash"
ANSWERS_SCHEMA = f"{REQUEST_HASH} string, response string"


def hashed_requests(requests: DataFrame, key: str = "conv_id") -> DataFrame:
    """The requests with the hash of their whole body: SHA-256, or for a body in parts the digest over its parts."""
    if "part" not in requests.columns:
        requests = requests.withColumn("part", F.lit(0).cast("bigint")).withColumn("closes", F.lit(True))
    whole = (F.col("part") == 0) & F.col("closes")
    alone = requests.where(whole).withColumn(REQUEST_HASH, F.sha2("request", 256))
    parted = requests.where(~whole)
    digests = text_digests(parted, key, "part", "request").select(
        F.col(key).alias("_key"), F.concat_ws("-", F.lit("parts"), "bytes", "digest").alias(REQUEST_HASH))
    return alone.unionByName(parted.join(digests, F.col(key).eqNullSafe(F.col("_key"))).drop("_key"))


def score_once(requests: DataFrame, connect: Callable[[], Callable[[list[str]], list[str]]], answers: str,
               key: str = "conv_id", chunks: int = 16, concurrency: int | None = None) -> DataFrame:
    """``score`` with a ledger of responses: a request that has its answer in the table ``answers`` is not sent.

    Requests are told apart by a hash of their body, equal ones are sent once, and they go in ``chunks`` by that hash, each
    committed before the next. Bodies are sent one at a time. When the model fails, the task stops sending and
    hands on what it has; all answers of the chunk are committed, and then ``ScoringStopped`` is raised.
    Calling again sends what has no answer yet. Only a task that dies with its executor loses answers: those that it
    alone had in hand.
    """
    spark = requests.sparkSession
    spark.sql(f"CREATE TABLE IF NOT EXISTS {answers} ({ANSWERS_SCHEMA}) USING parquet")
    hashed = written(hashed_requests(requests, key), "requests")
    whole = (F.col("part") == 0) & F.col("closes")
    kind = T.StructType([T.StructField(REQUEST_HASH, T.StringType()), T.StructField("response", T.StringType()),
                         T.StructField("failure", T.StringType())])

    def sent(rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
        complete = connect()
        for name, parts in groupby(rows, lambda row: row[0]):
            first = next(parts)
            body = first[2] if first[1] is None else chain([first[2]], (row[2] for row in parts))
            try:
                made = complete([body])
                if len(made) != 1:
                    raise ValueError(f"1 request got {len(made)} responses")
            except Exception as error:  # whatever the model raises ends this task's sending, not what it has answered
                yield pd.DataFrame([(name, None, f"{type(error).__name__}: {error}")], columns=kind.names)
                return
            yield pd.DataFrame([(name, made[0], None)], columns=kind.names)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from sent(row for batch in batches for row in batch.itertuples(index=False, name=None))

    def pending(rows: DataFrame) -> DataFrame:
        return rows.join(spark.table(answers).select(F.col(REQUEST_HASH).alias("_known")),
                         F.col(REQUEST_HASH) == F.col("_known"), "left_anti")

    prompts = hashed.where(whole & F.col("error").isNull())
    parted = hashed.where(~whole)
    in_parts = not parted.isEmpty()
    for chunk in range(chunks):
        def of_chunk(rows: DataFrame, chunk: int = chunk) -> DataFrame:
            return pending(rows.where(F.pmod(F.xxhash64(REQUEST_HASH), F.lit(chunks)) == chunk))

        alone = of_chunk(prompts).groupBy(REQUEST_HASH).agg(F.first("request").alias("request")).select(
            REQUEST_HASH, F.lit(None).cast("bigint").alias("part"), "request")
        alone = alone if concurrency is None else alone.repartition(concurrency)
        scored = alone.mapInPandas(send, kind)
        if in_parts:
            chosen = of_chunk(parted).groupBy(REQUEST_HASH).agg(F.min(key).alias("_chosen"))
            pieces = of_chunk(parted).join(
                chosen.withColumnRenamed(REQUEST_HASH, "_hash"), (F.col(REQUEST_HASH) == F.col("_hash")) & F.col(key).eqNullSafe(F.col("_chosen")))
            ordered = pieces.select(REQUEST_HASH, "part", "request").repartition(REQUEST_HASH).sortWithinPartitions(REQUEST_HASH, "part")
            scored = scored.unionByName(ordered.mapInPandas(send, kind))
        with staged(scored, "answers") as once:
            once.where("failure IS NULL").select(REQUEST_HASH, "response").write.insertInto(answers)
            failures = [row.failure for row in once.where("failure IS NOT NULL").select("failure").limit(100).collect()]
            if failures:
                raise ScoringStopped(once.where("failure IS NULL").count(), failures)
    held = spark.table(answers).select(F.col(REQUEST_HASH).alias("_known"), "response")
    first_parts = hashed.where("part = 0").select(key, "part", REQUEST_HASH, "error")
    return first_parts.join(held, F.col(REQUEST_HASH) == F.col("_known"), "left").select(
        key, "part", F.when(F.col("error").isNull(), F.col("response")).alias("response"), "error")


def http_connect(url: str, timeout: float = TIMEOUT_SECONDS) -> Callable[[], Callable[[list[str]], list[str]]]:
    """``connect`` for ``score`` that posts each body to a chat-completions endpoint.

    A status outside 2xx raises; the response body comes back as it is. The fragments of a body
    in parts are sent one by one, as chunks of one request.
    """
    def connect() -> Callable[[list[str]], list[str]]:
        def post(body: str | Iterator[str]) -> str:
            data = body.encode("utf-8") if isinstance(body, str) else (part.encode("utf-8") for part in body if part)
            call = urllib.request.Request(
                url, data=data, headers={"Content-Type": "application/json"}, method="POST")
            with urllib.request.urlopen(call, timeout=timeout) as answer:
                return answer.read().decode("utf-8")

        return lambda bodies: [post(body) for body in bodies]

    return connect


CHOICE = "finish_reason: string, index: bigint, text: string, message: struct<role: string, content: string>"
USAGE = "usage: struct<total_tokens: bigint>"
ANSWERS = f"choices: array<struct<{CHOICE}>>, {USAGE}"
RESPONSE = f"struct<{ANSWERS}, output: array<struct<{ANSWERS}>>>"


def parse_response(responses: DataFrame, response: str = "response") -> DataFrame:
    """Adds ``answer, finish_reason, total_tokens`` from either response shape; NULL for other text.

    The chat shape has ``choices[].message.content``, the legacy one wraps
    ``choices[].text`` in an ``output`` array. Decoding sits in a generator so that it runs once.
    """
    decoded = responses.select(*responses.columns, F.explode(F.array(F.from_json(
        response, RESPONSE, {"maxStringLen": LONGEST_STRING}))).alias("r"))
    first, legacy = F.get("r.choices", F.lit(0)), F.get("r.output", F.lit(0))
    legacy_first = F.get(legacy["choices"], F.lit(0))
    return decoded.select(
        *responses.columns,
        F.coalesce(first["message"]["content"], first["text"], legacy_first["text"]).alias("answer"),
        F.coalesce(first["finish_reason"], legacy_first["finish_reason"]).alias("finish_reason"),
        F.coalesce(F.col("r.usage.total_tokens"), legacy["usage"]["total_tokens"]).alias("total_tokens"),
    )
