"""Requests to chat models: a bounded window of open calls in every task, waits and retries, and errors that can be told apart.

A task keeps ``in_flight`` requests open and takes the next row as soon as any of them ends. Results come in the order of the rows; at most
``AHEAD`` times as many rows as open calls wait for their turn, so a slow answer holds back neither the others nor much memory. With
``tasks`` the rows are dealt to so many tasks, which bounds all open calls to ``tasks * in_flight``.

A transport sends one request and returns code and body, or raises ``Unsent``. What a reply means, and whether it is asked for again, is
decided above it, alike for every transport. A call's outcome is a column of its row, never a failed task; a row without a payload isn't sent.
A task that Spark runs again sends its rows' requests again, so write the result before using it twice.
"""

from __future__ import annotations

import json
import time
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from typing import NamedTuple, TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from judgex.session import ship

#: Rows that may wait for their turn, for each open call.
AHEAD = 16
#: Waits after rate limit errors, in seconds, and how often; the same for servers that fail; codes of these.
FIRST_WAIT, FACTOR, LONGEST_WAIT, MOST_RETRIES = 2, 2, 60, 5
SERVER_WAITS, SERVER_CODES = (0, 2, 4), (500, 502, 503, 504)
#: How often, and after how many seconds, a local model is asked again.
LOCAL_RETRIES, LOCAL_WAIT = 2, 1.0
#: What errors are said to be.
SAID = {
    "api": "API Business Error: ", "structure": "Invalid Response Structure (No choices found)", "tls": "SSL Certificate Error: ", "connection": "Connection Failed: ", "timeout": "Request Timed Out: ",
    "json": "JSON Parsing Failed (LLM output was not valid JSON)", "unexpected": "Unexpected Error: ",
}
ERROR = "struct<kind:string,code:int,message:string,raw:string>"
CALL = f"struct<content:string,error:{ERROR},attempts:int,requests:int,rate_limit_retries:int,latency:double,key_tail:string>"
A, B = TypeVar("A"), TypeVar("B")


class Reply(NamedTuple):
    code: int
    body: str


class Unsent(Exception):
    """No reply came: ``kind`` is timeout, connection or tls."""

    def __init__(self, kind: str, message: str):
        super().__init__(message)
        self.kind = kind


#: Sends a JSON payload with a key; the number of the request for its row, from 1, is for stand-ins.
Transport = Callable[[str, "str | None", int], Reply]


class Clock:
    """Time as a call sees it; a stand-in may let waits pass at once."""

    def now(self) -> float:
        return time.monotonic()

    def sleep(self, seconds: float) -> None:
        time.sleep(seconds)


class QuickClock(Clock):
    """Waits add up but take no time, so latencies are those of the waits."""

    def __init__(self) -> None:
        self.at = 0.0

    def now(self) -> float:
        return self.at

    def sleep(self, seconds: float) -> None:
        self.at += seconds


class Failure(NamedTuple):
    kind: str
    code: int | None
    message: str
    raw: str | None = None


def rate_limited(message: str) -> bool:
    said = message.lower()
    return "429" in said or "too many requests" in said or "rate limit" in said


def rate_wait(retry: int) -> int:
    """Seconds to wait before a retry after a rate limit error (0 is the first)."""
    return min(FIRST_WAIT * FACTOR**retry, LONGEST_WAIT)


def _read(reply: Reply, local: bool) -> str | Failure:
    """The content of a reply, or what is wrong with it."""
    if reply.code >= 400:
        kind = "rate_limit" if reply.code == 429 else "server" if reply.code >= 500 else "client"
        return Failure(kind, reply.code, f"HTTP {reply.code} Error", reply.body)
    try:
        got = json.loads(reply.body)
    except ValueError:
        return Failure("body", reply.code, SAID["json"], reply.body)
    if not isinstance(got, dict):
        return Failure("structure", reply.code, SAID["structure"], reply.body)
    if local:
        message = got.get("message") or {}
        return str(message.get("content") or "").strip() if isinstance(message, dict) else Failure("structure", reply.code, SAID["structure"], reply.body)
    if "error" in got:
        message = f"{SAID['api']}{got['error']}"
        return Failure("rate_limit" if rate_limited(message) else "api", reply.code, message, reply.body)
    try:
        return str(got["choices"][0]["message"]["content"])
    except (KeyError, IndexError, TypeError):
        return Failure("structure", reply.code, SAID["structure"], reply.body)


class Outcome(NamedTuple):
    result: str | Failure
    attempts: int
    requests: int
    rate_limit_retries: int
    latency: float


def ask(payload: str, key: str | None, transport: Transport, local: bool = False, clock: Clock | None = None) -> Outcome:
    """One row's call to its end.

    Hosted: failing servers and requests without a reply are asked again at once, then after 2 and 4 seconds, within an attempt; a rate limit starts
    another attempt after 2, 4, 8, ... seconds. Local: whatever kept an answer away is asked for again after a fixed wait.
    """
    clock = clock or Clock()
    began, sent, attempts, limited = clock.now(), 0, 0, 0
    waits = (LOCAL_WAIT,) * LOCAL_RETRIES if local else SERVER_WAITS
    while True:
        attempts += 1
        for wait in (*waits, None):
            sent += 1
            try:
                result = _read(transport(payload, key, sent), local)
            except Unsent as e:
                result = Failure(e.kind, None, f"{SAID[e.kind]}{e}")
            except Exception as e:  # a transport's own fault is a result of the row too
                result = Failure("unexpected", None, f"{SAID['unexpected']}{e}")
                break
            if wait is None or not (isinstance(result, Failure) and (result.code is None or (result.code >= 400 if local else result.code in SERVER_CODES))):
                break
            clock.sleep(wait)
        if local or not isinstance(result, Failure) or result.kind != "rate_limit" or limited >= MOST_RETRIES:
            return Outcome(result, attempts, sent, limited, round(clock.now() - began, 2))
        clock.sleep(rate_wait(limited))
        limited += 1


def in_order(items: Iterable[A], work: Callable[[A], B], in_flight: int, skip: Callable[[A], bool] = lambda _: False) -> Iterator[B | None]:
    """``work`` of every item, in the items' order, at most ``in_flight`` at a time; None for those to skip."""
    if in_flight == 1:  # no thread has to wait for another
        yield from (None if skip(item) else work(item) for item in items)
        return
    waiting: deque[Future | None] = deque()
    pool = ThreadPoolExecutor(in_flight)
    try:
        for item in items:
            waiting.append(None if skip(item) else pool.submit(work, item))
            while waiting and (waiting[0] is None or waiting[0].done() or len(waiting) >= AHEAD * in_flight):
                head = waiting.popleft()
                yield head if head is None else head.result()
        while waiting:
            head = waiting.popleft()
            yield head if head is None else head.result()
    finally:
        pool.shutdown(wait=True, cancel_futures=True)


def _row(o: Outcome | None, key: str | None) -> dict | None:
    if o is None:
        return None
    bad = isinstance(o.result, Failure)
    return {
        "content": None if bad else o.result, "error": o.result._asdict() if bad else None, "attempts": o.attempts, "requests": o.requests,
        "rate_limit_retries": o.rate_limit_retries, "latency": o.latency, "key_tail": key[-4:] if key else None,
    }


_ERROR = pa.struct([("kind", pa.string()), ("code", pa.int32()), ("message", pa.string()), ("raw", pa.string())])
_CALL = pa.struct([("content", pa.string()), ("error", _ERROR), ("attempts", pa.int32()), ("requests", pa.int32()), ("rate_limit_retries", pa.int32()), ("latency", pa.float64()), ("key_tail", pa.string())])


def requested(
    df: DataFrame, payload: Column, transport: Transport, keys: tuple[str, ...] = (), in_flight: int = 8, tasks: int | None = None, local: bool = False, clock: Callable[[], Clock] = Clock
) -> DataFrame:
    """``df`` with a struct ``call`` (see ``CALL``), null where ``payload`` is. Keys are dealt by the payload's hash."""
    ship(df.sparkSession)
    number = F.pmod(F.xxhash64("_payload"), F.lit(len(keys))).cast("int") if keys else F.lit(-1)
    rows = df.withColumn("_payload", payload).withColumn("_key", number)
    rows = rows.repartition(tasks) if tasks else rows
    schema = T.StructType([*df.schema.fields, *T.StructType.fromDDL(f"call {CALL}").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_batches: deque[pa.RecordBatch] = deque()

        def items() -> Iterator[tuple[str | None, str | None]]:
            for b in batches:
                open_batches.append(b)
                for p, k in zip(b.column("_payload").to_pylist(), b.column("_key").to_pylist()):
                    yield p, keys[k] if k is not None and k >= 0 else None

        def one(item: tuple[str, str | None]) -> tuple[Outcome, str | None]:
            return ask(item[0], item[1], transport, local, clock()), item[1]

        done: list[dict | None] = []
        for result in in_order(items(), one, in_flight, skip=lambda x: x[0] is None):
            done.append(_row(*result) if result else None)
            while open_batches and len(done) >= open_batches[0].num_rows:
                b = open_batches.popleft()
                own, done = done[: b.num_rows], done[b.num_rows :]
                yield pa.RecordBatch.from_arrays([b.column(i) for i in range(b.num_columns - 2)] + [pa.array(own, _CALL)], names=schema.names)

    return rows.mapInArrow(run, schema)


def http(url: str, timeout: float = 120.0) -> Transport:
    """POST to an endpoint; the key is sent as a bearer token."""

    def send(payload: str, key: str | None, _: int) -> Reply:
        import socket
        import ssl
        import urllib.error
        import urllib.request

        headers = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {key}"} if key else {})
        try:
            with urllib.request.urlopen(urllib.request.Request(url, payload.encode(), headers), timeout=timeout) as r:
                return Reply(r.status, r.read().decode("utf-8", "replace"))
        except urllib.error.HTTPError as e:
            return Reply(e.code, e.read().decode("utf-8", "replace"))
        except (TimeoutError, socket.timeout) as e:
            raise Unsent("timeout", str(e)) from e
        except urllib.error.URLError as e:
            kind = "timeout" if isinstance(e.reason, TimeoutError) else "tls" if isinstance(e.reason, ssl.SSLError) else "connection"
            raise Unsent(kind, str(e.reason)) from e
        except OSError as e:
            raise Unsent("connection", str(e)) from e

    return send
