"""Calls against a local server, row processors, guarded records, observed counters, keyless rows."""

import http.server
import json
import threading
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from judgex.functions import llmjson, messages
from judgex.operators import annotate, calls, guard, observe, processors, resume
from judgex.plans.service import stand_in


class Server(http.server.ThreadingHTTPServer):
    """A chat endpoint whose replies follow the user's message; counts requests and the most that were open at once."""

    daemon_threads = True

    def __init__(self):
        super().__init__(("127.0.0.1", 0), Handler)
        self.lock, self.open, self.most, self.seen, self.keys = threading.Lock(), 0, 0, Counter(), Counter()
        threading.Thread(target=self.serve_forever, daemon=True).start()

    @property
    def url(self):
        return f"http://127.0.0.1:{self.server_address[1]}/chat"


class Handler(http.server.BaseHTTPRequestHandler):
    def log_message(self, *_):
        pass

    def do_POST(self):  # noqa: N802
        s = self.server
        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        said = body["messages"][-1]["content"]
        with s.lock:
            s.open += 1
            s.most = max(s.most, s.open)
            s.seen[said] += 1
            s.keys[self.headers.get("Authorization")] += 1
            n = s.seen[said]
        if said.startswith("slow"):
            time.sleep(float(said.split()[1]))
        code, out = 200, {"choices": [{"message": {"content": f"re: {said}"}}], "message": {"content": f" local: {said} "}}
        if said.startswith("code"):
            _, code, until = said.split()
            code = int(code) if n <= int(until) else 200
        with s.lock:
            s.open -= 1
        try:
            self.send_response(code)
            self.end_headers()
            self.wfile.write(b"not json" if said == "text" else json.dumps(out).encode())
        except OSError:
            pass


@pytest.fixture
def server():
    s = Server()
    yield s
    s.shutdown()
    s.server_close()


def _payload(text):
    return json.dumps({"messages": [{"role": "user", "content": text}]})


def _ask(server, text, **more):
    return calls.ask(_payload(text), "k", calls.http(server.url, timeout=0.5), clock=calls.QuickClock(), **more)


def test_errors_are_told_apart(server):
    kinds = {t: getattr(_ask(server, t).result, "kind", None) for t in ("hello", "code 400 9", "code 500 9", "code 429 99", "text", "slow 2")}
    assert kinds == {"hello": None, "code 400 9": "client", "code 500 9": "server", "code 429 99": "rate_limit", "text": "body", "slow 2": "timeout"}
    assert server.seen["code 400 9"] == 1 and server.seen["code 500 9"] == 4 and server.seen["code 429 99"] == 6 and server.seen["slow 2"] == 4
    nobody = calls.ask(_payload("x"), None, calls.http("http://127.0.0.1:9/"), clock=calls.QuickClock())
    assert nobody.result.kind == "connection" and nobody.requests == 4
    assert _ask(server, "code 400 9").result.code == 400


def test_waits_and_retries(server):
    o = _ask(server, "code 503 3")
    assert o.result == "re: code 503 3" and (o.attempts, o.requests, o.latency) == (1, 4, 6)
    o = _ask(server, "code 429 4")
    assert o.result.startswith("re:") and (o.attempts, o.rate_limit_retries, o.latency) == (5, 4, 2 + 4 + 8 + 16)
    o = _ask(server, "code 429 77")
    assert (o.attempts, o.rate_limit_retries, o.latency) == (6, 5, 62)
    o = _ask(server, "code 404 2", local=True)
    assert o.result == "local: code 404 2" and (o.requests, o.latency) == (3, 2)
    assert _ask(server, "code 404 7", local=True).result.kind == "client"
    assert [calls.rate_wait(i) for i in range(7)] == [2, 4, 8, 16, 32, 60, 60]


def test_window_is_bounded_and_keeps_order():
    lock, now, most, started = threading.Lock(), 0, 0, []

    def work(x):
        nonlocal now, most
        with lock:
            now += 1
            most = max(most, now)
            started.append(x)
        time.sleep(0.2 if x == 0 else 0.005)
        with lock:
            now -= 1
        return x * x

    pulled = []

    def items():
        for i in range(300):
            pulled.append(i)
            yield i

    out = calls.in_order(items(), work, 4, skip=lambda x: x % 10 == 3)
    assert next(out) == 0
    assert 20 < len(pulled) <= 4 * calls.AHEAD + 1  # the slow first call held back neither the others nor unbounded rows
    assert list(out) == [None if i % 10 == 3 else i * i for i in range(1, 300)] and 1 < most <= 4


def test_failing_work_ends_the_window():
    def work(x):
        if x == 5:
            raise ValueError("x")
        return x

    with pytest.raises(ValueError):
        list(calls.in_order(range(50), work, 3))


def test_requests_overlap_and_keep_their_rows(spark, server):
    rows = spark.range(60).repartition(1).select("id", F.when(F.col("id") % 7 != 3, F.format_string("slow 0.05 %d", "id")).alias("text"))
    payload = F.concat(F.lit('{"messages": [{"role": "user", "content": "'), "text", F.lit('"}]}'))
    began = time.monotonic()
    got = calls.requested(rows, payload, calls.http(server.url), keys=("alpha-1111", "beta-2222"), in_flight=10).collect()
    took = time.monotonic() - began
    assert all((r.call is None) == (r.text is None) and (r.call is None or r.call.content == f"re: {r.text}") for r in got) and len(got) == 60
    assert 5 < server.most <= 10 and took < 60 * 0.05 + 5
    assert {r.call.key_tail for r in got if r.call} == {"1111", "2222"} and set(server.keys) == {"Bearer alpha-1111", "Bearer beta-2222"}
    assert got[0].call.latency >= 0.05 and got[0].call.attempts == 1


def test_tasks_bound_all_open_calls(spark, server):
    rows = spark.range(40, numPartitions=8).select(F.format_string("slow 0.05 %d", "id").alias("text"))
    payload = F.concat(F.lit('{"messages": [{"role": "user", "content": "'), "text", F.lit('"}]}'))
    assert calls.requested(rows, payload, calls.http(server.url), in_flight=2, tasks=2).count() == 40 and calls.requested(rows, payload, calls.http(server.url), in_flight=2, tasks=2).filter("call.error is null").count() == 40
    assert server.most <= 4


def test_called_with_a_window(spark):
    def model(prompt, _):
        time.sleep(0.1)
        return prompt.upper()

    df = spark.createDataFrame([(i, f"p{i}") for i in range(20)], "k int, p string").repartition(1)
    began = time.monotonic()
    got = annotate.called(df, F.col("p"), model, in_flight=10).collect()
    assert {r.k: r.answer for r in got} == {i: f"P{i}" for i in range(20)} and time.monotonic() - began < 20


def test_payloads(spark):
    df = spark.createDataFrame([('甲"\n', ["a\\"], ["原告'"], None)], "z string, c array<string>, p array<string>, n string")
    r = df.select(
        messages.fee_payload("m", "c", "p", "p").alias("fee"), messages.amount_payload("m", "z", "n").alias("amount"), messages.law_payload("m", "z").alias("law"), messages.local_payload("q", F.col("z")).alias("local")
    ).first()
    fee, amount, law, local = map(json.loads, r)
    assert list(fee) == ["model", "messages", "stream", "max_tokens", "temperature", "response_format"] and fee["response_format"] == {"type": "json_object"} and fee["temperature"] == 0.0
    assert fee["messages"][0] == {"role": "system", "content": messages.FEE_SYSTEM} and "a\\" in fee["messages"][1]["content"] and '原告列表："原告\'"' not in fee["messages"][1]["content"]
    assert amount["max_tokens"] == 1024 and law["max_tokens"] == 4096 and '甲"\n' in law["messages"][1]["content"]
    assert local == {"model": "q", "messages": [{"role": "user", "content": '甲"\n'}], "stream": False}


def test_envelopes(spark):
    none = "array<string>"
    rows = [(1, (("案1", [], [], ["受理费8元"]))), (2, ("案2", [], [], [])), (3, ("案3", None, None, None)), (4, ("案4", [], [], ["受理费11元"])), (5, ("案5", [], [], ["受理费3元"]))]
    df = spark.createDataFrame([(k, (c,), (p, d, t)) for k, (c, p, d, t) in rows], f"k int, meta struct<case_no:string>, input_data struct<plaintiffs:{none},defendants:{none},cost_texts:{none}>")
    got = {r.k: json.loads(r.e) for r in processors.processed(df, processors.fee_task("m"), stand_in, ("key-1234",), clock=calls.QuickClock).select("k", processors.json_of().alias("e")).collect()}
    perf = {"attempts": 1, "key_tail": "1234", "latency": 0, "rate_limit_retries": 0}
    skipped = {"error_msg": "No cost text found in input", "extraction_result": None, "status": "skipped"}
    assert got[1]["status"] == "success" and got[1]["extraction_result"]["total_litigation_cost"] == 8 and got[1]["perf"] == perf and set(got[1]) == {"meta", "extraction_result", "status", "perf"}
    assert got[2] == skipped | {"meta": {"case_no": "案2"}} and got[3] == skipped | {"meta": {"case_no": "案3"}}
    assert got[4] == {"meta": {"case_no": "案4"}, "status": "failed", "extraction_result": {}, "perf": perf, "error_msg": "HTTP 400 Error", "raw_response": "bad request"}
    assert got[5]["raw_response"] == "不是 JSON" and got[5]["error_msg"].startswith("JSON Parsing Failed")
    law = processors.processed(spark.createDataFrame([(1, None), (2, "")], "k int, t string"), processors.citation_task("m", "t"), stand_in).select(processors.json_of().alias("e")).collect()
    assert [json.loads(r.e) for r in law] == [{"data": {"citations": []}, "error_msg": "empty_text", "status": "skipped"}] * 2


def test_resumed_runs_ask_only_what_is_left(spark):
    asked = spark.sparkContext.accumulator(0)

    def transport(payload, key, sent):
        asked.add(1)
        return calls.Reply(200, '{"choices": [{"message": {"content": "{}"}}]}')

    rows = spark.createDataFrame([(f"c{i}", f"text {i}") for i in range(10)] + [(None, "no key")], "case_no string, t string")
    earlier = rows.limit(6).selectExpr("case_no", "t", "CASE WHEN case_no = 'c2' THEN 'failed' ELSE 'success' END AS status", "CAST(NULL AS STRING) AS error_kind", "parse_json('{}') AS envelope")
    done = processors.resumed(rows, earlier, "case", lambda df: processors.processed(df, processors.citation_task("m", "t"), transport)).collect()
    assert sorted(r.case_no or "" for r in done) == ["", *(f"c{i}" for i in range(10))] and {r.status for r in done} == {"success"}
    assert asked.value == 4 + 1 + 1


# guard


def test_guard_keeps_every_record(spark):
    rows = [(1, "12.5", '{"a": 1}'), (2, "x", "{"), (3, None, None), (4, "", "[]"), (5, "7", "no")]
    df = guard.guarded(spark.createDataFrame(rows, "k int, n string, j string"), number=guard.number(F.col("n")), j2=guard.json_of(F.col("j"), "a int"), must=guard.needed(F.col("n")))
    good, bad = guard.settled(df)
    assert {r.k for r in good.collect()} == {1} and "issues" not in good.columns
    got = {r.k: [(i.step, i.reason, i.input) for i in r.issues] for r in bad.collect()}
    assert got == {2: [("number", "not a number", "x"), ("j2", "not JSON", "{")], 3: [("must", "missing", "null")], 4: [("number", "not a number", "")], 5: [("j2", "not JSON", "no")]}
    assert {(r.step, r.reason): r.records for r in guard.reasons(bad).collect()} == {("number", "not a number"): 2, ("j2", "not JSON"): 2, ("must", "missing"): 1}
    again = guard.guarded(df.drop("must"), late=guard.needed(F.col("j")))
    assert {r.k: len(r.issues) for r in again.collect()}[3] == 2  # earlier issues stay


def test_guarded_function(spark):
    def f(r):
        if r["k"] == 2:
            raise KeyError("boom")
        return {"n": "wrong type" if r["k"] == 3 else r["k"] * 2, "s": [r["t"]]}

    df = spark.createDataFrame([(i, f"t{i}") for i in range(5)] + [(9, None)], "k int, t string")
    got = {r.k: r for r in guard.guarded_map(df, f, "n int, s array<string>", "double").collect()}
    assert {k: r.n for k, r in got.items()} == {0: 0, 1: 2, 2: None, 3: None, 4: 8, 9: 18} and got[4].s == ["t4"] and got[9].s == [None]
    assert got[2].issues[0].reason == "KeyError: 'boom'" and json.loads(got[2].issues[0].input) == {"k": 2, "t": "t2"} and got[3].issues[0].step == "double" and not got[0].issues
    with pytest.raises(ValueError):
        guard.guarded_map(df, f, "k int", "x")
    assert guard.guarded_map(df.limit(0), f, "n int", "x").count() == 0


# counters


def test_counters_come_with_the_rows(spark, tmp_path):
    scans = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            scans.add(b.num_rows)
            yield b

    df = spark.createDataFrame([("success", 1.0), ("success", 3.0), ("failed", 8.0), ("skipped", None)], "status string, latency double").mapInArrow(seen, "status string, latency double")
    rows, c = observe.counted(df, *observe.counters(latency="latency"))
    rows.write.parquet(str(tmp_path / "out"))
    assert c.row == {"rows": 4, "success": 2, "failed": 1, "skipped": 1, "mean_latency": 4.0, "max_latency": 8.0, "mean_latency_success": 2.0, "mean_latency_failed": 8.0, "mean_latency_skipped": None}
    assert scans.value == 4
    rows, c = observe.counted(df.limit(0))
    rows.collect()
    assert c.row == {"rows": 0, "success": 0, "failed": 0, "skipped": 0}


def test_progress_of_streams(spark, tmp_path):
    listener = observe.Progress("stream")
    spark.streams.addListener(listener)
    try:
        src = tmp_path / "in"
        for i in range(3):
            spark.range(i * 10, i * 10 + 5).selectExpr("id", "CASE WHEN id % 5 = 0 THEN 'failed' ELSE 'success' END AS status").write.mode("append").json(str(src))
        stream = spark.readStream.schema("id long, status string").option("maxFilesPerTrigger", 2).json(str(src)).observe("stream", *observe.counters())
        q = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        for _ in range(100):
            if listener.total.get("rows") == 15:
                break
            time.sleep(0.1)
        assert listener.total == {"rows": 15, "success": 12, "failed": 3, "skipped": 0} and len(listener.batches) > 1
    finally:
        spark.streams.removeListener(listener)


# keys and answers


def test_rows_without_a_key_are_all_new(spark):
    schema = "source_file string, case_no string, n int"
    old = spark.createDataFrame([("", "", 1), ("a", "x", 2)], schema)
    new = spark.createDataFrame([("", "", 3), (None, None, 4), ("b", "x", 5), ("b", "x", 6), ("a", "x", 7), (" ", "", 8)], schema)
    assert {r.n for r in resume.unseen(old, new).collect()} == {3, 4, 5, 8}
    assert sorted(r.n for r in resume.upsert(old, new).collect()) == [1, 2, 3, 4, 5, 8]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ('{"a": 1}', '{"a": 1}'), ('so: {"a": {"b": 2}} end', '{"a": {"b": 2}}'), ('}{"a": 1}', '{"a": 1}'), ('{bad} {"a": 1} {"b": 2}', '{"a": 1}'), ('{"a": "}"}', '{"a": "}"}'),
        ('x {"a": "}"}', None), ("[1]", None), ("", None), (None, None), ("{{}", None), ('```json\n{"a": 1}\n```', '{"a": 1}'), ('{"a": NaN}', '{"a": NaN}'),
    ],
)
def test_first_object(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(llmjson.first_object("t").alias("o")).first().o == want
