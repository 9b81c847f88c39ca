"""Event log to request rows: golden sequences, and random logs against a plain event-by-event replay."""

import random

import pytest
from pyspark.sql import functions as F

from crawlprism import schemas
from crawlprism.operators import requests as req
from crawlprism.streaming import jobs

def frame(spark, events):
    schema = schemas.event_schema()
    return spark.createDataFrame([tuple(e.get(f) for f in schema.fieldNames()) for e in events], schema)


def log(spark, events, page="p"):
    return frame(spark, [{"page": page, "seq": n, "base64Encoded": False, **e} for n, e in enumerate(events)])


def answer(status=200, ip="1.1.1.1", headers=None, url=None):
    return {"url": url, "status": status, "remoteIPAddress": ip, "headers": headers or {}}


def sent(i, url, **kw):
    return {"kind": req.REQUEST, "requestId": i, "url": url, "method": "GET", "type": "Image", **kw}


def run(spark, events, **kw):
    return [r.asDict() for r in req.assemble_requests(log(spark, events), **kw).orderBy("seq").collect()]


def test_success(spark):
    headers = {"etag": "1", "SET-COOKIE": "c", "x-client-data": "z"}
    (r,) = run(
        spark,
        [
            sent("100", "https://example.com/header.jpg", time=123456.0, initiator='{"type":"other"}'),
            {"kind": req.RESPONSE, "requestId": "100", "type": "Image", "response": answer(200, "123.123.123.123", headers)},
            {"kind": req.FINISHED, "requestId": "100", "encodedDataLength": 666, "time": 223456.0},
        ],
    )
    assert (r["status"], r["size"], r["time"], r["remoteIPAddress"]) == (200, 666, 100000.0, "123.123.123.123")
    assert r["responseHeaders"] == {"etag": "1", "set-cookie": "c"}
    assert r["initiators"] == []


def test_failure(spark):
    (r,) = run(spark, [sent("1", "https://e.com/x", time=10.0), {"kind": req.FAILED, "requestId": "1", "errorText": "gone", "time": 11.0}])
    assert (r["failureReason"], r["time"], r["status"], r["size"], r["responseHeaders"]) == ("gone", 1.0, None, None, None)
    (r,) = run(spark, [sent("1", "https://e.com/x"), {"kind": req.FAILED, "requestId": "1", "errorText": ""}])
    assert r["failureReason"] == "unknown error"


def test_redirect_chain(spark):
    script = '{"type":"script","url":"https://e.com/i.js"}'
    a, b, c = run(
        spark,
        [
            sent("2", "https://e.com/a", time=1.0, initiator=script, type="Script"),
            sent("2", "https://e.com/b", time=2.0, initiator='{"type":"parser"}', type="Script", redirectResponse=answer(301, "9.9.9.9", {"etag": "r"})),
            sent("2", "https://e.com/c", time=4.0, type="Script", redirectResponse=answer(302)),
            {"kind": req.RESPONSE, "requestId": "2", "type": "Script", "response": answer(200)},
            {"kind": req.FINISHED, "requestId": "2", "encodedDataLength": 7, "time": 9.0},
        ],
    )
    assert [x["status"] for x in (a, b, c)] == [301, 302, 200]
    assert [x["time"] for x in (a, b, c)] == [1.0, 2.0, 5.0]
    assert [x["size"] for x in (a, b, c)] == [None, None, 7]
    assert [x["redirectedTo"] for x in (a, b, c)] == ["https://e.com/b", "https://e.com/c", None]
    assert [x["redirectedFrom"] for x in (a, b, c)] == [None, "https://e.com/a", "https://e.com/b"]
    assert all(x["initiators"] == ["https://e.com/i.js"] for x in (a, b, c))
    assert a["responseHeaders"] == {"etag": "r"}


def test_socket(spark):
    (r,) = run(spark, [{"kind": req.SOCKET, "requestId": "3", "url": "wss://example.com/chat", "time": 5.0}])
    assert (r["type"], r["method"], r["status"], r["time"], r["initiators"]) == ("WebSocket", None, None, None, [])


def test_body_hash_and_type(spark):
    (r,) = run(
        spark,
        [
            sent("4", "https://e.com/x"),
            {"kind": req.RESPONSE, "requestId": "4", "type": "Document", "response": answer()},
            {"kind": req.FINISHED, "requestId": "4", "body": "dGVzdA==", "base64Encoded": True, "encodedDataLength": -5},
        ],
    )
    assert r["type"] == "Document"
    assert r["size"] is None
    assert r["responseBodyHash"] == "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b2b0b822cd15d6c15b0f00a08"


def test_custom_headers(spark):
    headers = {"etag": "1", "X-Client-Data": "z", "Test-Header": "t"}
    events = [sent("5", "https://e.com/x"), {"kind": req.RESPONSE, "requestId": "5", "response": answer(headers=headers)}]
    (r,) = run(spark, events, safelist=["X-Client-Data", "test-header"])
    assert r["responseHeaders"] == {"x-client-data": "z", "test-header": "t"}


def test_only_the_latest_early_event_counts(spark):
    (r,) = run(
        spark,
        [
            {"kind": req.RESPONSE, "requestId": "6", "response": answer(404)},
            {"kind": req.EXTRA, "requestId": "6", "headers": {"ETag": "early"}},
            sent("6", "https://e.com/x"),
            {"kind": req.RESPONSE, "requestId": "6", "response": answer(200, headers={"etag": "late"})},
        ],
    )
    assert (r["status"], r["responseHeaders"]) == (200, {"etag": "early"})


def test_cors_initiator(spark):
    script = '{"type":"script","url":"https://e.com/i.js"}'
    rows = run(
        spark,
        [
            sent("7", "https://api.com/x", method="OPTIONS", initiator=script),
            sent("8", "https://api.com/x", initiator='{"type":"parser","url":"https://e.com/"}'),
            sent("9", "https://api.com/y", initiator='{"type":"parser","url":"https://e.com/"}'),
        ],
    )
    assert [r["initiators"] for r in rows] == [["https://e.com/i.js"], ["https://e.com/i.js"], ["https://e.com/"]]


def test_unstorable_urls_are_dropped(spark):
    events = [sent("1", "data:text/plain,x"), sent("2", "<unknown>"), sent("3", "https://ok.com/")]
    assert [r["url"] for r in run(spark, events)] == ["https://ok.com/"]
    kept = run(spark, events + [sent("4", "https://no.com/")], url_filter=lambda page, url: ~F.contains(url, F.lit("no.com")))
    assert [r["url"] for r in kept] == ["https://ok.com/"]


def random_events(seed, pages=4, ids=5, n=600):
    rnd, out = random.Random(seed), []
    for seq in range(n):
        kind = rnd.choice([req.REQUEST] * 3 + [req.SOCKET, req.RESPONSE, req.EXTRA, req.FINISHED, req.FAILED])
        # One page owns a third of all events, one request id most of that.
        page = "hot" if rnd.random() < 0.34 else f"p{rnd.randrange(pages)}"
        rid = "hot" if page == "hot" and rnd.random() < 0.8 else str(rnd.randrange(ids))
        e = {"page": page, "seq": seq, "kind": kind, "requestId": rid, "time": float(seq + 1)}
        if kind in (req.REQUEST, req.SOCKET):
            e |= {"url": f"https://u{rnd.randrange(3)}.com/", "initiator": f'{{"type":"script","url":"https://i{seq}.com/"}}'}
        if kind == req.REQUEST:
            e |= {"method": rnd.choice(["GET", "GET", "OPTIONS"]), "type": rnd.choice(["Script", "Image"])}
            if rnd.random() < 0.4:
                e["initiator"] = e["initiator"].replace("script", "parser")
            if rnd.random() < 0.4 and e["method"] == "GET":
                e["redirectResponse"] = answer(300 + seq % 9, f"ip{seq}", {"etag": f"r{seq}"})
        if kind == req.RESPONSE:
            e |= {"type": rnd.choice([None, "Document"]), "response": answer(200 + seq % 9, f"ip{seq}", {"etag": f"s{seq}"})}
        if kind == req.EXTRA:
            e["headers"] = {"ETag": f"x{seq}"}
        if kind == req.FINISHED:
            e["encodedDataLength"] = seq
        if kind == req.FAILED:
            e["errorText"] = f"f{seq}"
        out.append(e)
    return out


def replay(events):
    """Event by event, as the events would have been handled live."""
    rows, early = [], {}

    def last(e):
        return next((r for r in reversed(rows) if (r["page"], r["id"]) == (e["page"], e["requestId"])), None)

    def target(e):
        found = last(e)
        if found is None:
            found = early[(e["page"], e["requestId"])] = {}
        return found

    def respond(row, kind_of, a):
        row["type"] = kind_of or row.get("type")
        row["status"], row["ip"] = a["status"], a["remoteIPAddress"]
        row.setdefault("headers", a["headers"])

    for e in events:
        k = e["kind"]
        if k == req.REQUEST:
            new = {"page": e["page"], "id": e["requestId"], "seq": e["seq"], "url": e["url"], "method": e["method"], "type": e["type"],
                   "start": e["time"], "init": e["initiator"]}
            if e["method"] != "OPTIONS" and "parser" in e["initiator"]:
                seen = [r for r in rows if r["page"] == e["page"] and r.get("method") == "OPTIONS" and r["url"] == e["url"]]
                new["init"] = seen[-1]["init"] if seen else e["initiator"]
            prev = last(e)
            if e.get("redirectResponse") and prev is not None:
                respond(prev, e["type"], e["redirectResponse"])
                prev["end"], prev["to"] = e["time"], e["url"]
                new["init"], new["from"] = prev["init"], prev["url"]
            for key, val in early.pop((e["page"], e["requestId"]), {}).items():
                new.setdefault(key, val)
            rows.append(new)
        elif k == req.SOCKET:
            rows.append({"page": e["page"], "id": e["requestId"], "seq": e["seq"], "url": e["url"], "type": "WebSocket", "init": e["initiator"]})
        elif k == req.RESPONSE:
            respond(target(e), e["type"], e["response"])
        elif k == req.EXTRA:
            target(e)["headers"] = {h.lower(): x for h, x in e["headers"].items()}
        elif k == req.FINISHED:
            target(e).update(end=e["time"], size=e["encodedDataLength"])
        else:
            target(e).update(end=e["time"], failure=e["errorText"])
    return {
        (r["page"], r["seq"]): (
            r["id"], r["url"], r.get("method"), r.get("type"), r.get("status"), r.get("ip"), (r.get("headers") or {}).get("etag"), r.get("size"),
            r.get("failure"), r.get("to"), r.get("from"), r["end"] - r["start"] if r.get("end") and r.get("start") else None, r["init"][24:-2],
        )
        for r in rows
    }


# Early events keep only what each kept before it was replaced, so the replay makes a new slot per event.
def replay_with_slots(events):
    seen, kept = set(), []
    latest = {}
    for e in events:
        key = (e["page"], e["requestId"])
        if e["kind"] in (req.REQUEST, req.SOCKET):
            seen.add(key)
        elif key not in seen:
            latest[key] = e["seq"]
    for e in events:
        key = (e["page"], e["requestId"])
        if key in latest and e["seq"] < latest[key] and e["kind"] not in (req.REQUEST, req.SOCKET):
            continue
        kept.append(e)
    return replay(kept)


def table(df):
    return {
        (r.page, r.seq): (
            r.requestId, r.url, r.method, r.type, r.status, r.remoteIPAddress, (r.responseHeaders or {}).get("etag"), r.size,
            r.failureReason, r.redirectedTo, r.redirectedFrom, r.time, r.initiators[0],
        )
        for r in df.collect()
    }


@pytest.mark.parametrize("limit", [10_000, 150, 0])
def test_random_logs(spark, limit):
    """No page, the hot page, and every page over the size limit; tiny segments cut every group."""
    events = random_events(11)
    assert table(req.assemble_requests(frame(spark, events), limit=limit, segment=7)) == replay_with_slots(events)


def test_early_events_of_hot_pages(spark):
    events = frame(spark, random_events(7))
    found = [sorted(map(tuple, req.merge_early_events(events, limit, 7).collect())) for limit in (10_000, 150, 0)]
    assert found[0] == found[1] == found[2] and found[0]


def test_ordinary_pages_are_shuffled_once(spark):
    plan = req.assemble_requests(frame(spark, random_events(1)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_stream_equals_batch(spark, tmp_path):
    """The log arrives in several micro-batches; each page's requests come out once, after it closed, and only if it did."""
    events = random_events(5, n=400)
    t0 = 1_700_000_000
    log = frame(spark, events).withColumn("ts", F.timestamp_seconds(F.col("seq") % 170 + t0))
    pages = sorted({r.page for r in log.select("page").distinct().collect()})
    open_, slow, good = pages[0], pages[1], pages[2:]
    closings = [(p, 0, 170) for p in good] + [(slow, -500, 170), ("end", 99_000, 99_000)]
    closed = spark.createDataFrame(closings, "page string, a long, b long")
    closed = closed.select("page", *[F.timestamp_seconds(F.col(c) + t0).alias(n) for c, n in (("a", "startedAt"), ("b", "finishedAt"))])
    beat = log.limit(1).withColumn("page", F.lit("end")).withColumn("ts", F.timestamp_seconds(F.lit(99_000 + t0)))
    for n in range(4):
        log.filter(F.col("seq") % 4 == n).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    beat.coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    for part in (closed.filter("page <> 'end'"), closed.filter("page = 'end'")):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "pages"))

    def read(name, schema):
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))

    batches = []
    save = lambda rows, batch: (batches.append({r.page for r in rows.select("page").collect()}), rows.write.mode("overwrite").parquet(str(tmp_path / f"out/{batch}")))
    q = jobs.stream_requests(read("log", log.schema), read("pages", closed.schema), save, str(tmp_path / "cp"))
    q.trigger(availableNow=True).start().awaitTermination()
    out = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "out"))
    want = table(req.assemble_requests(frame(spark, events).filter(F.col("page").isin(good))))
    assert table(out.drop("finishedAt")) == want and want
    assert sum(map(len, batches)) == len(set().union(*batches)) == len(good)
    assert open_ not in set().union(*batches)


def test_bodies_stay_below_the_first_exchange(spark):
    plan = req.assemble_requests(frame(spark, random_events(1)))._jdf.queryExecution().executedPlan().toString()
    assert "sha2" in plan.split("Exchange hashpartitioning")[1] and "sha2" not in plan.split("Exchange hashpartitioning")[0]


def test_tasks_hold_bounded_events(spark, monkeypatch):
    """Beyond a task's share of events the tasks grow in number, with the same rows."""
    from crawlprism.catalog import bridge

    events = bridge.net_events(spark, "/root/testdata/sf0.001")
    usual = sorted(map(str, req.stitch_redirects(events).collect()))
    monkeypatch.setattr(req, "TASK_EVENTS", 20)
    dealt = req.stitch_redirects(events)
    assert "REPARTITION_BY_NUM, " in dealt._jdf.queryExecution().executedPlan().toString()
    assert dealt._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(page") == 1
    assert sorted(map(str, dealt.collect())) == usual


def test_parts_of_the_visit_log_have_equal_file_counts(spark, monkeypatch):
    """However many files a part takes, a batch holds one part, the late one of few rows too."""
    from pyspark.sql import functions as F

    from crawlprism.catalog import bridge

    monkeypatch.setattr(bridge, "FILE_ROWS", 200)
    monkeypatch.setattr(bridge, "_STAGED", {})
    bridge.visit_stream(spark, "/root/testdata/sf0.001")
    folder, schema, files = bridge._STAGED[(spark.sparkContext.applicationId, "/root/testdata/sf0.001", "visit-parts")]
    rows = spark.read.schema(schema).parquet(folder)
    assert files > 1 and len(rows.inputFiles()) == files * (bridge.V_PARTS + 2)
    held = rows.groupBy("part").agg(F.countDistinct("_metadata.file_path").alias("n"), F.max("_metadata.file_modification_time").alias("last"), F.min("_metadata.file_modification_time").alias("first"))
    held = sorted(held.collect())
    assert all(r.n <= files for r in held) and all(a.last <= b.first for a, b in zip(held, held[1:]))
    assert rows.count() == bridge.staged(spark, "/root/testdata/sf0.001", "visit-log", None).count()
