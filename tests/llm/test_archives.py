"""WARC round trips and dated URL lists."""

import base64
import collections
import datetime as dt
import gzip
import hashlib

from pyspark.sql import functions as F

from rawlane.llm import queries, urlfilter, warc


def test_round_trip_of_odd_pages(spark, tmp_path):
    trap = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(1, "http://a.example/x", "<p>same</p>"), (2, "http://b.example/", "<p>same</p>"), (3, None, None), (4, "http://c.example/\r\nX: y", trap), (5, "no address", ""), (6, "http://a.example/é", "é日本\r\n\r\n"), (6, "http://a.example/é", "é日本\r\n\r\n"), (None, "http://d.example/", "<p>same</p>"), (7, "http://e.example", "x" * 300000)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, payload string")
    path = str(tmp_path / "warc")
    warc.write_warc(pages, path)
    records = warc.read_warc(spark, path)
    assert collections.Counter(r.record_type for r in records.collect())["malformed"] == 0
    assembled = warc.assemble_transactions(records)
    captures = warc.revisited(assembled, F.try_element_at("metadata.fields", F.lit("key")).cast("long")).collect()
    assert len(captures) == len(rows)
    got = collections.Counter()
    for c in captures:
        assert c.request.start_line.startswith("GET /") and c.record_id.startswith("<urn:uuid:")
        notes = c.metadata.fields
        got[(notes.get("key"), c.record_type, None if c.revisits is None else str(c.revisits), c.payload_bytes, c.payload_digest)] += 1
        if c.record_type == "response":
            assert hashlib.sha1(c.payload).digest() == base64.b32decode(c.payload_digest)
    want = collections.Counter()
    best = {}
    for k, _, h in rows:
        best[h or ""] = max([x for x in (best.get(h or ""), k) if x is not None], default=None)
    for k, _, h in rows:
        body, first = (h or "").encode(), best[h or ""]
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        again = first is not None and k != first
        want[(None if k is None else str(k), "revisit" if again else "response", str(first) if again else None, len(body), digest)] += 1
    assert got == want
    few = str(tmp_path / "few")
    warc.write_warc(pages, few, least_revisit_bytes=100)
    assert {r.record_type for r in warc.assemble_transactions(warc.read_warc(spark, few, with_payload=False)).collect()} == {"response"}
    none = str(tmp_path / "none")
    warc.write_warc(pages.where(F.lit(False)), none)
    assert warc.assemble_transactions(warc.read_warc(spark, none)).collect() == []


def test_archives_are_closed_by_bytes(spark, tmp_path):
    pages = spark.range(300).select(F.col("id").alias("page_id"), F.lit("http://a.example/").alias("url"), F.expr("repeat(cast(id as string), if(id = 7, 200000, 300))").alias("html"))
    path = str(tmp_path / "warc")
    warc.write_warc(pages.coalesce(2), path, archive_bytes=50_000)
    contents = [gzip.decompress(r.content) for r in spark.read.format("binaryFile").load(path).collect()]
    assert len(contents) >= 6 and sorted(map(len, contents))[-2] < 60_000
    for content in contents:
        records = list(warc.parse_archive("f", content))
        assert [r[2] for r in records].count("warcinfo") == 1 and records[0][2] == "warcinfo" and records[-1][2] != "malformed"
    captures = warc.assemble_transactions(warc.read_warc(spark, path, with_payload=False)).collect()
    assert sorted(int(c.metadata.fields["key"]) for c in captures) == list(range(300))


def test_a_domain_above_many_hosts_is_asked_for_once_a_day(spark, settings):
    """A third of all hosts are below one listed domain: the lists meet a row per pattern and day, and the hosts' rows are
    dealt into shares."""
    day = dt.date(2024, 1, 15)
    host = F.when(F.col("id") % 3 == 0, F.concat(F.lit("h"), F.col("id").cast("string"), F.lit(".hot.example"))).otherwise(F.concat(F.lit("w"), F.col("id").cast("string"), F.lit(".net")))
    captures = spark.range(6000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://"), host, F.lit("/")).alias("url"), F.lit(day).alias("fetch_date"))
    listed = spark.createDataFrame([("l", "domain", "hot.example", "add", day), ("l", "domain", "h0.hot.example", "add", day), ("l", "host", "w1.net", "add", day), (None, "host", "w2.net", "add", day), ("l", None, "w4.net", "add", day)], "list_name string, kind string, pattern string, action string, effective date")
    with settings(spark__sql__autoBroadcastJoinThreshold="-1"):
        got = urlfilter.judge_captures(captures, listed)
        plan = got._jdf.queryExecution().executedPlan().toString()
        rows = {r.page_id: r.matches for r in got.collect()}
    assert "Python" not in plan and "BroadcastHashJoin" not in plan and "share" in plan
    want = {i: "l:domain:hot.example" if i % 3 == 0 else "" for i in range(6000)}
    assert rows == want | {0: "l:domain:h0.hot.example,l:domain:hot.example", 1: "l:host:w1.net", 2: "host:w2.net"}


def test_foreign_archives(spark):
    head = "WARC/1.0\r\nWARC-Type: {}\r\nWARC-Record-ID: <{}>\r\n{}Content-Type: {}\r\nContent-Length: {}\r\n\r\n{}\r\n\r\n"
    http = "HTTP/1.1 200 OK\r\nX: 1\r\n\r\nbody"
    response = head.format("response", "r1", "WARC-Concurrent-To: <q1>\r\nWARC-Concurrent-To: <m1>\r\n", "application/http", len(http), http)
    request = head.format("request", "q1", "", "application/http", 18, "GET / HTTP/1.1\r\n\r\n")
    metadata = head.format("metadata", "m1", "", "application/warc-fields", 6, "a: b\r\n")
    lonely = head.format("response", "r2", "", "application/http", len(http), http)
    whole = "".join((response, request, metadata, lonely)).encode()
    members = b"".join(gzip.compress(x.encode()) for x in (response, request, metadata, lonely))
    for content in (whole, gzip.compress(whole), members, whole + b"WARC/1.0\r\nContent-Length: 99\r\n\r\nshort"):
        rows = list(warc.parse_archive("f", content))
        assert [r[2] for r in rows][:4] == ["response", "request", "metadata", "response"]
        assert (len(rows) == 5) == content.endswith(b"short") and rows[-1][2] in ("response", "malformed")
        table = spark.createDataFrame([(*r[:9], dict(r[9] or []), *r[10:]) for r in rows], warc.RECORD)
        got = {c.record_id: c for c in warc.assemble_transactions(table).collect()}
        assert got["<r1>"].request.record_id == "<q1>" and got["<r1>"].metadata.fields == {"a": "b"} and got["<r1>"].payload == b"body"
        assert got["<r2>"].request is None and got["<r2>"].metadata is None


def test_entries_become_intervals(spark):
    day = lambda n: dt.date(2024, 1, n)
    entries = [("l", "host", "a", "remove", day(1)), ("l", "host", "a", "add", day(3)), ("l", "host", "a", "add", day(3)), ("l", "host", "a", "add", day(4)), ("l", "host", "a", "remove", day(6)), ("l", "host", "a", "add", day(6)), ("l", "host", "a", "remove", day(8)), ("l", "host", "a", "add", day(9)), ("l", "host", None, "add", day(1)), ("l", "host", "b", "add", None), ("l", "host", "b", "odd", day(2)), (None, "host", "b", "add", day(2))]
    table = spark.createDataFrame(entries, "list_name string, kind string, pattern string, action string, effective date")
    got = {tuple(r) for r in urlfilter.validity_intervals(table).collect()}
    assert got == {("l", "host", "a", day(3), day(8)), ("l", "host", "a", day(9), None), (None, "host", "b", day(2), None)}


def test_captures_are_judged_as_of_their_day(spark):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    entries = [("x", "host", "a.b.example", "add", day(10)), ("x", "host", "a.b.example", "remove", day(50)), ("y", "domain", "b.example", "add", day(40)), ("z", "url", "a.b.example/p?q=1", "add", day(0)), ("z", "url", "a.b.example/p?q=1", "remove", day(5))]
    captures = [(i, "HTTPS://u:p@A.b.example:8080/p?q=1#f", day(i)) for i in (0, 4, 5, 9, 10, 39, 40, 49, 50, 400)]
    captures += [(1000, "http://c.b.example/", day(60)), (1001, "http://xb.example/", day(60)), (1002, None, day(60)), (1003, "http://a.b.example", None), (1004, "nonsense", day(60)), (0, "HTTPS://u:p@A.b.example:8080/p?q=1#f", day(0)), (None, "http://a.b.example./p?q=1/", day(4))]
    listed = spark.createDataFrame(entries, "list_name string, kind string, pattern string, action string, effective date")
    table = spark.createDataFrame([(*c, "clash", True) for c in captures], "page_id long, url string, fetch_date date, host string, blocked boolean")
    got = urlfilter.judge_captures(table, listed)
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
    rows = collections.Counter((r.page_id, r.matches, r.blocked) for r in got.collect())
    x, y, z = "x:host:a.b.example", "y:domain:b.example", "z:url:a.b.example/p?q=1"
    want = {0: z, 4: z, 5: "", 9: "", 10: x, 39: x, 40: f"{x},{y}", 49: f"{x},{y}", 50: y, 400: y, 1000: y, 1001: "", 1002: "", 1003: "", 1004: "", None: z}
    assert rows == collections.Counter({(k, v, v != ""): 1 + (k == 0) for k, v in want.items()})
    assert urlfilter.judge_captures(table.where(F.lit(False)), listed).collect() == []
    assert {r.blocked for r in urlfilter.judge_captures(table, listed.where(F.lit(False))).collect()} == {False}


def test_registered_archive_query_on_all_pages(spark):
    folder = "/root/testdata/sf0.001"
    pages = spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "html").collect()
    largest = {}
    for p in pages:
        largest[p.html or ""] = max(p.page_id, largest.get(p.html or "", p.page_id))
    want = []
    for p in pages:
        body, first = (p.html or "").encode(), largest[p.html or ""]
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        want.append((p.page_id, len(body), digest, "response" if first == p.page_id else "revisit", None if first == p.page_id else first))
    got = queries.QUERIES["op2_warc"](spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, got.collect())) == sorted(want)
