from __future__ import annotations

import io
import json
import threading
import zipfile
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlsplit

import pytest
from pyspark.sql import functions as F

from veredas.sources.feeds import feed_entries
from veredas.sources.jsonl import last_by_key, read_jsonl, with_status
from veredas.sources.paged_json import PagedJson
from veredas.sources.pages import anchors_of, page_anchors, page_state, strip_html
from veredas.sources.runs import latest_before, manifest, read_artifact, run_dates, write_json_lines, write_run
from veredas.sources.sheets import read_sheets, sheet_rows


def test_jsonl_and_status(spark, tmp_path):
    path = tmp_path / "log.jsonl"
    path.write_text('{"id": "a", "status": "Open", "n": 1}\nnot json\n{"id": "b", "status": "closed", "n": 2}\n{"id": "a", "n": 3}\n')
    rows, bad = read_jsonl(spark, str(path), "id string, status string, n long")
    assert rows.count() == 3 and [r[0] for r in bad.collect()] == ["not json"]
    assert [r.id for r in with_status(rows, "status", allow=["open"]).collect()] == ["a"]
    assert sorted(r.n for r in with_status(rows, "status", deny=["closed"]).collect()) == [1, 3]
    assert sorted((r.id, r.n) for r in last_by_key(rows, "id", "n").collect()) == [("a", 3), ("b", 2)]


def test_feed_entries(spark):
    body = """<rss><item><title><![CDATA[Uno & dos]]></title><link>http://a.example/1</link><description>&lt;p&gt;x&lt;/p&gt; y</description>
    <pubDate>Mon, 6 Oct 2025 04:41:12 GMT</pubDate></item><item><title>sin enlace</title></item>
    <entry><title>Tres</title><link rel='a' href='http://a.example/3'/><updated>2025-10-01</updated></entry><item><title>roto"""
    df = spark.createDataFrame([("s", body), ("t", None), ("u", "")], "source string, body string")
    got = [tuple(r) for r in feed_entries(df).orderBy("entry_no").collect()]
    assert got == [("s", 0, "http://a.example/1", "Uno & dos", "<p>x</p> y", "Mon, 6 Oct 2025 04:41:12 GMT"), ("s", 2, "http://a.example/3", "Tres", "", "2025-10-01")]


def test_anchors_and_text(spark):
    body = "<nav><a href='/n'>Un menú muy largo</a></nav><main><a href='/1?utm_a=2'>Primera nota larga</a><a href='/1'>Primera nota otra vez</a><a href='http://b.example/'>Otro sitio distinto</a><a href='/2'>corto</a><a href='mailto:x'>Escriba a la redacción</a></main>"
    assert anchors_of(body, "http://a.example/x", 10, frozenset()) == [("Primera nota larga", "http://a.example/1?utm_a=2")]
    df = spark.createDataFrame([(1, "http://a.example/", body), (2, None, None)], "k int, url string, body string")
    assert [tuple(r) for r in page_anchors(df, key="k").collect()] == [("1", 0, "Primera nota larga", "http://a.example/1?utm_a=2")]
    texts = spark.createDataFrame([("<p>a <b>b</b></p><script>c</script>&eacute;",), ("plain  text",), (None,), ("",)], "b string")
    assert [r[0] for r in texts.select(strip_html(F.col("b"))).collect()] == ["a b é", "plain  text", None, ""]
    states = spark.createDataFrame([("<html>Access denied",), ("<app-root></app-root>",), ("<p>x",), (None,)], "b string")
    assert [r[0] for r in states.select(page_state(F.col("b"))).collect()] == ["blocked", "shell", "page", "page"]


def test_shell_mark_after_a_long_head(spark):
    head = "<html><head>" + "<meta name='a' content='b'>" * 200 + "</head><body>"
    bodies = [head + "<app-root></app-root>", head + "Access denied", head + "<app-root></app-root>" + "x" * 20_000]
    states = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, b string").orderBy("i")
    assert [r[0] for r in states.select(page_state(F.col("b"))).collect()] == ["shell", "page", "page"]


def workbook() -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/sharedStrings.xml", "<sst xmlns='m'><si><t>Año</t></si><si><r><t>To</t></r><r><t>tal</t></r></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", "<worksheet xmlns='m'><sheetData><row r='1'><c r='A1' t='s'><v>0</v></c><c r='C1' t='s'><v>1</v></c></row><row r='2'><c r='A2'><v>2025</v></c><c r='B2' t='inlineStr'><is><t>x</t></is></c></row></sheetData></worksheet>")
    return out.getvalue()


def test_sheets(spark, tmp_path):
    assert sheet_rows(workbook()) == [{"A": "Año", "C": "Total"}, {"A": "2025", "B": "x"}]
    assert sheet_rows(b"no zip") == []
    (tmp_path / "a.xlsx").write_bytes(workbook())
    rows = read_sheets(spark, str(tmp_path / "*.xlsx")).orderBy("row_no").collect()
    assert [(r.row_no, r.cells) for r in rows] == [(1, {"A": "Año", "C": "Total"}), (2, {"A": "2025", "B": "x"})]


@pytest.fixture
def service():
    asked = []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            query = {k: v[0] for k, v in parse_qs(urlsplit(self.path).query).items()}
            asked.append(query)
            start, n = int(query["$offset"]), int(query["$limit"])
            rows = [{"id": str(i), "at": f"2025-01-{i:02d}", "other": {"x": i}} for i in range(1, 26)][start : start + n]
            body = json.dumps(rows).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/r.json", asked
    server.shutdown()


def test_paged_json(spark, service):
    url, asked = service
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedJson)
    df = spark.read.format("paged_json").schema("id string, at string, other string").option("rows", 20).option("pagesize", 8).load(url)
    assert sorted(int(r.id) for r in df.where("at >= '2025-01-05'").collect()) == list(range(5, 21))
    assert {q["$offset"] for q in asked} == {"0", "8", "16"} and all(q["$where"] == "at >= '2025-01-05'" for q in asked)


def test_runs(spark, tmp_path):
    root = str(tmp_path / "runs")
    assert read_artifact(spark, root, "a") is None and run_dates(spark, root, "a") == [] and latest_before(spark, root, "a", "x") is None
    for day, n in (("2025-01-01", 3), ("2025-01-02", 4), ("2025-01-01", 5)):
        write_run(spark.range(n), root, "a", day)
    assert run_dates(spark, root, "a") == ["2025-01-01", "2025-01-02"] and run_dates(spark, root, "a", 1) == ["2025-01-02"]
    assert latest_before(spark, root, "a", "2025-01-02").count() == 5
    assert sorted((r.artifact, r["rows"]) for r in manifest(spark, root, ["a", "b"], "2025-01-02").collect()) == [("a", 4), ("b", 0)]
    write_json_lines(spark.createDataFrame([(2, None)], "b int, a string").coalesce(1), str(tmp_path / "j"))
    assert next((tmp_path / "j").glob("part*")).read_text() == '{"a":null,"b":2}\n'
