import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from plinth.functions.text import safe_data_id
from plinth.operators.stitching import places
from plinth.sources import service, settings


class Fake(BaseHTTPRequestHandler):
    polls = 0
    uploaded = b""

    def log_message(self, *args):
        pass

    def answer(self, body, status=200):
        self.send_response(status)
        self.end_headers()
        self.wfile.write(body)

    def do_POST(self):
        asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        if asked["files"][0]["name"] == "bad.pdf":
            return self.answer(b'{"code": 7}')
        return self.answer(json.dumps({"code": 0, "data": {"batch_id": "b1", "file_urls": [f"http://{self.headers['Host']}/up"]}}).encode())

    def do_PUT(self):
        Fake.uploaded = self.rfile.read(int(self.headers["Content-Length"]))
        self.answer(b"", 201)

    def do_GET(self):
        if self.path == "/zip":
            return self.answer(b"PK")
        Fake.polls += 1
        state = "done" if Fake.polls > 1 else "running"
        return self.answer(json.dumps({"code": 0, "data": {"extract_result": {"file_name": "a.pdf", "state": state, "full_zip_url": f"http://{self.headers['Host']}/zip"}}}).encode())


def test_conversion(spark):
    server = HTTPServer(("127.0.0.1", 0), Fake)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    client = service.Service(f"http://127.0.0.1:{server.server_port}/", "key", poll_seconds=0.01, most_seconds=20)
    pdfs = spark.createDataFrame([("/in/a.pdf", bytearray(b"%PDF")), ("/in/bad.pdf", bytearray(b"x"))], "path string, content binary").coalesce(1)
    rows = {r["path"]: r for r in service.converted(pdfs, client).collect()}
    server.shutdown()
    assert bytes(rows["/in/a.pdf"]["content"]) == b"PK" and rows["/in/a.pdf"]["error"] is None and Fake.uploaded == b"%PDF"
    assert rows["/in/bad.pdf"]["content"] is None and "status 200" in rows["/in/bad.pdf"]["error"]
    with pytest.raises(service.ServiceError):
        service.Service("http://x", "")


def test_data_ids_agree(spark):
    names = ["a b", "..", "é" * 130, "plain-1"]
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", safe_data_id(F.col("n")).alias("d"))
    assert all(r["d"] == service.data_id(r["n"]) for r in df.collect())


def test_settings(tmp_path):
    (tmp_path / "s.yaml").write_text("figures:\n  include_schematics_for_vision: true\n")
    s = settings.load_settings(tmp_path / "s.yaml")
    assert settings.figure_options(s).include_schematics_for_vision and s["service"]["max_wait_seconds"] == 600
    assert settings.resolved("a", "/r").as_posix() == "/r/a" and settings.resolved("/a", "/r").as_posix() == "/a"
    with pytest.raises(FileNotFoundError):
        settings.load_settings(tmp_path / "none.yaml")


def test_canvas_places(spark):
    boxes = [[20.0 * i, 20.0 * j, 20.0 * i + 20, 20.0 * j + 20] for j in range(5) for i in range(2)]
    df = spark.createDataFrame([("p", 1, b) for b in boxes], "paper_id string, grp int, bbox array<double>")
    rows = places(df, margin=10).collect()
    assert {(r["canvas_width"], r["canvas_height"]) for r in rows} == {(60, 120)} and {r["paste_width"] for r in rows} == {20}
