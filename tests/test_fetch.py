import threading
import time
from collections import defaultdict
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from textloom.operators import crawl
from textloom.sources import fetch


class Site(BaseHTTPRequestHandler):
    seen = defaultdict(list)
    lock = threading.Lock()

    def do_GET(self):  # noqa: N802
        with self.lock:
            self.seen[self.server.server_port].append((self.path, time.monotonic(), self.headers.get("User-Agent")))
            n = sum(p == self.path for p, _, _ in self.seen[self.server.server_port])
        if self.path.startswith("/missing") or (self.path.startswith("/twice") and n < 3):
            self.send_error(404 if self.path.startswith("/missing") else 503)
            return
        if self.path == "/moved":
            self.send_response(302)
            self.send_header("Location", "/page/1")
            self.end_headers()
            return
        if self.path == "/slow":
            time.sleep(2)
        body = f"<html><title>{self.path}</title><body><a href='/page/1'>é</a></body></html>".encode()
        self.send_response(200)
        self.send_header("Content-Type", "application/pdf" if self.path.endswith("x") else "text/html")
        self.end_headers()
        self.wfile.write(body + (b"\xff" if self.path.endswith("bad") else b""))

    def log_message(self, *args):
        pass


@pytest.fixture
def sites():
    Site.seen.clear()
    servers = [ThreadingHTTPServer(("127.0.0.1", 0), Site) for _ in range(3)]
    for s in servers:
        threading.Thread(target=s.serve_forever, daemon=True).start()
    yield [f"http://127.0.0.1:{s.server_port}" for s in servers]
    for s in servers:
        s.shutdown()
        s.server_close()


def test_a_hosts_rate_holds_over_all_tasks(spark, sites):
    urls = [(f"{s}/page/{i}", i) for i in range(6) for s in sites]
    rows = fetch.fetch(spark.createDataFrame(urls + urls[:5], "url string, ord long").repartition(8), per_second=5, agent="test/1").collect()
    assert len(rows) == 18 and all(r.status == 200 and r.tries == 1 and r.error is None and b"/page/" in r.content for r in rows)
    assert {r.host for r in rows} == {s.removeprefix("http://") for s in sites}
    assert len(Site.seen) == 3
    for asked in Site.seen.values():
        times = [t for _, t, _ in asked]
        assert [p for p, _, _ in asked] == [f"/page/{i}" for i in range(6)]
        assert times[-1] - times[0] >= 0.9 and all(b - a >= 0.1 for a, b in zip(times, times[1:])) and {a for _, _, a in asked} == {"test/1"}
    first = [min(t for _, t, _ in a) for a in Site.seen.values()]
    last = [max(t for _, t, _ in a) for a in Site.seen.values()]
    assert max(first) < min(last)  # hosts at the same time


def test_three_tries_errors_and_redirects(spark, sites):
    s = sites[0]
    asked = [f"{s}/twice", f"{s}/missing", f"{s}/moved", f"{s}/slow", f"{s}/bad", f"{s}/x", "http://127.0.0.1:9/none", "ftp://a/b", "nonsense", None]
    got = {r.url: r for r in fetch.fetch(spark.createDataFrame([(u,) for u in asked], "url string"), per_second=50, wait=0.01, timeout=1).collect()}
    assert set(got) == {u for u in asked if u and u.startswith("http")}
    assert (got[f"{s}/twice"].status, got[f"{s}/twice"].tries) == (200, 3)
    assert (got[f"{s}/missing"].status, got[f"{s}/missing"].tries, got[f"{s}/missing"].content) == (404, 3, None)
    assert got[f"{s}/moved"].final_url == f"{s}/page/1" and got[f"{s}/slow"].status is None and got[f"{s}/slow"].tries == 3
    assert got["http://127.0.0.1:9/none"].error and sum(p == "/missing" for p, _, _ in Site.seen[int(s.rsplit(":", 1)[1])]) == 3


def test_fetched_pages_go_into_the_crawl_steps(spark, sites):
    s = sites[0]
    got = fetch.fetch(spark.createDataFrame([(f"{s}/page/0",), (f"{s}/bad",), (f"{s}/x",), (f"{s}/missing",)], "url string"), per_second=50, wait=0.01)
    n = len(Site.seen[int(s.rsplit(":", 1)[1])])
    pages = fetch.html_pages(got)
    assert {r.url for r in pages.collect()} == {f"{s}/page/0", f"{s}/bad"}
    assert {r.target for r in crawl.links(pages).collect()} == {f"{s}/page/1"}
    assert len(Site.seen[int(s.rsplit(":", 1)[1])]) == n  # stored: looking twice asks no server
    assert fetch.fetch(spark.createDataFrame([], "url string")).count() == 0
