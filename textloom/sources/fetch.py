"""Pages over HTTP as a data source: every host's URLs lie in one partition, so its rate holds for the whole cluster.

fetch() deals URLs (url, and ord for their order) to groups of hosts, a folder each below the shared folder; the
source reads a group in one task, one host after another, and holds only what it is about to fetch.  Rows are
stored as they come, so a page isn't fetched again by a later look at them; a task that is lost fetches its
group anew.  Switch speculative execution off where a rate must hold.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from textloom.functions import url as U
from textloom.functions.calls import steady
from textloom.operators import mining
from textloom.operators.lineage import place, stored

PAGE = "url string, ord long, host string, final_url string, status int, content_type string, content binary, tries int, error string, fetched_at double"
AGENT = "textloom/1"


class HostReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.groups = options["path"], int(options["groups"])
        self.agent, self.timeout = options.get("agent", AGENT), float(options.get("timeout", 30))
        self.rate, self.tries, self.wait = float(options.get("per_second", 1)), int(options.get("tries", 3)), float(options.get("wait", 1))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(i) for i in range(self.groups)]

    def _urls(self, group: int) -> Iterator[tuple[str, int, str]]:
        """(url, ord, host) of a group, sorted by host when they were dealt."""
        from pyarrow import fs
        from pyarrow import parquet as pq

        store, base = fs.FileSystem.from_uri(f"{self.path}/group={group}")
        files = store.get_file_info(fs.FileSelector(base, allow_not_found=True))
        for f in sorted(x.path for x in files if x.path.endswith(".parquet")):
            with store.open_input_file(f) as src:
                for batch in pq.ParquetFile(src).iter_batches(1024, columns=["url", "ord", "host"]):
                    yield from zip(*(batch.column(c).to_pylist() for c in ("url", "ord", "host")), strict=True)

    def _get(self, url: str):
        asked = urllib.request.Request(url, headers={"User-Agent": self.agent})
        with urllib.request.urlopen(asked, timeout=self.timeout) as r:
            return r.geturl(), r.status, r.headers.get("Content-Type") or "", r.read()

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        host, call, count = None, None, [0]

        def once(url: str):
            count[0] += 1
            return self._get(url)

        for url, order, of in self._urls(partition.value):
            if of != host:
                host, call = of, steady(once, self.tries, self.wait, self.rate)
            count[0] = 0
            try:
                final, status, kind, content = call(url)
                yield url, order, of, final, status, kind, content, count[0], None, time.time()
            except urllib.error.HTTPError as e:
                yield url, order, of, None, e.code, None, None, count[0], f"HTTPError: {e.reason}", time.time()
            except Exception as e:  # noqa: BLE001 - whatever a server does ends as a row
                yield url, order, of, None, None, None, None, count[0], f"{type(e).__name__}: {e}", time.time()


class PagesByHost(DataSource):
    """spark.read.format("pages_by_host") over a folder that deal() wrote; options path, groups, per_second, tries, wait, timeout, agent."""

    @classmethod
    def name(cls) -> str:
        return "pages_by_host"

    def schema(self) -> str:
        return PAGE

    def reader(self, schema) -> DataSourceReader:
        return HostReader(self.options)


def deal(urls: DataFrame, path: str, groups: int) -> None:
    """URLs (url, ord) in a folder for each group of hosts: http and https, each once (the least ord), sorted by host and ord."""
    order = F.col("ord").cast("long") if "ord" in urls.columns else F.lit(0).cast("long")
    rows = urls.filter(U.is_http("url")).groupBy("url").agg(F.min(order).alias("ord")).withColumn("host", U.host("url"))
    hosts = mining.numbered(rows.select("host").distinct().withColumn("h", F.xxhash64("host")), ["h", "host"]).select("host", (F.col("n") % groups).cast("int").alias("group"))
    rows = rows.join(hosts, "host")
    rows.repartition("group").sortWithinPartitions("group", "host", "ord", "url").write.mode("overwrite").partitionBy("group").parquet(path)


def fetch(urls: DataFrame, groups: int | None = None, **options) -> DataFrame:
    """PAGE's rows, one for each distinct http(s) URL: content, or an error after so many tries.  groups: how many tasks,
    by default one for each host, 10,000 at most."""
    spark = urls.sparkSession
    if groups is None:
        groups = min(10_000, max(1, urls.select(U.host("url").alias("h")).distinct().count()))
    path = place(spark, "urls")
    deal(urls, path, groups)
    return stored(reader(spark, path, groups, **options), "fetched")


def reader(spark: SparkSession, path: str, groups: int, **options) -> DataFrame:
    spark.dataSource.register(PagesByHost)
    return spark.read.format("pages_by_host").options(path=path, groups=groups, **options).load()


def html_pages(fetched: DataFrame) -> DataFrame:
    """Pages (url, html) as the crawl and cleaning steps read them: what came with a status below 400, PDF apart."""
    pdf = F.contains(F.lower("content_type"), F.lit("application/pdf")) | F.endswith(F.lower("url"), F.lit(".pdf"))
    return fetched.filter(F.col("error").isNull() & ~pdf).select("url", F.make_valid_utf8(F.col("content").cast("string")).alias("html"))
