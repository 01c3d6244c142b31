import random
from collections import deque

import pytest

from textloom.operators import crawl


def queue_crawl(graph, seeds, max_depth, max_links, per_seed, total):
    """One queue after another, as a crawler without Spark does it.  graph: {page: links}, other links lead nowhere."""
    rows, fetched_total = [], 0
    for seed in seeds:
        queue, met, fetched = deque([(seed, 0, "")]), {seed}, 0
        while queue and fetched < per_seed and fetched_total < total:
            url, depth, by = queue.popleft()
            if url not in graph:
                continue
            rows.append((seed, url, depth, by, fetched))
            fetched, fetched_total = fetched + 1, fetched_total + 1
            if depth < max_depth:
                taken = 0
                for u in graph[url]:
                    if taken == max_links:
                        break
                    if u not in met:
                        met.add(u)
                        queue.append((u, depth + 1, url))
                        taken += 1
    return sorted(rows)


def tables(spark, graph, seeds):
    pages = spark.createDataFrame([(u, "".join(f'<p><a href="{x}">l</a></p>' for x in ls)) for u, ls in graph.items()], "url string, html string")
    return pages, spark.createDataFrame(list(enumerate(seeds)), "ord long, url string")


def crawled(spark, graph, seeds, **options):
    return sorted(map(tuple, crawl.breadth_first(*tables(spark, graph, seeds), **options).select("seed", "url", "depth", "found_by", "place").collect()))


def test_a_link_counts_for_the_page_that_found_it_first(spark):
    at = lambda *names: [f"http://h.com/{n}" for n in names]
    graph = dict(zip(at("s", "a", "b", "x", "y", "z", "w"), [at("a", "b"), at("x", "y"), at("x", "y", "z", "w"), [], [], [], []], strict=True))
    got = crawled(spark, graph, at("s"), max_depth=2, max_links=2)
    assert got == queue_crawl(graph, at("s"), 2, 2, 200, 1000) and {r[1][-1] for r in got} == set("sabxyzw")


def test_seeds_share_the_total_one_after_another(spark):
    at = lambda *names: [f"http://h.com/{n}" for n in names]
    graph = dict(zip(at("a", "1", "2", "b"), [at("1"), at("2"), [], []], strict=True))
    got = crawled(spark, graph, at("a", "b"), total=3)
    assert [r[1][-1] for r in sorted(got, key=lambda r: (r[0], r[4]))] == ["a", "1", "2"]
    assert crawled(spark, graph, at("b", "a"), total=3) == queue_crawl(graph, at("b", "a"), 2, 30, 200, 3)


@pytest.mark.parametrize("seed", range(6))
def test_random_graphs_as_a_queue(spark, seed):
    rng = random.Random(seed)
    n = rng.randint(8, 40)
    name = lambda i: f"http://h.com/{i}"
    graph = {name(i): [name(rng.randrange(n + n // 3)) for _ in range(rng.randint(0, 9))] for i in range(n)}  # a quarter of the links lead nowhere
    seeds = list(dict.fromkeys(name(rng.randrange(n + 2)) for _ in range(5)))
    options = {"max_depth": rng.randint(0, 4), "max_links": rng.randint(1, 4), "per_seed": rng.choice([2, 5, 9, 200]), "total": rng.choice([3, 11, 25, 1000])}
    assert crawled(spark, graph, seeds, **options) == queue_crawl(graph, seeds, **options)


def test_long_rejection_chains(spark):
    """Each page's first links are those of the page before it, so a round frees one page more."""
    n = 12
    name = lambda i: f"http://h.com/{i}"
    graph = {name(0): [name(i) for i in range(1, n)]} | {name(i): [name(1000 + j) for j in range(i + 2)] for i in range(1, n)} | {name(1000 + j): [] for j in range(n + 2)}
    assert crawled(spark, graph, [name(0)], max_depth=2, max_links=11) == queue_crawl(graph, [name(0)], 2, 11, 200, 1000)
    few = {**graph, name(0): [name(i) for i in range(1, 4)]}
    assert crawled(spark, few, [name(0)], max_depth=2, max_links=3) == queue_crawl(few, [name(0)], 2, 3, 200, 1000)


def test_admission_dead_seeds_and_pdf(spark):
    graph = {"http://a.com/": ["http://a.com/x.pdf", "http://b.com/", "mailto:me", "http://a.com/tmp/1"], "http://a.com/x.pdf": ["http://a.com/y"], "http://a.com/y": [], "http://b.com/": [], "http://a.com/tmp/1": []}
    got = crawled(spark, graph, ["http://none.com/", "http://a.com", "http://a.com/#again"], drop=["/tmp/"])
    assert got == [("http://a.com/", "http://a.com/", 0, "", 0), ("http://a.com/", "http://a.com/x.pdf", 1, "http://a.com/", 1)]
    assert crawled(spark, graph, ["http://a.com/"], allow=["b.com"]) == []
    assert len(crawled(spark, graph, ["http://a.com/"], same_domain_only=False)) == 4


def test_nulls_copies_and_no_rows(spark):
    pages = spark.createDataFrame([("http://a.com/", None), (None, "x"), ("http://b.com/?utm_source=z", '<a href="/2">'), ("http://b.com/", '<a href="/1">'), ("http://b.com/1", ""), ("http://b.com/2", "")], "url string, html string")
    seeds = spark.createDataFrame([("http://a.com/", 5), (None, 1), ("http://b.com/", None)], "url string, ord int")
    got = sorted((r.url, r.place) for r in crawl.breadth_first(pages, seeds).collect())
    assert got == [("http://a.com/", 0), ("http://b.com/", 0), ("http://b.com/1", 1)]
    assert crawl.breadth_first(pages, seeds.limit(0)).count() == 0 and crawl.breadth_first(pages.limit(0), seeds).count() == 0


def test_the_last_seed_wins_in_the_manifest(spark):
    graph = {"http://h.com/a": ["http://h.com/c"], "http://h.com/b": ["http://h.com/c"], "http://h.com/c": []}
    pages, seeds = tables(spark, graph, ["http://h.com/b", "http://h.com/a"])
    got = {r.url: (r.seed, r.found_by) for r in crawl.crawl_manifest(crawl.breadth_first(pages, seeds), seeds).collect()}
    assert got["http://h.com/c"] == ("http://h.com/a", "http://h.com/a") and len(got) == 3
