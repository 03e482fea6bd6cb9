"""Seeds, fetch outcomes and the frontier loop."""

import random
from collections import Counter

import pytest

from clipyard.operators import crawl
from clipyard.schemas import FETCH_ATTEMPT
from clipyard.sources import crawl as sources

TASK = "url string, doc_type int, depth int"


def test_seed_tasks(spark):
    sites = spark.createDataFrame([("https://h.org/news/", "https://h.org/page/")], "root string, listing string")
    rows = [tuple(r) for r in sources.seed_tasks(sites).collect()]
    assert rows == [("https://h.org/news/", 0, 0)] + [(f"https://h.org/page/{i}/", 0, i - 1) for i in range(2, 11)]


def test_crawl_task_messages(spark):
    lines = ['{"url":"u","doc_type":1,"depth":3}', '{"doc_type":1}', '{"url":null}', "no json"]
    rows = sources.crawl_tasks(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [tuple(r) for r in rows] == [("u", 1, 3)]


def test_child_tasks_stop_at_the_depth_limit(spark):
    parents = spark.createDataFrame([("a", 0, 9), ("b", 1, 10), ("c", 1, 11)], TASK)
    assert [tuple(r) for r in crawl.child_tasks(parents, "url").collect()] == [("a", 1, 10)]


def test_decode_pages(spark):
    raw = [("a", "é".encode()), ("b", b"\xef\xbb\xbfx"), ("c", b"a\xffb"), ("d", None)]
    rows = sources.decode_pages(spark.createDataFrame(raw, "url string, html binary")).collect()
    assert [r["html"] for r in rows] == ["é", "x", "a\ufffdb", None]


FETCHES = {
    "first": ([(1, 200, "x"), (2, 404, None)], (1, "ok")),
    "second": ([(1, 500, None), (2, 200, "y"), (3, 404, None)], (2, "ok")),
    "gone": ([(1, 404, None), (2, 200, "z")], (1, "not_found")),
    "late": ([(1, 500, None), (2, None, None), (3, 200, "late")], (2, "exhausted")),
    "no_body": ([(1, 200, None), (2, 200, "w")], (1, "no_document")),
    "refused": ([(1, None, None), (2, 404, None)], (2, "not_found")),
}


def test_fetch_outcomes(spark):
    rows = [(u, n, s, h) for u, (tries, _) in FETCHES.items() for n, s, h in tries]
    attempts = spark.createDataFrame(rows, FETCH_ATTEMPT)
    got = {r["url"]: (r["attempt"], r["outcome"]) for r in sources.fetch_outcomes(attempts).collect()}
    assert got == {u: want for u, (_, want) in FETCHES.items()}
    pages = {tuple(r) for r in sources.fetched_pages(attempts).collect()}
    assert pages == {("first", "x"), ("second", "y")}


def walk(edges, seeds, max_depth, dedup):
    """The queue, one task at a time."""
    visits, seen = Counter(), set()
    for depth in range(max_depth + 1):
        level = Counter({(u, k): 1 for u, k, d in seeds if d == depth})
        for (u, k, d), n in list(visits.items()):
            if d == depth - 1:
                for v in edges.get((u, k), []):
                    level[(v, 1)] += n
        for task, n in level.items():
            if not dedup or task not in seen:
                visits[(*task, depth)] += 1 if dedup else n
                seen.add(task)
    return dict(visits)


@pytest.mark.parametrize("dedup, lane_edges", [(True, 10_000), (False, 2)])
def test_expand(spark, monkeypatch, dedup, lane_edges):
    monkeypatch.setattr(crawl, "LANE_EDGES", lane_edges)
    rng = random.Random(11)
    nodes = [f"n{i}" for i in range(40)]
    edges = {(u, 1): rng.choices(nodes, k=rng.choice([0, 1, 2, 6])) for u in nodes}
    edges[("n0", 0)] = ["n5", "n6"]
    seeds = [("n0", 0, 0), ("n7", 1, 0), ("n9", 0, 2)]
    rows = [(u, k, v) for (u, k), vs in edges.items() for v in vs]
    reached = crawl.expand(
        spark.createDataFrame(rows, "src string, doc_type int, link string"),
        spark.createDataFrame(seeds, TASK),
        max_depth=4,
        dedup=dedup,
    )
    got = {(r["url"], r["doc_type"], r["depth"]): r["visits"] for r in reached.collect()}
    assert got == walk(edges, seeds, 4, dedup)


def test_expand_reaches_late_seeds_over_an_empty_level(spark):
    edges = spark.createDataFrame([("x", 1, "y")], "src string, doc_type int, link string")
    reached = crawl.expand(edges, spark.createDataFrame([("a", 0, 0), ("x", 1, 3)], TASK), max_depth=5)
    assert sorted(map(tuple, reached.select("url", "depth").collect())) == [("a", 0), ("x", 3), ("y", 4)]


def test_expand_without_seeds(spark):
    edges = spark.createDataFrame([("x", 1, "y")], "src string, doc_type int, link string")
    assert crawl.expand(edges, spark.createDataFrame([], TASK)).count() == 0


def test_crawl_end_to_end(spark):
    def page(n, *links):
        blocks = "".join(f'<p class="recent-wrap"><b><a href="{u}">x</a></b></p>' for u in links)
        return f"<div class='post-single-details-body'><h1>t{n}</h1><hr><div><i>body {n}</i></div>{blocks}</div>"

    root = '<div class="post-blog-list"><div><i></i><p><b><i><a href="p1"></a></i></b></p></div></div>'
    pages = [("root", root), ("p1", page(1, "p2", "missing")), ("p2", page(2, "p1", "p3")), ("p3", page(3)), ("p4", page(4))]
    reached, found = crawl.crawl(
        spark.createDataFrame(pages, "url string, html string"),
        spark.createDataFrame([("root", 0, 0)], TASK),
        max_depth=2,
    )
    assert {(r["url"], r["depth"]) for r in reached.collect()} == {("root", 0), ("p1", 1), ("p2", 2), ("missing", 2)}
    assert {(r["url"], r["topic"], r["filling"]) for r in found.collect()} == {("p1", "t1", "body 1"), ("p2", "t2", "body 2")}


def test_parallel_links_are_counted_beyond_64_bits(spark):
    edges = spark.createDataFrame([("a", 1, "a")] * 200, "src string, doc_type int, link string")
    reached = crawl.expand(edges, spark.createDataFrame([("a", 1, 0)], TASK), max_depth=10, dedup=False)
    assert {r["depth"]: int(r["visits"]) for r in reached.collect()} == {d: 200**d for d in range(11)}


def test_only_the_latest_snapshot_counts(spark):
    pages = spark.createDataFrame([("u", "old", 1), ("u", "new", 2), ("v", "x", None), ("v", "x", None)], "url string, html string, version int")
    rows = crawl.latest_snapshots(pages, "version").select("url", "html").collect()
    assert sorted(map(tuple, rows)) == [("u", "new"), ("v", "x")]
    assert crawl.latest_snapshots(pages).count() == 2
