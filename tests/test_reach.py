import random

from blogweave.operators import reach


def brute(links, seeds):
    depth, referrer, now = {s: 0 for s in seeds}, {s: None for s in seeds}, set(seeds)
    while now:
        found = {}
        for a, b in links:
            if a in now and b not in depth:
                found[b] = min(found.get(b, a), a)
        for b, a in found.items():
            depth[b], referrer[b] = max(depth[x] for x in now) + 1, a
        now = set(found)
    return sorted((u, depth[u], referrer[u]) for u in depth)


def test_reachable_pages(spark):
    rng = random.Random(4)
    url = lambda n: f"http://h.ru/{n}/"       # noqa: E731
    links = [(url(rng.randrange(60)), url(rng.randrange(90))) for _ in range(110)] + [(url(5), url(5))]
    seeds = [url(1), url(2)]
    df = spark.createDataFrame(links + [(None, url(1)), (url(1), None)], "src string, dst string")
    got = reach.reachable(df, spark.createDataFrame([(s,) for s in [*seeds, seeds[0], None]], "url string"))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute(links, seeds), key=repr)


def test_one_page_written_in_two_ways(spark):
    links = [("http://h.ru/a/#x", "http://h.ru/b/?q=1&p=2"), ("http://h.ru/b/?p=2&q=1#y", "HTTP://H.ru/a/"), ("http://h.ru/b/?p=2&q=1", "http://h.ru/c/")]
    got = reach.reachable(spark.createDataFrame(links, "src string, dst string"), spark.createDataFrame([("http://h.ru/a/",)], "url string"))
    assert sorted(map(tuple, got.collect())) == [("http://h.ru/a/", 0, None), ("http://h.ru/b/?p=2&q=1", 1, "http://h.ru/a/"),
                                                 ("http://h.ru/c/", 2, "http://h.ru/b/?p=2&q=1")]


def test_no_links_and_no_seeds(spark):
    none = spark.createDataFrame([], "src string, dst string")
    assert reach.reachable(none, spark.createDataFrame([], "url string")).collect() == []
    assert [tuple(r) for r in reach.reachable(none, spark.createDataFrame([("http://h.ru",)], "url string")).collect()] == [("http://h.ru/", 0, None)]
