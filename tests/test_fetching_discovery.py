"""The fetch router, the pace of its calls, the discovery scan and written URL lists."""

import time

import pytest

from tessera.operators import frontier, store
from tessera.sources import catalog, fetching

FRONTIER = "url string, prefetched_html string"


@pytest.fixture
def keep(spark, tmp_path):
    def write(df, name):
        path = str(tmp_path / f"{name}-{len(list(tmp_path.iterdir()))}")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return write


def recorder(folder, answer):
    """A transport that leaves a file for each call."""

    def transport(url, headers, timeout):
        import uuid

        (folder / uuid.uuid4().hex).write_text(f"{time.time()} {url}")
        return answer(url)

    return transport


def calls(folder):
    return sorted((float(at), url) for at, url in (f.read_text().split(" ", 1) for f in folder.iterdir()))


def test_only_what_a_route_failed_goes_on(spark, keep, tmp_path_factory):
    def answer(url):
        kinds = {"up": (200, "proxied", None), "gone": (200, "Warning: target URL returned error 404", None), "busy": (429, "", None), "empty": (200, "", None)}
        if url.startswith("p/"):
            return next(v for k, v in kinds.items() if k in url)
        if "slow" in url:
            raise TimeoutError("late")
        return (500, "", None) if "bad" in url else (200, "<p>itself</p>", "e")

    log = tmp_path_factory.mktemp("calls")
    sites = ["http://x.test/up", "http://x.test/busy", "http://x.test/empty-bad", "http://s.strict.test/busy", "http://s.strict.test/gone", "http://by.test/page", "http://by.test/slow", None]
    rows = spark.createDataFrame([(u, None) for u in sites[:-1]] + [("http://h.test/up", "<b>held</b>")], FRONTIER)
    proxy, how = fetching.Proxy("p/", gap_s=0, pause_s=0), fetching.Direct(gap_s=0, attempts=1)
    got = {r.url: r for r in fetching.routed(rows, proxy, how, keep, recorder(log, answer), 3, ("by.test",), ("strict.test",)).collect()}
    seen = {u: (r.route, r.ok, r.text, r.status_code) for u, r in got.items()}
    assert seen == {
        "http://x.test/up": ("proxy", True, "proxied", 200), "http://x.test/busy": ("fallback", True, "itself", 200), "http://x.test/empty-bad": ("fallback", False, None, 500),
        "http://s.strict.test/busy": ("proxy", False, None, 429), "http://s.strict.test/gone": ("fallback", True, "itself", 200),
        "http://by.test/page": ("direct", True, "itself", 200), "http://by.test/slow": ("direct", False, None, 408), "http://h.test/up": ("held", True, "held", 200),
    }
    made = sorted(u for _, u in calls(log))
    want = [f"p/{u}" for u in sites[:5]] + ["http://x.test/busy", "http://x.test/empty-bad", "http://s.strict.test/gone", "http://by.test/page", "http://by.test/slow"]
    assert made == sorted(want)  # each once, though the proxy's answers feed two steps


def test_no_rows_and_null_url(spark, keep):
    proxy, how = fetching.Proxy("p/", gap_s=0), fetching.Direct(gap_s=0, attempts=1)
    down = lambda url, headers, timeout: (404, "", None)
    assert fetching.routed(spark.createDataFrame([], FRONTIER), proxy, how, keep, down, 2).count() == 0
    got = fetching.routed(spark.createDataFrame([(None, None)], FRONTIER), proxy, how, keep, down, 2).collect()
    assert [(r.url, r.ok, r.route) for r in got] == [(None, False, "fallback")]


def test_pace_of_a_hot_and_a_cold_site(spark, tmp_path):
    rows = spark.createDataFrame([(f"http://hot.test/{i}", None) for i in range(24)] + [(f"http://cold.test/{i}", None) for i in range(4)], FRONTIER)
    dealt = fetching.lanes(rows, fetching.urls.host(fetching.F.col("url")), 0.2, 4, most=5).groupBy("__site", "__gap").agg(fetching.F.countDistinct("__lane").alias("n"))
    assert {(r["__site"], round(r["__gap"], 3)): r.n for r in dealt.collect()} == {("hot.test", 0.8): 4, ("cold.test", 0.2): 1}
    log = tmp_path / "log"
    log.mkdir()
    lanes = fetching.lanes(rows, fetching.urls.host(fetching.F.col("url")), 0.2, 4, most=5)
    send = recorder(log, lambda url: (200, "x", None))
    work = fetching._paced(lambda url, gap: ((send(url, {}, 1)[1], 200, None, None), time.monotonic()))
    assert lanes.select("url", "__site", "__gap").mapInArrow(work, fetching.ANSWER).count() == 28
    for site, ways in (("hot", 4), ("cold", 1)):
        at = [t for t, u in calls(log) if f"//{site}.test" in u]
        # in any stretch no more calls than the rate allows, but for the first of each lane
        assert all(j - i <= (at[j] - at[i] + 0.02) / 0.2 + ways for i in range(len(at)) for j in range(i, len(at)))


def test_scan_in_rounds(spark, keep):
    page = lambda *to: "".join(f'<a href="{u}">x</a>' for u in to)
    pages = spark.createDataFrame(
        [
            ("http://s1/", page("/card-a", "/other", "http://s2/"), "see [new Gold card](http://n/gold)"), ("http://s2/", page("/card-b", "http://s1/card-a"), ""),
            ("http://s1/card-a", page("/card-c", "/card-a", "http://s2/card-b"), ""), ("http://n/gold", page("/card-d"), ""),
        ],
        "url string, html string, text string",
    )
    seeds = spark.createDataFrame([(0, "http://s1/"), (1, "http://s2/"), (2, "http://s2/"), (3, "http://none/")], "seed_pos long, url string")
    fetch = lambda asked: pages.join(asked.distinct(), "url", "left_semi")
    got = {(r.link, r.seed, r.anchor, r.hop) for r in frontier.scan(seeds, fetch, ("CARD",), keep, depth=2).collect()}
    one = {("http://s1/card-a", "http://s1/", "", 1), ("http://n/gold", "http://s1/", "new Gold card", 1), ("http://s2/card-b", "http://s2/", "", 1)}
    assert got == one | {("http://s1/card-c", "http://s1/", "", 2), ("http://n/card-d", "http://s1/", "", 2)}
    assert {(r.link, r.hop) for r in frontier.scan(seeds, fetch, ("card",), keep, depth=1, most=1).collect()} == {("http://s1/card-a", 1), ("http://n/gold", 1), ("http://s2/card-b", 1)}
    assert frontier.scan(seeds, fetch, (), keep).count() == 0


def test_scan_caps_before_the_shuffle(spark):
    read = spark.createDataFrame([], "seed_pos long, seed string, at array<int>, url string, html string, text string")
    plan = frontier.candidates(read, ("card",))._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_discovery_file(spark, tmp_path):
    (tmp_path / "d.yaml").write_text("sources:\n  - http://b\n  - http://a\nkeywords: [launches, ltf]\ncrawl: {max_pages_per_source: 7}\n")
    got = catalog.discovery(spark, str(tmp_path / "d.yaml"))
    assert [(r.seed_pos, r.url) for r in got.seeds.orderBy("seed_pos").collect()] == [(0, "http://b"), (1, "http://a")]
    assert (got.keywords, got.links_per_seed, got.depth) == (("launches", "ltf"), 7, 1)


def test_lists_of_a_large_issuer(spark, tmp_path):
    made = [("big", f"http://b/{i * 7919 % 5000:05d}") for i in range(5000)] * 2 + [("007", "http://s/1"), (None, "http://n"), ("n", None)]
    store.write_url_lists(spark.createDataFrame(made, "issuer_id string, url string"), str(tmp_path / "lists"), 4)
    files = sorted((tmp_path / "lists" / "issuer_id=big").glob("part-*"))
    lines = [x for f in files for x in f.read_text().splitlines()]
    assert len(files) > 1 and lines == sorted(set(u for i, u in made if i == "big"))
    lists = store.read_url_lists(spark, str(tmp_path / "lists"))
    assert lists.count() == 5001
    names = spark.createDataFrame([("007", "Seven", "bank"), ("other", "O", "bank")], "issuer_id string, name string, type string")
    extra = spark.createDataFrame([("007", "# note"), ("007", " http://s/1 "), ("007", "http://s/x.pdf")], "issuer_id string, url string")
    assert [tuple(r) for r in store.list_rows(lists.union(extra), names).collect()] == [("007", "http://s/1", "Seven", "bank", False)]
