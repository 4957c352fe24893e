import re

from citytherm.llm import urls

URLS = [None, "", "no scheme", "http://", "HTTP://A.Example.COM/de/x?y#z", "https://m.example.net/en/1#top", "https://example.net/en", "http://net/", "http://xnet/a",
        "http://a.b.org/fr/", "http://org/fr/x://y.net/", "ftp://x.net?q=://", "http://www.cheap-pills.example.com/en/4?a=1&b=2", "http://é.example.com/de/\nx"]


def brute(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]


def fitting(host, path):
    found = [r for _, r in urls.RULES for h, _, p in [r.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return max(found, key=len, default=None)


def test_parts_and_rules(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(0, URLS[4], "x"), (None, URLS[5], "y")]
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string, host string")).collect()
    assert len(got) == len(rows)
    verdict = {r: v for v, r in urls.RULES}
    want = sorted((i, *brute(u), fitting(*brute(u))) for i, u, _ in rows if i is not None)
    assert sorted((r["page_id"], r["host"], r["path"], r["rule"]) for r in got if r["page_id"] is not None) == want
    assert all(r["verdict"] == verdict[r["rule"]] for r in got if r["rule"])


def test_trees_beat_chance_on_other_urls(spark, smoke_dir):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    got = urls.judge(pages, urls.Settings(sample_rows=800)).where("rule is null").collect()
    truth = [any(w in r["host"] for w in urls.UNWANTED_WORDS) for r in got]
    right = sum(t == (r["verdict"] == "block") for t, r in zip(truth, got))
    assert right / len(got) > 0.95


def test_empty_table(spark):
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0
