from itertools import combinations

from lumenpath.llm import url_rules


def test_path_tokens_of_deep_hosts_give_rules(spark):
    """Later path tokens are mined, and the rules equal those of all subsets of all tokens."""
    urls = [(i, f"https://a.foo-bar.example.org/x/{'bad' if i % 3 == 0 else 'good'}/{'odd' if i % 2 else 'even'}.html") for i in range(120)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0), 1) for i in range(120)], "doc_id long, toxic int, quality int")
    got = {(tuple(r.tokens), r.verdict): round(r.confidence, 9) for r in url_rules.mine(pages, labels).collect()}
    rows = pages.select("page_id", url_rules.tokens(url_rules.host_of(pages.url), url_rules.path_of(pages.url)).alias("t")).collect()
    said = {}
    names = sorted({t for r in rows for t in r.t})
    for size in (1, 2, 3):
        for need in combinations(names, size):
            held = [r.page_id % 3 == 0 for r in rows if set(need) <= set(r.t)]
            for verdict, n, prior in (("block", sum(held), 1 / 3), ("allow", len(held) - sum(held), 2 / 3)):
                if n >= 20 and n / len(held) >= 0.8 and n / len(held) > min(1, prior + 0.1):
                    said[need, verdict] = round(n / len(held), 9)
    want = {(need, v): c for (need, v), c in said.items() if not any((part, v) in said for part in combinations(need, len(need) - 1))}
    assert got == want and {(("p:bad",), "block"), (("p:good",), "allow")} <= set(got)


def test_the_sample_is_taken_of_labelled_pages(spark, monkeypatch):
    monkeypatch.setattr(url_rules, "FIT_PAGES", 100)
    pages = spark.createDataFrame([(i, f"http://{'bad' if i % 2 else 'good'}.example.org/") for i in range(100)], "page_id long, url string")
    labels = spark.createDataFrame([(i, i % 2, 1) for i in range(2000)], "doc_id long, toxic int, quality int")
    assert {tuple(r.tokens) for r in url_rules.mine(pages, labels).collect()} >= {("h:bad",), ("h:good",)}
