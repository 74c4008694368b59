import pytest
from authweave.llm import url_filter

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]


def judged(spark, urls, rules=RULES):
    pages = spark.createDataFrame(
        [(k, u, "kept", "old") for k, u in enumerate(urls)],
        "page_id long, url string, extra string, host string",
    )
    listed = spark.createDataFrame(rules, "host string, path string, verdict string")
    rows = url_filter.judge_urls(pages, listed).orderBy("page_id").collect()
    assert all(r.extra == "kept" for r in rows)
    return [(r.host, r.path, r.rule, r.verdict) for r in rows]


def by_hand(url, rules=RULES):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]), r[2] == "block"), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


URLS = [
    None, "", "no scheme", "http://", "http://a.com", "http://a.com/", "http://A.COM/x?y=/en/#z",
    "https://example.com/en/1", "https://www.example.com/en/1", "https://m.www.example.com/en/",
    "http://notexample.com/en/", "http://a.net/es/x", "http://a.net/es", "http://net/fr/", "http://x.org?http://a.com/",
    "http://example.com:80/en/", "x://y://z.com/", "http://a..com/", "http://É.com/É", "http://a.com/" + "x/" * 5000,
    "http://" + "a." * 2000 + "net/es/", "http://a.net/es/x",
]


def test_equals_rules_applied_by_hand(spark):
    assert judged(spark, URLS) == [by_hand(u) for u in URLS]


def test_many_rules(spark):
    rules = [(f"h{k}.org", f"/{'p' * (k % 7)}", ["block", "allow"][k % 2]) for k in range(3000)]
    urls = [f"http://{s}h{k}.org/{'p' * (k % 5)}q" for k in range(0, 4000, 37) for s in ("", "sub.")]
    assert judged(spark, urls, rules) == [by_hand(u, rules) for u in urls]


def test_conflict_blocks_and_bad_rules_fit_nothing(spark):
    rules = [("a.com", "/", "allow"), ("a.com", "/", "block"), (None, "/", "block"), ("", "", "block"), ("b.com", None, "block")]
    assert judged(spark, ["http://a.com/", "http://b.com/", None], rules) == [
        ("a.com", "/", "a.com/", "block"), ("b.com", "/", None, "allow"), ("", "", None, "allow")]


@pytest.mark.parametrize("urls,rules", [([], RULES), (["http://a.com/"], [])])
def test_empty(spark, urls, rules):
    assert judged(spark, urls, rules) == [("a.com", "/", None, "allow")][:len(urls)]
