from mapmeter.llm import urls

RULES = (urls.Rule("block", "net", "/"), urls.Rule("allow", "example.net", "/en/"), urls.Rule("block", "example.com", "/de/"), urls.Rule("allow", "org", "/fr/"))
LISTED = ["http://www.bad.com/x/?b=2&a=1&utm_source=q", None, "nonsense", "https://BAD.com/x?a=1&b=2#f", "http://evil.org/fr/1"]


def judge(frame, rows, listed=LISTED):
    pages = frame(rows, "page_id long, url string, filter string, host string, block int, _url string")
    out = urls.filter_urls(pages, "url", RULES, frame([(u,) for u in listed], "url string"), "url")
    assert set(pages.columns) - {"filter"} <= set(out.columns)
    return sorted(((r.page_id, r.filter.host, r.filter.path, r.filter.rule, r.filter.listed, r.filter.verdict) for r in out.collect()), key=str)


def row(i, url):
    return (i, url, "f", "h", 7, "u")


def test_rules_and_list(frame):
    rows = [
        row(1, "http://a.Example.NET/en/1?q"), row(2, "http://example.net/de/"), row(3, "http://notexample.com/de/1"), row(4, "https://x.example.com/de/"),
        row(5, "https://www.bad.com/x?a=1&b=2"), row(6, "http://evil.org/fr/1/"), row(7, "http://bad.com/y"), row(8, "http://x.net"), row(9, "http://x.net?a/b"),
    ]
    assert judge(frame, rows) == [
        (1, "a.example.net", "/en/1", "example.net/en/", False, "allow"), (2, "example.net", "/de/", "net/", False, "block"),
        (3, "notexample.com", "/de/1", None, False, "allow"), (4, "x.example.com", "/de/", "example.com/de/", False, "block"),
        (5, "www.bad.com", "/x", None, True, "block"), (6, "evil.org", "/fr/1/", "org/fr/", True, "allow"),
        (7, "bad.com", "/y", None, False, "allow"), (8, "x.net", "", None, False, "allow"), (9, "x.net", "", None, False, "allow"),
    ]


def test_nulls_repeats_and_long_urls(frame):
    long = "http://bad.com/" + "y" * 100_000
    got = judge(frame, [row(None, None), row(1, ""), row(2, "no scheme"), row(3, long), row(3, long)], [long])
    assert [g[5] for g in got] == ["allow", "allow", "block", "block", "allow"] or sorted(g[5] for g in got) == ["allow"] * 3 + ["block"] * 2
    assert all(g[1:3] == ("", "") for g in got if g[5] == "allow")


def test_empty_tables(frame):
    assert judge(frame, []) == []
    assert [g[5] for g in judge(frame, [row(1, "http://bad.com/x")], [])] == ["allow"]


def test_filter_has_no_false_negatives_and_is_bounded(spark):
    urls_ = spark.range(5_000).selectExpr("concat('host', id, '.com/p') AS u")
    for blocks in (1, 64):  # overfull and roomy
        bloom = urls.blocked_bloom(urls_, "u", blocks)
        assert bloom.count() <= blocks
        joined = urls_.withColumn("block", urls._block(urls_["u"], blocks)).join(bloom, "block")
        for i, mask in enumerate(urls._masks(joined["u"])):
            joined = joined.where(joined[f"lane_{i}"].bitwiseAND(mask) == mask)
        assert joined.count() == 5_000
    assert urls.block_count(10**12) == urls.MAX_BLOCKS and urls.block_count(0) == 1
