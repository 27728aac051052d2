from wayfarer.llm import url_filter as U


def judged(spark, urls, **options):
    rows = spark.createDataFrame([(i, u, 1, "h") for i, u in enumerate(urls)], "page_id long, url string, rule int, host string")
    found = U.url_filter(rows, **options).collect()
    return [(r.host, r.path, r.rule, r.verdict) for r in sorted(found, key=lambda r: r.page_id)]


def brute(url, rules, default):
    host, path = U.split_url(url)
    best = None
    for rule, verdict in rules:
        h, slash, p = rule.partition("/")
        if host and (host == h or host.endswith("." + h)) and path.startswith(slash + p) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return (host, path, *(best or (None, default)))


URLS = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/1", "https://example.org/en/12?q=1", "http://example.org",
        "http://example.org/", "http://x.org/es/", "http://m.a.com/fr/9#x", "http://a.com/de/9", "http://a.com/en/de/",
        "ftp://org/x", "a://b://c.org/d", "http://notexample.org/es/", "http://a.net/fr/", "http://user@a.com:80/fr/",
        "http://É.org/", "http://a.org\n/x", "http://" + "a." * 300 + "org/" + "x" * 5000]


def test_special_urls(spark):
    assert judged(spark, URLS) == [brute(u, U.RULES, "allow") for u in URLS]


def test_other_rules(spark):
    rules = [("net", "block"), ("com/f", "block"), ("com/fr/9", "allow"), ("org/", "block"), ("org/", "allow")]
    assert judged(spark, URLS, rules=rules, default="block") == [brute(u, rules[:3] + rules[4:], "block") for u in URLS]


def test_no_rules_and_no_rows(spark):
    assert judged(spark, ["http://a.com/fr/"], rules=[]) == [("a.com", "/fr/", None, "allow")]
    assert judged(spark, []) == []


def test_collisions_are_confirmed(tmp_path, monkeypatch):
    """All digests equal: the stored strings decide."""
    monkeypatch.setattr(U.xxhash, "xxh64_intdigest", lambda s: 7)
    file = tmp_path / "index"
    file.write_bytes(U.index_bytes(U.RULES))
    index = U.DigestIndex(str(file))
    urls = [u for u in URLS if u and len(u) < 1000]
    rules, verdicts = index.probe([U.split_url(u) for u in urls])
    assert [(r, v or "allow") for r, v in zip(rules, verdicts, strict=True)] == [brute(u, U.RULES, "allow")[2:] for u in urls]
