import random

from eventstar.llm import urlfilter as U

SCHEMA = "page_id bigint, url string, host string, verdict string"


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([i for i, c in enumerate(rest) if c in "/?#"], default=len(rest))
        host, rest = rest[:end], rest[end:]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        path = rest[:min([i for i, c in enumerate(rest) if c in "?#"], default=len(rest))]
    fit = [(-len(h + p), -len(h), h + p, v) for v, h, p in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = min(fit, default=None)
    return host, path, best and best[2], best[3] if best else default


def check(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(urls)], SCHEMA)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict)
           for r in U.judge_urls(pages, U.rule_table(spark, rules)).collect()}
    assert got == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_contract_rules(spark):
    urls = [None, "", "no scheme", "http://", "http://a.net", "http://a.net/", "http://NET/x?y#z",
            "https://m.Example.NET/en/1?q", "http://example.net/enx", "http://example.com/de/",
            "http://xexample.com/de/", "http://a.b.org/fr/1", "http://org/fr/", "http://org?/fr/",
            "http://example.net.", "http://a..net/", "x://y://net/", "http://net:80/", "http://É.net/É/",
            "http://example.com#/de/"]
    check(spark, urls * 3, U.RULES)


def test_nested_rules_against_brute_force(spark):
    rng = random.Random(2)
    labels = ["a", "b", "ab", "c", "a-b"]
    host = lambda: ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))
    path = lambda: "/" + "/".join(rng.choice("xyz") for _ in range(rng.randint(0, 3)))
    rules = list({(h, p): (rng.choice(["allow", "block"]), h, p)
                  for h, p in ((host(), rng.choice(["", path()])) for _ in range(120))}.values())
    check(spark, [f"http://{host()}{path()}" for _ in range(600)], rules)


def test_empty_tables(spark):
    pages = spark.createDataFrame([], SCHEMA)
    assert U.judge_urls(pages, U.rule_table(spark, U.RULES)).count() == 0
    some = spark.createDataFrame([(1, "http://a.net/", "", "")], SCHEMA)
    assert [r.verdict for r in U.judge_urls(some, U.rule_table(spark, []), "block").collect()] == ["block"]
