"""URL rules against a brute-force judge; the filter has no false negatives."""

import random
import re

from hamper.llm import url_filter as X

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
         ("com", "/de/", "block"), ("com", "/de/", "block"), ("x.com", "", "block"), (None, "/", "block"), ("", "", None)]


def judge(url, rules):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1], m[2]) if m else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if h is not None and p is not None and v is not None
            and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


URLS = ["http://example.org/es/1", "https://WWW.Example.ORG/en/12?x#y", "http://notexample.org/es/", "http://org", "http://org/",
        "ftp://a.com/de/x", "http://a.com/fr/", "http://x.com", "http://y.x.com?q", "no scheme", "", None, "http://", "://com/de/",
        "http://com./de/", "http://a.com/DE/", "http://É.org/ü", "http://a.org/" + "p" * 100_000, "a://b://c.com/de/", "http://a.com\n/de/"]


def run(spark, rows, rules, **kw):
    pages = spark.createDataFrame(rows, "page_id long, url string, host int, rule string")
    r = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = X.judge_urls(pages, r, **kw).select("row.page_id", "row.url", "host", "path", "rule", "verdict").collect()
    return sorted(map(tuple, got), key=repr)


def test_rules_match_brute_force(spark):
    rows = [(i, u, 1, "own") for i, u in enumerate(URLS)] + [(None, URLS[0], None, None), (0, URLS[0], 1, "own")]
    assert run(spark, rows, RULES) == sorted([(r[0], r[1], *judge(r[1], RULES)) for r in rows], key=repr)


def test_many_rules_with_and_without_broadcast(spark, monkeypatch):
    rng = random.Random(4)
    hosts = [f"{a}{b}" for a in ("", "a.", "b.a.") for b in ("com", "org", "n.net")]
    rules = [(rng.choice(hosts), "/" + "/".join(rng.choice("xyz") for _ in range(rng.randint(0, 3))), rng.choice(["allow", "block"]))
             for _ in range(60)]
    rules = list({r[:2]: r for r in rules}.values())
    rows = [(i, f"http://{rng.choice(['', 'www.', 'a.', 'c.'])}{rng.choice(hosts)}/" + "/".join(
        rng.choice("xyz") for _ in range(rng.randint(0, 4))), None, None) for i in range(400)]
    expected = sorted([(r[0], r[1], *judge(r[1], rules)) for r in rows], key=repr)
    assert run(spark, rows, rules) == expected
    monkeypatch.setattr(X, "BROADCAST_BYTES", 0)
    assert run(spark, rows, rules) == expected


def test_no_false_negatives_and_empty_tables(spark):
    keys = spark.range(5000).selectExpr("concat('host', id, '.org/') AS key")
    bloom, n = X.build_bloom(keys, 5000)
    assert X.possible_hits(keys, bloom, n).count() == 5000
    others = spark.range(20_000).selectExpr("concat('other', id, '.org/') AS key")
    assert X.possible_hits(others, bloom, n).count() < 400   # the exact join removes these
    assert run(spark, [], RULES) == []
    assert run(spark, [(1, URLS[0], None, None)], []) == [(1, URLS[0], "example.org", "/es/1", None, "allow")]
