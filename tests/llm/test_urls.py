import pytest

from repopulse.llm import urls
from repopulse.llm.queries import URL_RULES


def judged(spark, rules, *addresses, **options):
    pages = spark.createDataFrame([(n, u, "x") for n, u in enumerate(addresses)], "page_id long, url string, rule string")
    rows = sorted(urls.judge_urls(pages, rules, **options).collect(), key=lambda row: row.page_id)
    return [(row.host, row.path, row.rule, row.verdict) for row in rows]


def test_hosts_paths_and_rules(spark):
    found = judged(
        spark, URL_RULES,
        "http://a.EXAMPLE.net/en/1", "https://example.net/EN/1", "ftp://x.org/fr/", "http://net/x", "http://a.net",
        "http://myexample.com/de/1", "http://www.example.com/de/1?x=/fr/#y", "example.com/de/", None, "",
        "http://example.com#/de/", "a://b://example.net/en/", "http://x.example.net/en", "HTTP://ÄÖ.NET/",
    )
    assert found == [
        ("a.example.net", "/en/1", "example.net/en/", "allow"),
        ("example.net", "/EN/1", "net/", "block"),
        ("x.org", "/fr/", "org/fr/", "allow"),
        ("net", "/x", "net/", "block"),
        ("a.net", "", None, "allow"),
        ("myexample.com", "/de/1", None, "allow"),
        ("www.example.com", "/de/1", "example.com/de/", "block"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("example.com", "", None, "allow"),
        ("b:", "//example.net/en/", None, "allow"),
        ("x.example.net", "/en", "net/", "block"),
        ("ÄÖ.net", "/", "net/", "block"),
    ]


def test_longest_rule_then_longer_host_wins(spark):
    rules = [("block", "b.c", "/x"), ("allow", "c", "/x/y"), ("block", "c", "/x/yz"), ("allow", "c", "/x/yz")]
    found = judged(spark, rules, "h://a.b.c/x/yq", "h://b.c/xx", "h://c/x/yz")
    assert [row[2:] for row in found] == [("b.c/x", "block"), ("b.c/x", "block"), ("c/x/yz", "block")]


def test_default_verdict_and_empty_lists(spark):
    assert judged(spark, [], "http://a/b", default="block") == [("a", "/b", None, "block")]
    pages = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge_urls(pages, URL_RULES).count() == 0
    with pytest.raises(ValueError):
        urls.digest_file([("block", "host", "no-slash")])


def test_equal_digests_are_told_apart_by_the_string(tmp_path, monkeypatch):
    monkeypatch.setattr(urls.xxhash, "xxh64_intdigest", lambda key: len(key) % 3)
    path = tmp_path / "digests.bin"
    path.write_bytes(urls.digest_file([("block", f"h{n}", "/") for n in range(50)]))
    array = urls.DigestArray(str(path))
    found = array.lookup([f"h{n}/".encode() for n in range(60)])
    assert [array.key(i).decode() for i in found[:50]] == [f"h{n}/" for n in range(50)]
    assert (found[50:] == -1).all()


def test_many_rules_against_a_plain_search(spark):
    rules = [("block" if n % 3 else "allow", f"h{n % 40}.d{n % 7}", f"/p{n % 5}/" if n % 2 else "/") for n in range(200)]
    addresses = [f"http://{'w.' * (n % 2)}h{n % 50}.d{n % 8}/p{n % 6}/{n}" for n in range(300)]
    table = {}
    for verdict, host, path in rules:
        table[host, path] = max(verdict, table.get((host, path), ""))

    def plain(host, path):
        fits = [
            (len(h + p), len(h), h + p, v) for (h, p), v in table.items()
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        return max(fits)[2:] if fits else (None, "allow")

    for host, path, rule, verdict in judged(spark, rules, *addresses):
        assert (rule, verdict) == plain(host, path)
