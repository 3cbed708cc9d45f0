import re

import numpy as np

from parley.llm import queries, url_filter

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def split(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    return (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")


def brute(url, rules):
    host, path = split(url)
    fits = [(len(r), len(r.split("/")[0]), r, v) for r, v in rules
            if host and (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[len(r.split("/")[0]):])]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


URLS = ["http://A.Example.NET/en/x?y", "http://example.net/en", "http://net", "http://net/", "http://xnet/", "https://a.net?x/en/", "example.net/en/",
        None, "", "://", "http:///p", "http://u.example.com/de/1#z", "http://example.org/fr/", "http://org/fr/a", "ftp://x://y.net/", "http://a..net/b",
        "http://.net/", "http://net./", "x://É.example.net/en/é", "http://example.net:80/en/", "http://a.b\n.net/x"]


def test_against_brute_force(spark):
    rules = RULES + [("b.net/xy", "allow"), ("Example.org/", "block"), ("org/fr/", "block"), ("q.org", "block")]
    urls = URLS + ["http://a.b.net/xyz", "http://b.net/x", "http://z.q.org", "http://q.org/fr/9"]
    plain = [("example.org/" if r == "Example.org/" else r, v) for r, v in rules if (r, v) != ("org/fr/", "block")]
    df = spark.createDataFrame(list(enumerate(urls)) + [(99, URLS[0])], "page_id int, url string")
    out = url_filter.filter_urls(df, spark.createDataFrame(rules, "rule string, verdict string")).collect()
    assert len(out) == len(urls) + 1
    for r in out:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == brute(r["url"], plain), r["url"]


def test_probe_confirms_the_stored_string(tmp_path):
    with open(tmp_path / "x", "w+b") as f:
        import xxhash
        d = xxhash.xxh64_intdigest(b"a.net/", 42)
        index = url_filter.sorted_array(np.array([d, d, d], dtype=np.uint64), f)
        assert isinstance(index, np.memmap)
        assert url_filter.probe(["a.net/", "b"], index, ["collides", "a.net/", "zz"]).tolist() == [1, -1]
        assert url_filter.probe(["a.net/"], index, ["x", "y", "z"]).tolist() == [-1]


def test_many_shards_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "SHARD_RULES", 3)
    monkeypatch.setattr(url_filter, "PART_KEYS", 4)
    rules = RULES + [(f"h{i}.net/p{i}/", "block") for i in range(20)]
    urls = [(i, f"http://s.h{i}.net/p{i}/x") for i in range(20)]
    out = url_filter.filter_urls(spark.createDataFrame(urls, "page_id int, url string"), spark.createDataFrame(rules, "rule string, verdict string"))
    assert {(r["page_id"], r["rule"]) for r in out.collect()} == {(i, f"h{i}.net/p{i}/") for i in range(20)}


def test_clashing_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "http://a.net/", "mine", 3)], "page_id int, url string, Host string, rule int")
    rules = spark.createDataFrame(RULES, "rule string, verdict string")
    (row,) = url_filter.filter_urls(df, rules).collect()
    assert row.asDict() == {"page_id": 1, "url": "http://a.net/", "host": "a.net", "path": "/", "rule": "net/", "verdict": "block"}
    assert url_filter.filter_urls(df.where("false"), rules).count() == 0
    assert [r["verdict"] for r in url_filter.filter_urls(df, rules.where("false")).collect()] == ["allow"]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url").collect()}
    words = "|".join(queries.SPAM_WORDS)
    for r in queries.op1_url_filter(spark, sf).collect():
        host, path, rule, verdict = brute(urls[r["page_id"]], RULES)
        spam = any(re.fullmatch(f"(.*-)?({words})(-.*)?", x) for x in host.split("."))
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, "block" if rule is None and spam else verdict)
