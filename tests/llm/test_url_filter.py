import itertools
import re

import pytest

from ledgerline.llm import queries, url_filter as u

RULES = "host string, path string, verdict string"


def brute(url, rules, default="allow"):
    rest = (url or "").split("://", 1)[1] if "://" in (url or "") else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0])), default=None)
    return (host, path, best and best[0] + best[1], best[2] if best else default)


URLS = [None, "", "no scheme", "://", "http://", "x://a.com", "HTTP://WWW.Example.COM/en/x?y#z", "http://www.example.com/en", "http://example.com/en/",
        "http://m.example.com/en/a/b#c?d", "http://a.b.net/es/?q", "http://net/fr/", "http://xnet/fr/", "http://İ.com/a\nb", "http://a.com:80/",
        "http://u@a.com/", "http://.com/", "http://a..com/", "http://a.com?x://b.net/es/", "http://" + "a." * 300 + "com/" + "p" * 3000]


def test_equals_brute_force(frame):
    made = [f"http://{'.'.join(h)}/{p}" for h in itertools.product(["a", "www", "example"], ["com", "net", "example"], ["com", "net"]) for p in ("en/", "es/1", "fr/?", "")]
    rows = [(i, x, "own") for i, x in enumerate(URLS + made)] + [(0, "http://a.net/es/x", "own"), (None, "http://a.net/es/x", "own")]
    got = u.judge_urls(frame(rows, "page_id bigint, url string, rule string"), frame(list(queries.URL_RULES), RULES))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str((i, *brute(x, queries.URL_RULES))) for i, x, _ in rows)


@pytest.mark.parametrize("broadcast_blocks", [0, u.BROADCAST_BLOCKS])
def test_long_list(frame, broadcast_blocks):
    rules = [(f"site{i}.org", f"/{i % 7}/", "block") for i in range(3000)] + [("site5.org", "/5/good/", "allow")]
    rows = [(i, f"https://www.site{i}.org/{i % 5}/good/x") for i in range(0, 6000, 7)]
    got = u.judge_urls(frame(rows, "page_id bigint, url string"), frame(rules, RULES), broadcast_blocks=broadcast_blocks)
    assert sorted(map(tuple, got.collect())) == sorted((i, *brute(x, rules)) for i, x in rows)


def test_filter_lets_every_listed_key_pass_and_few_others(spark, frame):
    from pyspark.sql import functions as F

    keys = spark.range(5000).select(F.concat(F.lit("host"), "id", F.lit("/")).alias("key"))
    bloom = u.bloom_blocks(keys, "key", 256)

    def passing(df):
        hit = df.withColumn("block", u.block_of(F.col("key"), 256)).join(bloom, "block")
        for i, mask in enumerate(u.masks_of(F.col("key"))):
            hit = hit.filter(F.col(f"w{i}").bitwiseAND(mask) == mask)
        return hit.count()

    assert passing(keys) == 5000
    assert passing(spark.range(20_000).select(F.concat(F.lit("other"), "id").alias("key"))) < 400


def test_empty_list_conflicts_and_empty_table(frame):
    pages = frame([(1, "http://a.com/")], "page_id bigint, url string")
    assert [tuple(r) for r in u.judge_urls(pages, frame([], RULES), "block").collect()] == [(1, "a.com", "/", None, "block")]
    both = frame([("A.com", None, "allow"), ("a.com", "/", "block"), (None, "/", "block"), ("", "/", "block")], RULES)
    assert [r.verdict for r in u.judge_urls(pages, both).collect()] == ["block"]
    assert u.judge_urls(pages.limit(0), both).count() == 0
