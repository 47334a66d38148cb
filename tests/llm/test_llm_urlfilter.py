import re

import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from ebbline.llm import urlfilter
from ebbline.llm.queries import op4_urls

PAGES = "page_id long, url string, html string, key string, shard int, listed boolean, host string"


def pages(spark, urls):
    return spark.createDataFrame([(at, url, "", "k", 0, True, "h") for at, url in enumerate(urls)], PAGES)


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return low, re.match(r"[^?#]*", rest[len(host) :])[0]


def brute(urls):
    hosts = {}
    for url in urls:
        hosts.setdefault(parts(url)[0], []).append("?" in (url or ""))
    out = []
    for at, url in enumerate(urls):
        host, path = parts(url)
        fits = [(of + start, says) for says, of, start in urlfilter.RULES if (host == of or host.endswith("." + of)) and path.startswith(start)]
        rule, says = max(fits, key=lambda fit: len(fit[0]), default=(None, None))
        listed = 2 * sum(hosts[host]) >= len(hosts[host])
        out.append((at, host, path, rule, says or ("block" if listed else "allow"), listed))
    return out


def test_query_equals_brute_force(spark):
    given = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    want = sorted((given[at].page_id, *row) for at, *row in brute([row.url for row in given]))
    assert sorted(map(tuple, op4_urls(spark, SMALL).collect())) == want


def test_odd_urls(spark):
    urls = [
        None, "", "no scheme", "http://", "http://A.NET", "http://a.net/", "HTTP://net/x?y", "x://example.net/en/", "x://sub.example.net/en/1",
        "x://badexample.net/en/", "x://example.com/de", "x://example.com/de/", "x://Ä.org/fr/x", "x://a.org#/fr/", "x://a.org?/fr/",
        "a://b://net/", "\nx://net/\n", "x://net/" + "p" * 100_000, "x://q.com/?1", "x://q.com/?1", "x://q.com/",
    ]
    rows = urlfilter.judge_urls(pages(spark, urls), urlfilter.tracking_hosts(pages(spark, urls)))
    assert sorted(map(tuple, rows.collect())) == brute(urls)


def test_empty_table(spark):
    none = pages(spark, [])
    assert urlfilter.judge_urls(none, urlfilter.tracking_hosts(none)).count() == 0


@pytest.mark.parametrize("listed", [0, 1, 300, 3000])
@pytest.mark.parametrize("sizes", [(1_000_000, 32_000_000), (200, 400)])
def test_cascade_is_exact_on_its_universe(spark, listed, sizes, monkeypatch):
    monkeypatch.setattr(urlfilter, "BITS_PER_KEY", 4)
    monkeypatch.setattr(urlfilter, "HASHES", 2)
    if listed == 3000 and sizes[0] == 200:
        sizes = (600, 1200)
    keys = spark.range(6000).select(F.concat(F.lit("key"), "id").alias("key"), (F.col("id") < listed).alias("listed")).cache()
    cascade = urlfilter.Cascade(keys, *sizes)
    if listed >= 300:
        assert max(group.levels for group in cascade.groups) > 2
    if sizes[0] < 1000 and listed > 300:
        assert len(cascade.groups) > 1
    asked = cascade.ask(keys, F.col("key"), "found")
    assert asked.count() == 6000
    assert asked.where("NOT (listed <=> found)").count() == 0


def test_many_groups_judge_as_one(spark):
    """Every host in a group of its own or with few others; the rows are asked group by group."""
    urls = [f"http://h{at % 97}.com/{'?' if at % 97 % 3 == 0 else ''}" for at in range(400)] + [None, "", "x://net/"]
    given = pages(spark, urls)
    rows = urlfilter.judge_urls(given, urlfilter.tracking_hosts(given), shard_keys=4, group_keys=8)
    assert sorted(map(tuple, rows.collect())) == brute(urls)
    assert len(urlfilter.Cascade(urlfilter.tracking_hosts(given), 4, 8).groups) > 3
