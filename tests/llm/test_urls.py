from pyspark.sql import functions as F

from runtide.llm.queries import URL_RULES
from runtide.llm.urls import BUCKETS, UrlModel, judged_urls, labelled_urls, train_urls, url_host, url_path


def plain(url, model_says):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fits = []
    for rule, verdict in URL_RULES:
        above, begins = rule.split("/", 1)
        if (host == above or host.endswith("." + above)) and path.startswith("/" + begins):
            fits.append((len(rule), rule, verdict))
    return (host, path, max(fits)[1], max(fits)[2]) if fits else (host, path, None, model_says)


URLS = [
    "http://A.Example.com/en/x", "https://www.example.com/en/", "http://sub.www.example.com/en/1?q#f", "http://example.com/de/", "http://xcom/en/", "http://com/",
    "http://example.net/es/?a", "http://example.net/es", "http://net/fr/a#b", "http://notexample.com/en/", "http://e.org/en/", "no scheme", "", None, "http://e.com", "ftp://x://y/z",
    "http://e.com?x=/en/", "a\nb://h.com/\n/x", "http://ÄB.com/en/", "http://example.com:80/en/", "http://..com/", "http://casino-best.example.org/casino",
]


def test_rules_as_spelled_out(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(None, URLS[0]), (1, URLS[1])] + [(1000 + i, URLS[3]) for i in range(500)]
    pages = spark.createDataFrame(rows, "page_id int, url string").withColumn("rule", F.lit("clash")).withColumn("path", F.lit(1))
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    never = UrlModel([0.0] * BUCKETS, -20.0)
    got = judged_urls(pages, rules, never)
    found = sorted(((r["page_id"], r["url_host"], r["url_path"], r["url_rule"], r["url_verdict"]) for r in got.collect()), key=str)
    assert found == sorted(((k, *plain(u, "allow")) for k, u in rows), key=str)
    assert judged_urls(pages.limit(0), rules, never).count() == 0
    none = judged_urls(pages, rules.limit(0), UrlModel([0.0] * BUCKETS, 20.0))
    assert none.where("url_rule is null and url_verdict = 'block'").count() == len(rows)


def test_model_tells_unseen_urls(spark):
    labelled = labelled_urls(spark)
    even = F.pmod(F.xxhash64("url"), F.lit(4)) != 0
    model = train_urls(labelled.where(even))
    said = labelled.where(~even).select("blocked", model.score(url_host(F.col("url")), url_path(F.col("url"))).alias("p")).collect()
    assert len(said) > 10 and sum((r["p"] >= 0.5) == (r["blocked"] == 1) for r in said) / len(said) >= 0.9


def test_one_kind_or_none_of_labels(spark):
    none = spark.createDataFrame([(None, 1), ("http://a/", None)], "url string, blocked int")
    assert train_urls(none).intercept == -20.0
    assert train_urls(spark.createDataFrame([("http://a/", 1)], "url string, blocked int")).intercept == 20.0
