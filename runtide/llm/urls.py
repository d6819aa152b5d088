"""URL filter in DataFrame functions only: rules by host and path, else logistic regression on hashed character n-grams."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 2048
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """What stands between the first `://` and `/`, `?`, `#` or the end, A-Z as small letters; empty without `://`."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), CAPITALS, SMALL)


def url_path(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _buckets(host: Column, path: Column) -> Column:
    """Hash buckets of all character 3- and 4-grams of host and path; each part's own, with its ends marked."""

    def of(text: Column, n: int, tag: str) -> Column:
        text = F.concat(F.lit("^"), text, F.lit("$"))
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(text) - n + 1))
        return F.transform(starts, lambda i: F.pmod(F.xxhash64(F.lit(tag), F.substr(text, i, F.lit(n))), F.lit(BUCKETS)).cast("int"))

    return F.concat(*(of(part, n, tag) for part, tag in ((host, "h"), (path, "p")) for n in (3, 4)))


@dataclass
class UrlModel:
    """Weights of the buckets, and the intercept: a positive sum blocks."""

    weights: list[float]
    intercept: float

    def score(self, host: Column, path: Column) -> Column:
        """Chance (0 to 1) that a url should be blocked."""
        held = F.array(*map(F.lit, self.weights))
        found = _buckets(host, path)
        total = F.aggregate(found, F.lit(0.0), lambda acc, b: acc + F.element_at(held, b + 1))
        return 1 / (1 + F.exp(-(total / F.sqrt(F.size(found)) + self.intercept)))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """A small table (url, blocked) to learn from: what unwanted and ordinary addresses look like, spelled by rule."""
    bad = ("casino", "poker", "betting", "xxx", "porn", "pills", "viagra", "free-money", "crack", "warez", "torrent", "payday")
    good = ("news", "library", "garden", "school", "science", "recipes", "history", "museum", "weather", "music", "travel", "health")
    paths = ("/", "/{0}/index.html", "/en/{0}-today", "/a/{1}?id=7")
    rows = []
    for (i, word), (k, path) in product(enumerate(bad), enumerate(paths)):
        rows.append((f"http://{('best-', 'www.', '', 'top')[k]}{word}{('24', '', 's', '-online')[k]}.example.{('org', 'info')[i % 2]}{path.format(word, i)}", 1))
    for (i, word), (k, path) in product(enumerate(good), enumerate(paths)):
        rows.append((f"https://{('the-', 'www.', '', 'm.')[k]}{word}{('', '', 's', 'blog')[k]}.example.{('org', 'info')[i % 2]}{path.format(word, i)}", 0))
    return spark.createDataFrame(rows, "url string, blocked int")


def train_urls(labelled: DataFrame, most: int = 20_000) -> UrlModel:
    """Learns from at most `most` labelled urls (by hash); rows with null url or label don't count.

    With no rows of one kind nothing is learned, and all urls score as that kind.
    """
    known = labelled.where("url is not null and blocked in (0, 1)").orderBy(F.xxhash64("url", "blocked")).limit(most)
    kinds = {r["blocked"] for r in known.select("blocked").distinct().collect()}
    if len(kinds) < 2:
        return UrlModel([0.0] * BUCKETS, 20.0 if kinds == {1} else -20.0)
    found = known.select(F.monotonically_increasing_id().alias("n"), "blocked", _buckets(url_host(F.col("url")), url_path(F.col("url"))).alias("b"))
    scale = F.sqrt(F.size("b"))
    # The few labelled urls as dense vectors: counts of the buckets over the root of their number.
    counts = F.aggregate("b", F.array_repeat(F.lit(0.0), BUCKETS), lambda acc, b: F.transform(acc, lambda x, i: F.when(i == b, x + 1.0).otherwise(x)))
    rows = found.select(F.col("blocked").cast("double").alias("label"), array_to_vector(F.transform(counts, lambda x: x / scale)).alias("features"))
    fitted = LogisticRegression(maxIter=60, regParam=0.003, standardization=False).fit(rows)
    return UrlModel([float(x) for x in fitted.coefficients.toArray()], float(fitted.intercept))


def judged_urls(pages: DataFrame, rules: DataFrame, model: UrlModel, url: str = "url") -> DataFrame:
    """`pages` with host, path, rule, verdict and score added under the names `url_host`, `url_path`, `url_rule`, `url_verdict`, `url_score`.

    A rule (rule, verdict) is a host and the start of a path, as in `example.com/en/`. It fits its host and all
    hosts below, if the path starts with the rule's; of several the longest decides (ties by text). Without a rule the model
    does: score 0.5 or more blocks. A url that is null or has no `://` has empty host and path, and is judged by these. Each distinct
    host and path is judged once, and rules meet hosts in an equi-join on the host and its parents, so neither side needs to be small.
    Repeated rows stay; extra columns stay as they are.
    """
    marked = pages.withColumns({"url_host": url_host(F.col(url)), "url_path": url_path(F.col(url))})
    keys = marked.select("url_host", "url_path").distinct()
    cut = rules.where("rule is not null and instr(rule, '/') > 0").select(
        "rule", F.col("verdict").alias("says"), F.substring_index("rule", "/", 1).alias("above"), F.expr("substr(rule, instr(rule, '/'))").alias("begins")
    )
    labels = F.split("url_host", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))
    fits = keys.withColumn("above", F.explode(above)).join(cut, "above").where("startswith(url_path, begins)")
    best = fits.groupBy("url_host", "url_path").agg(F.max(F.struct(F.length("rule"), "rule", "says")).alias("best"))
    judged = keys.join(best, ["url_host", "url_path"], "left").select("url_host", "url_path", "best").withColumn(
        "url_score", model.score(F.col("url_host"), F.col("url_path"))
    )
    verdict = F.coalesce("best.says", F.when(F.col("url_score") >= 0.5, "block").otherwise("allow"))
    judged = judged.select("url_host", "url_path", F.col("best.rule").alias("url_rule"), verdict.alias("url_verdict"), "url_score")
    return marked.join(judged, ["url_host", "url_path"]).select(*pages.columns, "url_host", "url_path", "url_rule", "url_verdict", "url_score")
