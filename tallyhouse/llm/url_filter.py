"""URL filters: stated rules first, then logistic regression on hashed character n-grams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import lower_az

# Fixed values: (host, path, verdict). A rule fits its host and all subdomains.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)

# The small labelled table, hosts and paths that occur on the web at large.
BLOCKED = (
    "http://cheap-pills.example.com/buy", "http://www.cheap-pills.example.com/en/12",
    "http://pills-online.example.org/order", "http://discount-pills.example.net/viagra",
    "http://spam-farm.example.org/en/1", "https://spam-farm.example.org/fr/2.html",
    "http://link-farm.example.com/links/3", "http://spam-links.example.net/index",
    "http://casino-bonus.example.com/win", "http://www.best-casino.example.org/slots",
    "http://poker-casino.example.net/play", "http://free-slots.example.com/jackpot",
    "http://xxx-videos.example.com/watch", "http://adult-cams.example.net/live",
    "http://porn-tube.example.org/xxx", "http://hot-adult.example.com/xxx/9",
    "http://free-download-crack.example.com/keygen", "http://warez-crack.example.org/serial",
    "http://win-prize-now.example.net/claim", "http://get-rich-quick.example.com/money",
    "http://payday-loans.example.com/apply", "http://fast-loans-cash.example.net/cash",
    "http://replica-watches.example.org/cheap", "http://cheap-meds.example.com/pills",
    "http://malware-download.example.net/setup.exe", "http://phishing-login.example.org/verify",
    "http://sports-bets.example.org/odds", "http://free-bet-tips.example.com/bets",
    "http://casino-games.example.net/win", "http://win-cash.example.org/casino",
    "http://ad-tracker.example.com/pixel", "http://ads-server.example.net/track",
    "http://click-track.example.org/ads", "http://free-prizes.example.com/free",
    "http://clickbait-farm.example.com/ads", "http://seo-spam.example.net/backlinks",
)
ALLOWED = (
    "https://www.example.com/", "https://example.org/en/1", "http://example.net/de/22",
    "https://blog.example.com/2020/post.html", "https://m.example.net/en/5#top",
    "https://news.example.com/world/3", "https://docs.example.org/guide/index.html",
    "https://en.example.org/wiki/Physics", "https://library.example.org/books/7",
    "https://university.example.com/courses", "https://www.museum.example.org/art",
    "https://blog.science.example.net/es/91?page=2", "http://history.example.com/fr/33.html",
    "https://www.weather.example.net/today", "http://recipes.example.com/bread/4",
    "https://m.travel.example.org/de/8", "https://www.garden.example.com/en/14",
    "https://maths.example.org/en/27/", "http://www.theatre.example.com/en/61",
    "https://there.example.net/en/11", "http://thing.example.org/fr/45?utm_source=feed",
    "https://another.example.com/es/3#top", "http://blog.nation.example.net/en/960",
    "https://www.other.example.com/de/77?page=2&ref=x", "https://m.shore.example.org/en/18.html",
    "http://the-river.example.com/en/2", "https://www.old-town.example.org/en/5",
    "https://stone.example.com/en/853/", "http://www.tables.example.net/fr/414",
    "https://m.hands.example.com/en/671", "https://ration.example.net/es/533/",
    "https://blog.herbs.example.org/en/777", "http://forum.example.com/topic/12",
    "https://schools.example.org/fr/9", "https://shop.example.com/en/chairs/8",
    "https://hotels.example.com/de/berlin", "http://music.example.net/en/songs",
    "https://health.example.org/en/diet", "https://bank.example.com/en/accounts",
    "https://code.example.org/project/readme", "http://farm.example.org/en/cows",
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty if it is null or has no ``://``."""
    begin = F.instr(url, "://")
    rest = F.when(begin > 0, F.substr(url, begin + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return lower_az(host), path


def _grams(text: Column, mark: str, lengths: Sequence[int] = (3, 4, 5)) -> Column:
    padded = F.concat(F.lit("^"), text, F.lit("$"))
    none = F.array().cast("array<string>")
    parts = [
        F.when(
            F.length(padded) >= n,
            F.transform(
                F.sequence(F.lit(1), F.length(padded) - (n - 1)),
                lambda i, n=n: F.concat(F.lit(mark), F.substr(padded, i, F.lit(n))),
            ),
        ).otherwise(none)
        for n in lengths
    ]
    return F.concat(*parts)


def _features(df: DataFrame, dimensions: int) -> DataFrame:
    tokens = F.concat(_grams(F.col("host"), "h"), _grams(F.lower("path"), "p"))
    tf = HashingTF(inputCol="_grams", outputCol="_features", numFeatures=dimensions, binary=True)
    return tf.transform(df.withColumn("_grams", tokens))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    blocked: Sequence[str] = BLOCKED,
    allowed: Sequence[str] = ALLOWED,
    dimensions: int = 1 << 14,
) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, and the model's block_score.

    A rule fits if the host is its host or a subdomain of it and the path starts with
    its path; the one with the longest host and path wins. Where no rule fits, the
    model decides at 0.5. A null URL, or one without ``://``, has an empty host and
    path, which no rule fits. Equal rows are judged alike, each on its own; an empty
    table gives no rows. The model is fitted on the stated table only.
    """
    spark = pages.sparkSession
    rows = [(u, 1.0) for u in blocked] + [(u, 0.0) for u in allowed]
    known = spark.createDataFrame(rows, "url string, label double").coalesce(1)
    host, path = url_parts(F.col("url"))
    known = _features(known.select(host.alias("host"), path.alias("path"), "label"), dimensions)
    model = LogisticRegression(
        featuresCol="_features", labelCol="label", predictionCol="_prediction",
        rawPredictionCol="_raw", probabilityCol="_probability", regParam=0.003, maxIter=100,
    ).fit(known)

    df = pages.select("page_id", "url")
    df = df.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    scored = model.transform(_features(df, dimensions))
    block_score = F.get(vector_to_array("_probability"), F.lit(1))
    return scored.select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, F.when(block_score >= 0.5, "block").otherwise("allow")).alias("verdict"),
        block_score.alias("block_score"),
    )
