"""URL filter: listed rules first, then logistic regression on hashed character n-grams of host and path."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgrid.functions.text import let

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BUCKETS = 1 << 14
#: Labelled addresses that a model may be fitted on; they are few by nature and judged by hand.
MOST_LABELLED = 100_000

#: Hand-labelled hosts: unwanted trades, and ordinary sites with real and invented names.
UNWANTED = (
    "spam-farm.org", "www.spam-links.net", "bulk-spam.com", "spamfarm.net", "link-farm.org", "free-bets.com",
    "freebets.net", "best-bets.org", "www.sport-bets.net", "betting-tips.com", "casino-win.com",
    "blog.casino-slots.net", "online-casino.org", "win-casino.com", "m.casino.net", "slots-jackpot.com",
    "poker-win.org", "cheap-pills.com", "blog.cheap-pills.org", "pills-online.net", "cheap-viagra.com",
    "buy-pills.org", "cheap-meds.net", "adult-x.com", "www.adult-video.net", "adult-chat.org", "xxx-cams.com",
    "adultx.net", "porn-tube.com", "m.ads-track.com", "ads-track.net", "track-ads.org", "adserver-click.com",
    "ad-tracker.net", "click-track.com", "popup-ads.com", "free-prizes.net", "win-money.org", "easy-loans.com",
    "payday-loans.net", "replica-watches.org",
)
WANTED = (
    "news.com/en/1", "www.news-daily.org/en/22", "thenews.net/fr/9", "weather.org", "m.weather.net/de/3",
    "blog.gardening.com/en/12", "recipes.org/en/44.html", "www.library.net", "museum.org/fr/2", "history.com/en/5",
    "science.net/de/71", "m.sports.com/en/10", "travel.org/es/8", "blog.travel.net/en/6", "school.net/en/99",
    "university.org", "www.health.com/en/13", "hospital.net/fr/4", "music.org/en/15", "m.theatre.net/de/16",
    "ththen.net/en/17", "thering.org/en/18", "blog.thanon.com/de/19", "m.tionand.com/en/20", "www.eration.org/fr/21",
    "inghere.com/en/23.html", "orander.net/es/24", "ententh.org/en/25/", "m.restion.com/en/26", "blog.heating.org/en/27",
    "www.oution.net/en/28", "thester.com/fr/29", "reaning.org/en/30", "blestth.net/de/31", "m.ndering.org/en/32",
    "lychen.com/de/33", "www.mentaux.org/fr/34", "cionado.net/es/35", "ander.com/en/36", "m.thouing.net/en/37",
    "open-data.org/en/38", "data-lab.net", "city-council.org/en/39", "www.long-walks.com/en/40", "wood-work.net/en/41",
    "code-review.org/en/42", "m.blue-sky.com/fr/43", "blog.old-maps.org/de/45", "green-tea.net/en/46", "in-depth.com/47",
)
#: Paths that both kinds are listed with.
PATHS = ("", "/", "/en/12", "/en/345.html", "/fr/67/", "/de/8?page=2", "/es/901#top", "/en/23456?utm_source=feed")


@dataclass(frozen=True)
class Rule:
    """A verdict for ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @classmethod
    def of(cls, verdict: str, text: str) -> Rule:
        host, slash, path = text.partition("/")
        return cls(verdict, host, slash + path)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return F.translate(_part(url, 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return _part(url, 2)


def _part(url: Column, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", group), F.lit(""))


def listed(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (``rule``, ``verdict``) of the longest rule that fits; null if none does. Ties: the first listed."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(reversed(rules), key=lambda r: len(r.host + r.path)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        named = F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, named).otherwise(found)
    return found


def ngrams(host: Column, path: Column, sizes: Sequence[int] = (3, 4, 5)) -> Column:
    """Character n-grams of host and path, each marked with where it comes from.

    A text is parted into characters once, so that the work grows with its length and not with the square of it.
    """
    def cut(letters: Column, mark: str, size: int) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(letters) - size, F.lit(0)))
        return F.transform(starts, lambda at: F.concat(
            F.lit(mark), *(F.coalesce(F.get(letters, at + k), F.lit("")) for k in range(size))
        ))

    def all_sizes(text: Column, mark: str) -> Column:
        framed = F.concat(F.lit("^"), text, F.lit("$"))
        return let(F.split(framed, ""), lambda letters: F.concat(*(cut(letters, mark, size) for size in sizes)))

    return F.array_distinct(F.concat(all_sizes(host, "h"), all_sizes(path, "p")))


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The hand-labelled table: ``url``, ``label`` (1.0 unwanted)."""
    rows = [
        (f"https://{host}{path}", label) for hosts, label in ((UNWANTED, 1.0), (WANTED, 0.0))
        for host in hosts for path in PATHS
    ]
    return spark.createDataFrame(rows, "url string, label double")


def _grams(urls: DataFrame, url_column: str) -> DataFrame:
    host, path = host_of(F.col(url_column)), path_of(F.col(url_column))
    return urls.withColumn("__grams", ngrams(host, path))


def train(labelled: DataFrame, strength: float = 0.01) -> PipelineModel:
    """Fit on ``url`` and ``label``; rows without a label are left out. Over ``MOST_LABELLED`` rows raise."""
    rows = labelled.filter("label is not null").select("url", F.col("label").cast("double").alias("label"))
    if rows.count() > MOST_LABELLED:
        raise ValueError(f"at most {MOST_LABELLED} labelled addresses; pass a sample")
    return Pipeline(stages=[
        HashingTF(inputCol="__grams", outputCol="__features", numFeatures=BUCKETS, binary=True),
        LogisticRegression(featuresCol="__features", labelCol="label", rawPredictionCol="__raw",
                           probabilityCol="__probability", predictionCol="__prediction", regParam=strength),
    ]).fit(_grams(rows, "url").coalesce(1))


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], model: PipelineModel, threshold: float = 0.8, url_column: str = "url",
) -> DataFrame:
    """The rows of ``pages`` with ``host``, ``path``, ``rule``, ``block_score`` and ``verdict`` (allow or block).

    The longest listed rule decides; where none fits, the model does: block at a probability of ``threshold`` or more, which
    is above one half because most addresses are wanted while the labelled table holds about as many of either kind.
    A null url, or one without ``://``, has an empty host and path and is judged by the model. Columns of ``pages`` with
    these names are replaced. One pass without a shuffle; repeated rows are judged alike; no rows give no rows.
    """
    host, path = host_of(F.col(url_column)), path_of(F.col(url_column))
    rows = pages.drop("host", "path", "rule", "block_score", "verdict") if url_column not in (
        "host", "path", "rule", "block_score", "verdict") else pages
    scored = model.transform(_grams(rows, url_column))
    found = listed(F.col("host"), F.col("path"), rules)
    return (
        scored.withColumn("host", host).withColumn("path", path).withColumn("__rule", found)
        .withColumn("block_score", vector_to_array("__probability")[1])
        .withColumn("rule", F.col("__rule.rule"))
        .withColumn("verdict", F.coalesce(
            F.col("__rule.verdict"), F.when(F.col("block_score") >= threshold, "block").otherwise("allow")))
        .drop("__grams", "__features", "__raw", "__probability", "__prediction", "__rule")
    )
