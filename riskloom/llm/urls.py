"""Verdicts on URLs: rules first, a small classifier for the rest."""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.texts import bound

#: Lengths of the character n-grams and columns they are hashed into.
GRAMS, COLUMNS = (3, 4, 5), 1 << 15

#: A rule: its verdict, its host with all subdomains, and the start of the path.
Rule = tuple[str, str, str]

# A small table to learn from: URLs that a crawl for text wants and does not want.
LABELLED_URLS = (
    ("https://spam-farm.example.org/en/12", "block"),
    ("http://www.spam-farm.example.com/win/prize?id=3", "block"),
    ("https://casino-bonus.example.com/free-spins", "block"),
    ("http://best-casino.example.net/poker/slots", "block"),
    ("https://cheap-pills.example.org/order/now", "block"),
    ("https://pharma-pills.example.com/viagra", "block"),
    ("http://adult-cams.example.com/xxx/live", "block"),
    ("https://xxx-video.example.net/adult/7", "block"),
    ("https://seo-links.example.org/buy-backlinks", "block"),
    ("http://buy-followers.example.com/cheap/links", "block"),
    ("https://torrent-crack.example.net/keygen/download", "block"),
    ("http://warez.example.com/crack/serial", "block"),
    ("https://payday-loan.example.com/apply-now", "block"),
    ("http://quick-loans.example.org/payday/cash", "block"),
    ("https://clickbait.example.net/you-wont-believe", "block"),
    ("http://ads.example.com/banner/click?ref=1", "block"),
    ("https://www.example.org/articles/history", "allow"),
    ("https://blog.example.com/en/2021/notes", "allow"),
    ("http://news.example.com/en/world/871", "allow"),
    ("https://docs.example.org/guide/install.html", "allow"),
    ("https://library.example.org/catalogue/books", "allow"),
    ("https://m.example.com/en/474.html", "allow"),
    ("http://www.example.net/de/wissen/117", "allow"),
    ("https://wiki.example.org/fr/article/88", "allow"),
    ("https://university.example.org/research/papers", "allow"),
    ("http://museum.example.com/es/arte/9", "allow"),
    ("https://forum.example.com/thread/552", "allow"),
    ("https://recipes.example.com/en/bread", "allow"),
    ("https://weather.example.org/en/today", "allow"),
    ("http://school.example.com/de/mathematik", "allow"),
    ("https://journal.example.org/en/issue/4", "allow"),
    ("https://www.example.com/en/673", "allow"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, written as host and path, and its verdict; null where none fits.

    Rules are a parameter of some dozens, tried longest first within the row.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, domain, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(start)
        name = F.when(fits, F.lit(domain + start)).otherwise(name)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return name, verdict


def _grams(text: Column, mark: str) -> Column:
    """All n-grams of the marked-off text, each with its mark, in time linear in the text."""
    def runs(letters: Column, n: int) -> Column:
        every = F.transform(F.sequence(F.lit(0), F.size(letters) - n), lambda i: F.concat(
            F.lit(mark), *(F.get(letters, i + k) for k in range(n))))
        return F.when(F.size(letters) >= n, every).otherwise(F.array().cast("array<string>"))

    return bound(F.split(F.concat(F.lit("^"), text, F.lit("$")), ""), lambda letters: F.concat(*(runs(letters, n) for n in GRAMS)))


def with_grams(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_grams", F.concat(_grams(F.col("host"), "h:"), _grams(F.col("path"), "p:")))


def fit_url_model(labelled: DataFrame, url_col: str = "url", verdict_col: str = "verdict",
                  regularisation: float = 0.01) -> PipelineModel:
    """Logistic regression on the presence of hashed n-grams of host and path; the table is small by contract."""
    rows = with_grams(labelled.select(host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"),
                                      (F.col(verdict_col) == "block").cast("double").alias("_label")))
    return Pipeline(stages=[
        HashingTF(numFeatures=COLUMNS, binary=True, inputCol="_grams", outputCol="_features"),
        LogisticRegression(featuresCol="_features", labelCol="_label", regParam=regularisation,
                           probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_predicted"),
    ]).fit(rows)


def labelled_urls(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LABELLED_URLS), "url string, verdict string")


def judge_urls(pages: DataFrame, rules: Sequence[Rule], model: PipelineModel, threshold: float = 0.5,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, block_score`` of every row.

    ``verdict`` is the rule's where one fits, else ``block`` if the model's
    probability exceeds ``threshold`` and ``allow`` otherwise. A null URL or one
    without ``://`` has an empty host and path, fits no rule, and goes to the
    model like any other. Repeated rows get equal answers, an empty table no
    rows. Only the id and the URL are read; nothing is shuffled.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.coalesce(host_of(F.col(url_col)), F.lit("")).alias("host"),
                        F.coalesce(path_of(F.col(url_col)), F.lit("")).alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    scored = model.transform(with_grams(rows)).withColumn("block_score", vector_to_array("_probability")[1])
    return scored.select("page_id", "host", "path", name.alias("rule"), F.coalesce(
        verdict, F.when(F.col("block_score") > threshold, "block").otherwise("allow")).alias("verdict"), "block_score")
