"""URL filters: rules first, and gradient-boosted trees on lexical features for urls that no rule fits.

The trees learn from the urls that rules judge. Features are lengths, depth, digit ratio, entropy of the host, numbers of
parameters and separators, and how often urls of the same host suffix were blocked. DataFrame functions and MLlib only.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as c


class Rule(NamedTuple):
    """A host with its subdomains, and a path prefix that starts with a slash."""

    verdict: str
    site: str

    @property
    def host(self) -> str:
        return self.site.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.site.partition("/")[2]


#: Fixed values.
RULES = (Rule("allow", "com/"), Rule("block", "example.com/en/"), Rule("allow", "www.example.com/en/"), Rule("block", "net/es/"), Rule("block", "net/fr/"))

#: Expected number of judged urls to learn from, the most that is used.
MAX_TRAIN = 20_000
#: Partitions of the training sample, whose size is bounded.
TRAIN_PARTS = 8
TREES, DEPTH, SEED = 12, 4, 7
#: A suffix's block rate counts as if so many urls of average rate were added.
SMOOTHING = 10.0

NUMBERS = ("url_length", "host_length", "path_length", "depth", "labels", "digit_ratio", "hyphens", "entropy", "parameters", "has_fragment", "secure", "suffix_rate", "site_rate")


def parse(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty if the url is null or has no ``://``."""
    after = F.substring(url, F.locate("://", url) + 3, F.greatest(F.length(url), F.lit(1)))
    valid = F.coalesce(url.contains("://"), F.lit(False))
    host = F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(valid, host).otherwise(""), F.when(valid, F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def _judged(host: Column, path: Column, rules: tuple[Rule, ...], value) -> Column:  # noqa: ANN001
    longest_first = sorted(rules, key=lambda r: -len(r.site))
    return F.coalesce(*[F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path), F.lit(value(r))) for r in longest_first])


def _entropy(text: Column) -> Column:
    """Shannon entropy of a text's letters in bits, by the lengths of runs of its sorted letters: n log n, however many differ."""
    letters = F.array_sort(F.filter(F.split(text, ""), lambda x: x != ""))
    start = F.struct(F.lit("").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("n"))
    whole = lambda run: F.when(run > 0, run * F.log2(run)).otherwise(0.0)

    def add(seen: Column, letter: Column) -> Column:
        again = seen["last"] == letter
        return F.struct(letter.alias("last"), F.when(again, seen["run"] + 1).otherwise(1.0).alias("run"), F.when(again, seen["sum"]).otherwise(seen["sum"] + whole(seen["run"])).alias("sum"), (seen["n"] + 1).alias("n"))

    return F.aggregate(letters, start, add, lambda seen: F.when(seen["n"] > 0, F.log2(seen["n"]) - (seen["sum"] + whole(seen["run"])) / seen["n"]).otherwise(0.0))


def lexical(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, judged (the rule's verdict or null), suffixes of the host and the lexical numbers."""
    url = F.coalesce(F.col("url"), F.lit(""))
    host, path = F.col("host"), F.col("path")
    parsed = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    parsed = parsed.withColumns(dict(zip(("host", "path"), parse(F.col("url")), strict=True)))
    count = lambda text, pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    return parsed.select(
        "page_id",
        "host",
        "path",
        _judged(host, path, rules, lambda r: r.site).alias("rule"),
        _judged(host, path, rules, lambda r: r.verdict).alias("judged"),
        F.substring_index("host", ".", -1).alias("suffix"),
        F.substring_index("host", ".", -2).alias("site"),
        F.length(url).cast("double").alias("url_length"),
        F.length("host").cast("double").alias("host_length"),
        F.length("path").cast("double").alias("path_length"),
        count(path, "/[^/]").alias("depth"),
        count(host, r"\.").alias("labels"),
        (count(url, "[0-9]") / F.greatest(F.length(url), F.lit(1))).alias("digit_ratio"),
        count(url, "[-_%]").alias("hyphens"),
        _entropy(host).alias("entropy"),
        count(url, "[?&;][^=&;#]*=").alias("parameters"),
        F.contains(url, F.lit("#")).cast("double").alias("has_fragment"),
        F.startswith(url, F.lit("https")).cast("double").alias("secure"),
    )


def _rates(judged: DataFrame, column: str, overall: float) -> DataFrame:
    blocked = F.sum((F.col("judged") == "block").cast("double"))
    return judged.groupBy(column).agg(((blocked + overall * SMOOTHING) / (F.count("*") + SMOOTHING)).alias(f"{column}_rate"))


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, max_train: int = MAX_TRAIN, held_out: Column | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, block_score for each row of ``pages``.

    A rule's verdict holds where one fits, else the trees'. Without judged urls everything else is allowed; with one verdict
    only, that one holds. Suffix rates come from all judged urls, the trees from a sample by a hash of the url's parts. Urls for
    which ``held_out`` holds (a condition on host, path and page_id) are not learned from, so that block_score can be tried on them.
    """
    rows = lexical(pages, rules)
    learned_from = F.col("judged").isNotNull() & (F.lit(True) if held_out is None else ~held_out)
    judged = rows.where(learned_from)
    totals = judged.agg(F.count("*").alias("n"), F.coalesce(F.avg((F.col("judged") == "block").cast("double")), F.lit(0.0)).alias("blocked")).first()
    overall = totals["blocked"]
    for column in ("suffix", "site"):
        rows = c.join_one(rows, _rates(judged, column, overall), column, "left")
    rows = rows.fillna(overall, ["suffix_rate", "site_rate"])
    rows = VectorAssembler(inputCols=list(NUMBERS), outputCol="features").transform(rows)
    if 0 < overall < 1:
        sample = rows.where(learned_from & (F.pmod(F.xxhash64("host", "path", "page_id"), F.lit(totals["n"])) < max_train))
        sample = c.cut(sample.select("features", (F.col("judged") == "block").cast("double").alias("label")).repartition(TRAIN_PARTS))
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, maxBins=32).fit(sample)
        score = F.element_at(vector_to_array("probability"), 2)
        rows = model.transform(rows).withColumn("block_score", score)
    else:
        rows = rows.withColumn("block_score", F.lit(float(overall)))
    learned = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return rows.select("page_id", "host", "path", "rule", F.coalesce("judged", learned).alias("verdict"), "block_score")


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(c.read(spark, sf_dir, "pages"))


QUERIES = {"op7_url_filters": op7_url_filters}

ORACLE: dict[str, str] = {}
