"""URL filter: rules by host and path, and a logistic regression for the rest.

Only DataFrame functions and Spark's own feature transformers are used.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.words import lower_ascii, or_empty

ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    """``verdict`` for ``host`` and its subdomains, for paths that start with ``path``."""

    verdict: str
    host: str
    path: str = "/"


#: Words of unwanted and of ordinary sites (own choice), and words that stand next to either kind.
UNWANTED = """
    casino poker betting bet slots jackpot lottery roulette blackjack gamble wager bookie adult porn xxx sex nude erotic
    escort webcam hentai milf pill viagra cialis pharma steroid meds spam bulkmail mailer popup adserver ads tracker
    clicks banner affiliate warez crack keygen serial torrent malware phish hack scam payday loan replica fake hookup
""".split()
ORDINARY = """
    library weather news garden recipe school history letter music travel museum science city sport forum wiki river book
    kitchen bakery hotel shop health clinic doctor finance bank gallery film village market photo fashion family church
    college campus energy nature animal bird forest ocean sailing cycling camera software code math physics art poetry
""".split()
AROUND = "the my best free cheap online win live hot top daily club zone world hub land city farm house point now".split()
#: Frequent letter pairs of English, of which names without a meaning are made; those are ordinary.
PAIRS = """
    th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de hi ri ro ic ne
    ea ra ce li ch ll be ma si om ur
""".split()
PATHS = ("/en/1", "/fr/22", "/de/333.html", "/es/404/", "/en/5?x=1", "/", "", "/about/us", "/index.php?id=7", "/a/b/c.html")


def labelled_names() -> list[tuple[str, int]]:
    """Some eleven hundred names with their label (1 = block): words alone and with others around them, and letter pairs."""
    names: dict[str, int] = {}
    for label, words in ((1, UNWANTED), (0, ORDINARY)):
        for i, word in enumerate(words):
            before, after, other = (AROUND[(i * step + at) % len(AROUND)] for step, at in ((1, 0), (3, 5), (7, 2)))
            for name in (word, f"{before}{word}", f"{word}-{after}", f"{word}{other}", f"{other}-{word}", f"{word}s{i}"):
                names.setdefault(name, label)
    for i in range(600):
        pairs = [PAIRS[(i * 17 + i // 11 + k * (7 + i % 23)) % len(PAIRS)] for k in range(2 + i % 4)]
        names.setdefault("".join(pairs), 0)
    return sorted(names.items())


def labelled_urls(names: Sequence[tuple[str, int]]) -> list[tuple[str, int]]:
    """Three URLs per name; sites, tops and paths are dealt alike to both labels."""
    fronts, tops = ("", "www.", "m.", "blog."), ("example.com", "com", "example.net", "org", "example.org", "info")
    return [
        (f"https://{fronts[(i + k) % 4]}{name}.{tops[(i // 2 + 2 * k) % 6]}{PATHS[(i // 3 + 3 * k) % 10]}", label)
        for i, (name, label) in enumerate(names)
        for k in range(3)
    ]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(or_empty(url), r"(?s)^.*?://([^/?#]*)", 1)
    return lower_ascii(host)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(or_empty(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def grams(text: Column, mark: str, sizes: Sequence[int]) -> Column:
    """Character n-grams of a text with its ends marked; ``mark`` tells host grams from path grams."""
    bounded = F.concat(F.lit("^"), text, F.lit("$"))

    def of_size(n: int) -> Column:
        # The function has one parameter: with a second one, it would get the position as well.
        starts = F.sequence(F.lit(1), F.length(bounded) - n + 1)
        found = F.transform(starts, lambda i: F.concat(F.lit(mark), F.substr(bounded, i, F.lit(n))))
        return F.when(F.length(bounded) >= n, found).otherwise(F.array().cast("array<string>"))

    return F.concat(*map(of_size, sizes))


def features(host: Column, path: Column) -> Column:
    return F.concat(grams(host, "h:", (3, 4, 5)), grams(path, "p:", (3, 4)))


def labelled_table(spark: SparkSession, names: Sequence[tuple[str, int]] | None = None) -> DataFrame:
    """The small labelled table of this module, or of some of its ``names``."""
    return spark.createDataFrame(labelled_urls(labelled_names() if names is None else names), "url string, label int")


def train(labelled: DataFrame, buckets: int = 1 << 16, url: str = "url", label: str = "label") -> PipelineModel:
    """Fit the regression on a small table of URLs; rows without a label are left out.

    One partition, so that the sums behind the weights are made in one order.
    """
    rows = labelled.select(
        features(host_of(F.col(url)), path_of(F.col(url))).alias("__grams"), F.col(label).cast("double").alias("__label")
    )
    rows = rows.filter(F.col("__label").isNotNull()).coalesce(1)
    hashing = HashingTF(numFeatures=buckets, binary=True, inputCol="__grams", outputCol="__features")
    regression = LogisticRegression(
        featuresCol="__features", labelCol="__label", predictionCol="__predicted", rawPredictionCol="__raw",
        probabilityCol="__probability", regParam=0.00001, maxIter=100, tol=1e-8, standardization=False,
    )
    return PipelineModel([hashing, regression.fit(hashing.transform(rows))])


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    model: PipelineModel,
    threshold: float = 0.5,
    url: str = "url",
    keep: Sequence[str] = ("page_id",),
) -> DataFrame:
    """``host``, ``path``, ``rule``, ``score`` and ``verdict`` of every row.

    The longest rule that fits decides (the host and path together; ties go to
    the one listed first); a path of ``/`` does not fit a URL without a path.
    Other rows are blocked where the model's ``score`` reaches ``threshold``.
    A NULL URL, or one without ``://``, has empty host and path and is judged
    by the model like the rest.  Repeated rows stay; columns other than
    ``keep`` are left out.  There is no shuffle: the rules are a short list,
    written into the plan, and the model is a vector of fixed size.
    """
    rows = pages.select(*keep, host_of(F.col(url)).alias("__host"), path_of(F.col(url)).alias("__path"))
    host, path = F.col("__host"), F.col("__path")
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    # Sorted from short to long, each wraps the ones before it; a stable sort keeps the listed order for ties.
    for rule in reversed(sorted(rules, key=lambda r: -len(r.host + r.path))):
        name = lower_ascii(F.lit(rule.host))
        fits = ((host == name) | F.endswith(host, F.concat(F.lit("."), name))) & F.startswith(path, F.lit(rule.path))
        chosen = F.when(
            fits, F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        ).otherwise(chosen)
    rows = rows.withColumn("__rule", chosen).withColumn("__grams", features(host, path))
    scored = model.transform(rows)
    score = F.element_at(vector_to_array("__probability"), 2)
    return scored.select(
        *keep,
        host.alias("host"),
        path.alias("path"),
        F.col("__rule.rule").alias("rule"),
        score.alias("score"),
        F.coalesce(F.col("__rule.verdict"), F.when(score >= threshold, BLOCK).otherwise(ALLOW)).alias("verdict"),
    )
