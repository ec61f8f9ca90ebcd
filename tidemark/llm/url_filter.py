"""URL filter: longest matching rule first, else a logistic regression on hashed character n-grams."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import without


@dataclass(frozen=True)
class UrlRule:
    """``host`` with all its subdomains, where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @classmethod
    def parse(cls, text: str, verdict: str) -> UrlRule:
        host, slash, rest = text.partition("/")
        return cls(host, slash + rest, verdict)


@dataclass(frozen=True)
class UrlModelSpec:
    """``max_labelled`` bounds the distinct URLs a model is fitted on (those with the least hash of each
    verdict); a verdict gets its share of them, but at least ``least_share`` as far as it has URLs."""

    sizes: tuple[int, ...] = (3, 4)
    buckets: int = 4096
    max_labelled: int = 4000
    least_share: float = 0.05
    max_iter: int = 40
    reg: float = 1e-3


def split_url(url: Column) -> tuple[Column, Column]:
    """(host in lower case, path); both empty for a null url or one without ``://``."""
    found = lambda k: F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", k), F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(found(1), upper, upper.lower()), found(2)


def matched_rule(host: Column, path: Column, rules: list[UrlRule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def grams(host: Column, path: Column, sizes: tuple[int, ...]) -> Column:
    """Character n-grams of host and of path, each marked with the part it comes from.

    The characters are bound to a lambda variable, so a part is split once, whatever its length.
    """

    def runs(chars: Column, mark: str, n: int) -> Column:
        starts = F.when(F.size(chars) >= n, F.sequence(F.lit(1), F.size(chars) - (n - 1)))
        found = F.transform(starts, lambda i: F.concat(F.lit(mark), *[F.element_at(chars, i + k) for k in range(n)]))
        return F.coalesce(found, F.array().cast("array<string>"))

    def of(part: Column, mark: str) -> Column:
        chars = F.split(F.concat(F.lit("^"), part, F.lit("$")), "")
        return F.flatten(F.transform(F.array(chars), lambda c: F.concat(*[runs(c, mark, n) for n in sizes])))

    return F.concat(of(host, "h"), of(path, "p"))


@dataclass(frozen=True)
class UrlModel:
    """``fitted`` is None where the labelled rows know one verdict only; then that is the verdict."""

    spec: UrlModelSpec
    fitted: object | None
    only: str = "allow"

    def judge(self, urls: DataFrame, host: str, path: str, out: str) -> DataFrame:
        if self.fitted is None:
            return urls.withColumn(out, F.lit(self.only))
        rows = urls.withColumn("_grams", grams(F.col(host), F.col(path), self.spec.sizes))
        rows = hasher(self.spec).transform(rows)
        judged = self.fitted.transform(rows)
        return judged.withColumn(out, F.when(F.col("_block") == 1.0, "block").otherwise("allow")).drop("_grams", "_x", "_raw", "_p", "_block")


def hasher(spec: UrlModelSpec) -> HashingTF:
    return HashingTF(numFeatures=spec.buckets, inputCol="_grams", outputCol="_x")


def draws(counts: dict[str, int], spec: UrlModelSpec) -> dict[str, int]:
    """URLs to draw of each of two verdicts with so many distinct URLs; both are present."""
    rare, common = sorted(counts, key=lambda v: (counts[v], v))
    share = counts[rare] / (counts[rare] + counts[common])
    few = min(counts[rare], max(1, round(spec.max_labelled * max(share, spec.least_share))))
    return {rare: few, common: min(counts[common], max(1, spec.max_labelled - few))}


def fit_urls(labelled: DataFrame, spec: UrlModelSpec | None = None) -> UrlModel:
    """Fit on ``labelled`` (url, verdict); rows with another verdict than allow / block are ignored.

    A repeated row counts once.  At most ``spec.max_labelled`` URLs are used, the same ones on every run,
    weighted so that the verdicts keep their shares.  Without any labelled row the model allows everything.
    """
    spec = spec or UrlModelSpec()
    host, path = split_url(F.col("url"))
    known = labelled.where(F.col("verdict").isin("allow", "block")).select(F.coalesce("url", F.lit("")).alias("url"), "verdict").distinct()
    counts = {r.verdict: r["count"] for r in known.groupBy("verdict").count().collect()}  # two rows at most
    if len(counts) < 2:
        return UrlModel(spec, None, next(iter(counts), "allow"))
    quotas = draws(counts, spec)
    drawn = [
        known.where(F.col("verdict") == v).orderBy(F.xxhash64("url"), "url").limit(n).withColumn("weight", F.lit(counts[v] / n * sum(quotas.values()) / sum(counts.values())))
        for v, n in sorted(quotas.items())
    ]
    rows = drawn[0].unionByName(drawn[1])
    rows = rows.select(grams(host, path, spec.sizes).alias("_grams"), (F.col("verdict") == "block").cast("double").alias("label"), "weight").coalesce(1).cache()
    try:
        learner = LogisticRegression(featuresCol="_x", labelCol="label", weightCol="weight", predictionCol="_block", rawPredictionCol="_raw", probabilityCol="_p", maxIter=spec.max_iter, regParam=spec.reg)
        return UrlModel(spec, learner.fit(hasher(spec).transform(rows)))
    finally:
        rows.unpersist()


def filter_urls(pages: DataFrame, rules: list[UrlRule], model: UrlModel, url_col: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``; one row per input row, no shuffle.

    A column of ``pages`` with one of these names is replaced.  A null or malformed URL has
    an empty host and path, fits no rule and gets the model's verdict for an empty URL.
    """
    host, path = split_url(F.col(url_col))
    parts = without(pages, "host", "path", "rule", "verdict").withColumns({"host": host, "path": path})
    judged = model.judge(parts.withColumn("_rule", matched_rule(F.col("host"), F.col("path"), rules)), "host", "path", "_guess")
    return judged.withColumns({"rule": F.col("_rule.rule"), "verdict": F.coalesce(F.col("_rule.verdict"), F.col("_guess"))}).drop("_rule", "_guess")
