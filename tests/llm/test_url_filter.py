"""URL parts and rules against plain Python, the model on held-out rows, native plan, odd rows."""

import re

from pyspark.sql import functions as F

from tidemark.llm import url_filter as u
from tidemark.llm.queries import URL_RULES, op4_url_filter

RULES = [u.UrlRule.parse(*r) for r in URL_RULES]


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def plain_rule(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text)) if fits else None


ODD = [
    None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/1?x#y", "http://org", "http://org/", "https://example.org/en/12", "https://example.org/en/2", "https://x.com/de/", "http://com/fr/a",
    "http://notorg/", "a://b://c.org/d", "http://ÄB.org/É", "http://h.org?q=/es/", "http://h\nx.org/a\nb", "http://" + "a" * 50000 + ".com/" + "fr/" * 20000, "http://x.com/de/",
]


def test_parts_and_rules(spark):
    df = spark.createDataFrame([(k, x, "old") for k, x in enumerate(ODD)], "page_id long, url string, verdict string")
    out = u.filter_urls(df, RULES, u.UrlModel(u.UrlModelSpec(), None, "block"))
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    for r in out.collect():
        host, path = plain(r.url)
        rule = plain_rule(host, path)
        assert (r.host, r.path) == (host, path)
        assert (r.rule, r.verdict) == ((rule.text, rule.verdict) if rule else (None, "block"))
    model = u.fit_urls(df.select("url", F.lit("allow").alias("verdict")))
    assert model.fitted is None and {r.verdict for r in u.filter_urls(df.where("url IS NULL"), [], model).collect()} == {"allow"}
    assert u.filter_urls(df.where("false"), RULES, model).count() == 0 and u.fit_urls(df.where("false")).only == "allow"


def test_model_on_held_out_rows(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("url")
    host, path = u.split_url(F.col("url"))
    labelled = pages.select("url", u.matched_rule(host, path, RULES)["verdict"].alias("verdict")).where("verdict IS NOT NULL")
    train, test = labelled.where(F.crc32("url") % 4 > 0), labelled.where(F.crc32("url") % 4 == 0)
    model = u.fit_urls(train)
    judged = u.filter_urls(test.withColumnRenamed("verdict", "truth"), [], model).cache()
    right = judged.where("verdict = truth").count() / judged.count()
    assert judged.count() > 50 and right > 0.93


def test_repeated_urls_do_not_fill_the_sample(spark):
    spec = u.UrlModelSpec(max_labelled=40)
    rows = [(f"https://good.org/page/{k}", "allow") for k in range(60)] + [(f"https://bad.com/page/{k}", "block") for k in range(60)]
    labelled = spark.createDataFrame(rows, "url string, verdict string")
    hot = labelled.orderBy(F.xxhash64("url")).limit(1).crossJoin(spark.range(1000)).select("url", "verdict")
    model = u.fit_urls(labelled.unionByName(hot), spec)
    assert model.fitted is not None
    new = spark.createDataFrame([("https://good.org/page/900",), ("https://bad.com/page/900",)], "url string")
    assert {r.host: r.verdict for r in u.filter_urls(new, [], model).collect()} == {"good.org": "allow", "bad.com": "block"}
    rare = labelled.where("verdict = 'allow' OR url = 'https://bad.com/page/7'")
    assert u.fit_urls(rare, spec).fitted is not None  # one URL of a verdict is in the sample
    assert u.draws({"allow": 60, "block": 1}, spec) == {"allow": 39, "block": 1}
    assert u.draws({"allow": 10**6, "block": 10**3}, u.UrlModelSpec()) == {"block": 200, "allow": 3800}


def test_query(spark):
    out = op4_url_filter(spark, "/root/testdata/sf0.001")
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
    rows = out.collect()
    assert out.columns == ["page_id", "host", "path", "rule", "verdict"] and {r.verdict for r in rows} <= {"allow", "block"}
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.001/pages.parquet").count()
