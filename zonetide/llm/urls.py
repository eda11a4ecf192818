"""URL filter: rules for hosts and paths, and a logistic regression for the rest.

A url's host and path are read off natively; a rule such as ``example.net/en/`` fits its
host and all subdomains, if the path starts with the rule's, and the longest fitting rule
decides.  Urls without a rule are judged by logistic regression on hashed character
n-grams of host and path, trained from a small labelled url table.  Without such a table
the labels are the verdicts of the rules themselves, on different urls, for either verdict
the ``max_rows / 2`` with the smallest hash: the model then carries over to hosts and paths that no rule names.

All steps are DataFrame functions and ``pyspark.ml`` stages, which run in the JVM.  The
model is a vector of ``2 ** bits`` weights, whatever the number of urls.

Defined results: null urls and those without ``://`` have an empty host and path, no rule,
and the model's verdict on an empty text; equal rows get equal verdicts; a table without any
rule's url has one class at most, and then everything gets it (``allow`` if there is none);
other columns are carried along by ``judge_urls``.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Verdict, host, path.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
GRAMS = (3, 4)
BITS = 14
MAX_ROWS = 2000
ITERATIONS = 40
RIDGE = 0.002

_SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return common.lower_ascii(F.coalesce(F.regexp_extract(url, _SPLIT, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _SPLIT, 2), F.lit(""))


def rule_column(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as struct(rule, verdict), or null."""
    found = F.lit(None)
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        named = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, named).otherwise(found)  # later ones are longer and win
    return found


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of host and path, each marked with where it is from.

    A look-ahead pattern yields overlapping n-grams in one pass over the text."""
    parts, marked = [], lambda mark: lambda g: F.concat(F.lit(mark), g)
    for mark, text in (("h", host), ("p", path)):
        framed = F.concat(F.lit("^"), text, F.lit("$"))
        for n in GRAMS:
            found = F.regexp_extract_all(framed, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))
            parts.append(F.transform(found, marked(mark)))
    return F.concat(*parts)


def _features(urls: DataFrame) -> DataFrame:
    counted = HashingTF(inputCol="_grams", outputCol="_counts", numFeatures=2**BITS, binary=True)
    return counted.transform(urls.withColumn("_grams", grams(F.col("_host"), F.col("_path")))).drop("_grams")


def train(labelled: DataFrame):
    """Fit on (url, verdict): a model, or the only verdict there is."""
    rows = labelled.where("verdict in ('allow', 'block')")
    rows = rows.select(host_of(F.col("url")).alias("_host"), path_of(F.col("url")).alias("_path"), (F.col("verdict") == "block").cast("double").alias("label"))
    # one file, so that the optimizer adds up in the same order on every run
    rows = common.stored(rows, "urls", 1)
    kinds = [r[0] for r in rows.select("label").distinct().collect()]
    if len(kinds) < 2:
        return "block" if kinds == [1.0] else "allow"
    learner = LogisticRegression(
        featuresCol="_counts", labelCol="label", regParam=RIDGE, maxIter=ITERATIONS,
        predictionCol="_verdict", probabilityCol="_probability", rawPredictionCol="_raw",
    )
    return _plain(learner.fit(_features(rows)), common.scratch_path(rows.sparkSession, "url-model"))


def _plain(model: LogisticRegressionModel, path: str) -> LogisticRegressionModel:
    """The model without its training summary, by way of its stored weights.

    The summary holds the session, so whatever the session has come to hold would have to
    be sent along with the model.
    """
    model.write().save(path)
    return LogisticRegressionModel.load(path)


def rule_labels(urls: DataFrame, rules=RULES, max_rows: int = MAX_ROWS) -> DataFrame:
    """A small labelled table: different urls that a rule judges, of either verdict those
    with the smallest hashes."""
    named = urls.select("url", rule_column(host_of(F.col("url")), path_of(F.col("url")), rules).alias("r"))
    named = named.where("r is not null").select("url", "r.verdict").distinct()
    place = F.row_number().over(Window.partitionBy("verdict").orderBy(F.xxhash64("url"), "url"))
    return named.withColumn("_place", place).where(F.col("_place") <= max_rows // 2).drop("_place")


def judge_urls(urls: DataFrame, labelled: DataFrame | None = None, rules=RULES) -> DataFrame:
    """Every row of ``urls`` with struct ``judged``: host, path, rule, verdict, p_block."""
    model = train(rule_labels(urls, rules) if labelled is None else labelled)
    rows = urls.select(
        F.struct(*(F.col(f"`{c}`") for c in urls.columns)).alias("_row"),
        host_of(F.col("url")).alias("_host"),
        path_of(F.col("url")).alias("_path"),
    ).withColumn("_rule", rule_column(F.col("_host"), F.col("_path"), rules))
    if isinstance(model, str):
        rows = rows.withColumn("_p", F.lit(float(model == "block")))
    else:
        from pyspark.ml.functions import vector_to_array

        rows = model.transform(_features(rows)).withColumn("_p", vector_to_array("_probability")[1])
    verdict = F.coalesce(F.col("_rule.verdict"), F.when(F.col("_p") >= 0.5, "block").otherwise("allow"))
    judged = F.struct(
        F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule.rule").alias("rule"),
        verdict.alias("verdict"), F.col("_p").alias("p_block"),
    )
    carried = [F.col("_row").getField(c).alias(c) for c in urls.columns if c != "judged"]
    return rows.select(*carried, judged.alias("judged"))


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = common.table(spark, folder, "pages").select("page_id", "url")
    return judge_urls(pages).select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict", "judged.p_block")
