"""URL filtering by given host and path rules, and by association rules for the URLs they leave open
(DataFrame functions and Spark's own FP-growth only)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.shared import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LABEL = "label="


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(url: Column) -> Column:
    """Distinct host labels, path segments and query keys, marked by where they stand."""
    query = F.regexp_extract(url, r"^[^#]*?\?([^#]*)", 1)
    parts = F.concat(
        F.transform(F.split(url_host(url), r"\."), lambda x: F.concat(F.lit("host:"), x)),
        F.transform(F.split(url_path(url), "/"), lambda x: F.concat(F.lit("path:"), x)),
        F.transform(F.split(query, "&"), lambda x: F.concat(F.lit("query:"), F.substring_index(x, "=", 1))))
    return F.array_distinct(F.filter(F.coalesce(parts, F.array()), lambda x: ~x.endswith(":")))


def given_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest of the ``(verdict, host, path)`` rules that fits, as ``struct(n, rule, verdict)``.

    A rule fits its host and all subdomains if the path starts with the rule's. Of equally long rules
    the largest text wins. No rule: null.
    """
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                   F.struct(F.lit(len(h + p)).alias("n"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
            for v, h, p in rules]
    return F.array_max(F.array_compact(F.array(*fits)))


def mine_rules(labelled: DataFrame, *, min_support: float = 0.002, min_count: int = 20, min_confidence: float = 0.9) -> DataFrame | None:
    """Association rules from ``labelled(url, label)`` (label null: open), or None if nothing is labelled.

    Each distinct URL is a set of tokens plus its label. FP-growth finds the combinations that hold in
    ``min_support`` of the URLs (and in ``min_count`` at least); those that imply a label with
    ``min_confidence`` are kept. Rows without a label count in the denominator, as URLs of which it is
    known that they have none; leave undecided URLs out (``judge`` does). All of them are counted: FP-growth is distributed.

    Returns the inverted index ``token, rule, need`` (tokens of the rule), ``label, confidence, support``.
    """
    urls = labelled.where(F.col("url").isNotNull()).groupBy("url").agg(F.max("label").alias("label"))
    label = F.when(F.col("label").isNotNull(), F.array(F.concat(F.lit(LABEL), "label"))).otherwise(F.array())
    urls = materialise(urls.select(F.concat(url_tokens(F.col("url")), label).alias("items"), F.col("label").isNotNull().alias("known")), "url_tokens")
    n, known = urls.agg(F.count("*"), F.count(F.when(F.col("known"), 1))).first()
    if not known:
        return None
    support = min(1.0, max(min_support, min_count / n))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(urls.select("items"))
    kind = F.col("consequent")[0]
    rules = materialise(model.associationRules.where(kind.startswith(LABEL)).select(
        F.sort_array("antecedent").alias("tokens"), F.substring_index(kind, "=", -1).alias("label"), "confidence", "support"), "rules")
    return materialise(prune(rules).withColumn("rule", F.concat_ws(" ", "tokens", "label")).withColumn("need", F.size("tokens"))
                       .select(F.explode("tokens").alias("token"), "rule", "need", "label", "confidence", "support"), "rule_index")


def prune(rules: DataFrame) -> DataFrame:
    """``rules(tokens, label, confidence, support)`` without those that never decide: a rule fires only
    where the rules with one of its tokens less fire, which have at least its support; if one of them has
    the same label and at least its confidence, it comes first wherever both fire."""
    known = rules.select(F.concat_ws(" ", "tokens").alias("shorter"), F.col("label").alias("same"), F.col("confidence").alias("bound"))
    less = F.transform("tokens", lambda t: F.concat_ws(" ", F.filter("tokens", lambda x: x != t)))
    covered = (rules.withColumn("shorter", F.explode(less))
               .join(known, "shorter").where("label = same and bound >= confidence").select("tokens", "label").distinct())
    return rules.join(covered, ["tokens", "label"], "left_anti")


def judge_by_rules(urls: DataFrame, index: DataFrame) -> DataFrame:
    """``urls(url)``, distinct -> ``(url, label)`` of the URLs on which a rule fires: a URL's tokens are
    looked up in the inverted index, and a rule fires when all its tokens were found. The rule of the
    highest confidence, then support, then the most tokens decides (then the smallest text)."""
    parts = int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # short rows that grow by their tokens and rules: dealt to all partitions, however few bytes they are
    tokens = urls.repartition(parts, "url").select("url", F.explode(url_tokens(F.col("url"))).alias("token"))
    fired = (tokens.join(index.select("token", "rule", "need"), "token").groupBy("url", "rule", "need").count()
             .where("count = need").select("url", "rule"))
    rules = index.select("rule", "need", "label", "confidence", "support").distinct()
    order = F.struct(-F.col("confidence"), -F.col("support"), -F.col("need"), "rule")
    return fired.join(rules, "rule").groupBy("url").agg(F.min_by("label", order).alias("label"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]], *, id_col: str = "page_id", url_col: str = "url",
          default: str = "allow", **mining) -> DataFrame:
    """``id, host, path, rule, verdict, learned`` of every record.

    The longest given rule decides; the URLs it decides are the labels from which association rules
    are mined (support and confidence are shares of these URLs alone: an open URL speaks neither for nor
    against a rule), and these judge the URLs that no given rule fits; where none fires, ``default`` holds
    (also for null URLs and those without ``://``). ``learned``: a mined rule decided. Repeated rows
    each come back; copies of a URL count once in mining.
    """
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).withColumn("host", url_host(F.col("url"))) \
        .withColumn("path", url_path(F.col("url")))
    src = materialise(src.withColumn("given", given_rule(F.col("host"), F.col("path"), rules)), "urls")
    index = mine_rules(src.where(F.col("given").isNotNull()).select("url", F.col("given.verdict").alias("label")), **mining)
    told = src.select("id", "url", "host", "path", F.col("given.rule").alias("rule"), F.col("given.verdict").alias("known"))
    if index is None:
        return told.select("id", "host", "path", "rule", F.coalesce("known", F.lit(default)).alias("verdict"), F.lit(False).alias("learned"))
    open_urls = told.where(F.col("known").isNull() & F.col("url").isNotNull()).select("url").distinct()
    judged = materialise(judge_by_rules(open_urls, index), "judged")
    return told.join(judged, "url", "left").select(
        "id", "host", "path", "rule", F.coalesce("known", "label", F.lit(default)).alias("verdict"),
        (F.col("known").isNull() & F.col("label").isNotNull()).alias("learned"))
