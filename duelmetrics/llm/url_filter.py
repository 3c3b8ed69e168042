"""URL filter: rules first, then the ratio of two character models.

URLs that a rule allows or blocks train two smoothed variable-order Markov models. Any other URL
is judged by the difference of its log-likelihoods, divided by its length, against a threshold
that is calibrated on URLs the models haven't seen.

Only DataFrame functions are used. Characters are mapped to an alphabet of 41 signs, so a model
over four of them has at most 41 ** 4 rows whatever the input; that is what gets broadcast. All
work is done once per distinct URL, weighted by how often it occurs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import stage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Signs of the models: a start sign, letters, one for digits, these, and one for the rest.
_MARKS = "-._~/?#:=&%+"
SIGNS = 1 + 26 + 1 + len(_MARKS) + 1
ORDER = 3
#: One URL in so many of those that a rule judges is kept for the calibration.
HELD = 5


def ascii_lower(c: Column) -> Column:
    return F.translate(c, _UPPER, _LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: between the first :// and the next /, ? or #, in lower case; path: from there to ? or #. Else both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (url, host, path, ...) with rule and action of the longest rule that fits, or nulls.

    ``rules`` has action, rule_host and rule_path. A rule fits its host and all hosts below it, if
    the path begins with its path; of equally long rules the last by name wins. Hosts meet rules
    by an equality join on their endings, of which only as many are made as the rules have labels.
    """
    rules = rules.withColumn("rule", F.concat("rule_host", "rule_path"))
    labels = rules.agg(F.max(F.size(F.split("rule_host", r"\.")))).first()[0] or 0
    ends = F.array_distinct(F.array(*(F.substring_index("host", ".", -n) for n in range(1, max(1, labels) + 1))))
    fits = urls.select("url", "path", F.explode(ends).alias("rule_host")).join(rules, "rule_host") \
        .where(F.expr("startswith(path, rule_path)")) \
        .groupBy("url").agg(F.max(F.struct(F.length("rule").alias("size"), "rule", "action")).alias("best"))
    return urls.join(fits, "url", "left").withColumn("rule", F.col("best.rule")).withColumn("action", F.col("best.action")).drop("best")


def _signs(url: Column) -> Column:
    """The URL in the alphabet of the models, with start signs before it."""
    low = F.regexp_replace(F.regexp_replace(ascii_lower(url), "[0-9]", "0"), r"[^a-z0\-._~/?#:=&%+]", "*")
    return F.concat(F.lit("^" * ORDER), low)


def _grams(url: Column) -> Column:
    """Each sign with the ORDER signs before it."""
    c = F.filter(F.split(_signs(url), ""), lambda x: x != "")
    after = [F.slice(c, F.lit(k + 1), F.size(c) - ORDER).alias(f"c{k}") for k in range(ORDER + 1)]
    return F.transform(F.arrays_zip(*after), lambda x: F.concat(*(x[f"c{k}"] for k in range(ORDER + 1))))


def log_ratios(labelled: DataFrame, wanted: DataFrame) -> DataFrame:
    """(gram, ratio) for the grams ``wanted``: log of accepted over rejected probability of the last sign.

    ``labelled`` has gram, yes and no: how often it occurs in accepted and in rejected URLs. Each
    order is interpolated with the next lower one by Witten and Bell's weights, down to equal
    chances for all signs. 41 ** 4 rows at most on either side.
    """
    out = wanted.select("gram")
    p = {"yes": F.lit(1.0 / SIGNS), "no": F.lit(1.0 / SIGNS)}
    for order in range(ORDER + 1):
        tail = F.substring("gram", ORDER + 1 - order, order + 1)
        seen = labelled.groupBy(tail.alias("tail")).agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
        head = F.substring("tail", 1, order) if order else F.lit("")
        after = seen.groupBy(head.alias("head")).agg(
            *(f(x).alias(f"{n}_{x}") for x in ("yes", "no") for n, f in (("all", F.sum), ("kinds", lambda c: F.sum((F.col(c) > 0).cast("long"))))))
        out = out.withColumn("tail", tail).withColumn("head", F.substring("gram", ORDER + 1 - order, order) if order else F.lit("")) \
            .join(seen, "tail", "left").join(after, "head", "left")
        for x in p:
            count = F.coalesce(x, F.lit(0))
            total, kinds = F.coalesce(f"all_{x}", F.lit(0)), F.coalesce(f"kinds_{x}", F.lit(0))
            mixed = F.when(total > 0, (count + kinds * p[x]) / (total + kinds)).otherwise(p[x])
            out = out.withColumn(f"p_{x}", mixed)
            p[x] = F.col(f"p_{x}")
        out = out.select("gram", "p_yes", "p_no")
    return out.select("gram", (F.log("p_yes") - F.log("p_no")).alias("ratio"))


def score(urls: DataFrame, ratios: DataFrame) -> DataFrame:
    """(url, score): mean log ratio over a URL's signs."""
    rows = urls.select("url", F.explode(_grams(F.col("url"))).alias("gram"))
    # Bounded by the alphabet: 41 ** 4 rows.
    return rows.join(F.broadcast(ratios), "gram").groupBy("url").agg(F.avg("ratio").alias("score"))


def threshold(scored: DataFrame) -> float | None:
    """The score from which most accepted and fewest rejected URLs lie; None unless both kinds occur.

    ``scored`` has score, action and n. Scores are counted in steps of 0.01 between -20 and 20.
    """
    step = F.greatest(F.lit(-2000), F.least(F.lit(2000), F.floor(F.col("score") * 100))).cast("int")
    bins = scored.groupBy(step.alias("step")).agg(F.sum(F.when(F.col("action") == "allow", F.col("n")).otherwise(0)).alias("yes"),
                                                  F.sum(F.when(F.col("action") == "block", F.col("n")).otherwise(0)).alias("no"))
    up = Window.orderBy(F.desc("step"))  # 4,001 rows at most
    every = Window.partitionBy()
    sums = bins.select("step", F.sum("yes").over(up).alias("yes"), F.sum("no").over(up).alias("no"),
                       F.sum("yes").over(every).alias("all_yes"), F.sum("no").over(every).alias("all_no")) \
        .where("all_yes > 0 AND all_no > 0")
    best = sums.withColumn("gain", F.col("yes") / F.col("all_yes") - F.col("no") / F.col("all_no")).orderBy(F.desc("gain"), F.desc("step")).first()
    return None if best is None else best.step / 100


def judge(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, verdict and score.

    verdict is the rule's action, else ``allow`` if the score reaches the threshold, else
    ``block``. A null or empty URL has no score and is allowed, as is every URL without a rule
    where the rules don't give both accepted and rejected ones to learn from. Columns with those
    names are replaced; rows and other columns stay.
    """
    body = F.coalesce(F.col(url).cast("string"), F.lit(""))
    host, path = host_and_path(F.col("url"))
    urls = pages.groupBy(body.alias("url")).agg(F.count(F.lit(1)).alias("n"))
    urls = stage(match_rules(urls.withColumn("host", host).withColumn("path", path), rules), "urls")

    held = F.pmod(F.xxhash64("url"), F.lit(HELD)) == 0
    grams = F.explode(_grams(F.col("url"))).alias("gram")
    seen = urls.where(F.col("action").isNotNull() & ~held).select("action", "n", grams).groupBy("gram").agg(
        F.sum(F.when(F.col("action") == "allow", F.col("n")).otherwise(0)).alias("yes"),
        F.sum(F.when(F.col("action") == "block", F.col("n")).otherwise(0)).alias("no"))
    seen = stage(seen, "grams")
    ratios = stage(log_ratios(seen, urls.select(grams).distinct()), "ratios")
    scored = stage(urls.join(score(urls, ratios), "url", "left"), "scored")
    cut = threshold(scored.where(F.col("action").isNotNull() & held))

    verdict = F.coalesce("action", F.when(F.lit(cut is None) | F.col("score").isNull() | (F.col("score") >= F.lit(cut or 0.0)), "allow").otherwise("block"))
    judged = scored.select(F.col("url").alias("__url"), "host", "path", "rule", verdict.alias("verdict"), "score")
    others = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "score")]
    rows = pages.select(*others, body.alias("__url")).join(judged, "__url")
    return rows.select(*others, "host", "path", "rule", "verdict", "score")
