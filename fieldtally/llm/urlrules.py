"""URL verdicts: fixed host and path rules first, mined association rules for the rest.

Spark's FP-growth mines combinations of URL tokens (host labels, path parts, query and fragment) that come with
bad labels. Rules are kept by support and confidence, and found for a URL by an inverted index: each rule is filed under
its rarest token, a URL looks up only its own tokens there, and the few rules found are checked whole.
Only DataFrame functions and Spark's own FP-growth touch the rows.

``significant_rules`` mines what chance does not explain. Each URL counts once. Tokens of exactly the same labelled URLs are one item, so a page
template is an item and not all subsets of its tokens. A rule with x bad ones among its n URLs stands if the number of combinations
tried, times Hoeffding's bound ``exp(-n KL(x / n, share of bad URLs))`` on its chance under shuffled labels, is at most ``ALPHA``; so with shuffled labels
any rule at all is found in at most that share of cases. Its confidence must be above ``MIN_CONFIDENCE`` besides. The support is the least at which a combination could pass.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldtally.llm.scratch import Scratch

#: (host, path, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
MIN_SUPPORT = 0.005  #: share of the labelled URLs that have the tokens and a bad label
LEAST_URLS = 20  #: and at least so many of them, since a few URLs prove nothing
MIN_CONFIDENCE = 0.5
ALPHA = 0.05  #: how likely shuffled labels give any rule
MIN_SHARE = 1 / 50_000  #: support of a significant rule at least, so that the frequent tokens stay a bounded table
BAD = "label:bad"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    return F.coalesce(F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    return F.coalesce(F.regexp_extract(F.regexp_replace(rest, "^[^/?#]*", ""), "^[^?#]*", 0), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits the host or a domain above it and the start of the path; NULLs if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for own_host, own_path, what in sorted(rules, key=lambda r: len(r[0] + r[1])):  # the longest is asked first
        fits = ((host == own_host) | host.endswith(f".{own_host}")) & path.startswith(own_path)
        rule, verdict = F.when(fits, f"{own_host}{own_path}").otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def tokens_of(url: Column) -> Column:
    """Distinct tokens of a URL, marked by the part they come from."""
    empty = F.array().cast("array<string>")
    query = F.regexp_extract(url, "[?]([^#]*)", 1)
    fragment = F.regexp_extract(url, "#(.*)$", 1)

    def marked(parts: Column, mark: str) -> Column:
        return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(mark), x))

    every = F.concat(
        marked(F.split(host_of(url), "[.]"), "h:"), marked(F.split(path_of(url), "[/.]"), "p:"),
        marked(F.split(query, "&"), "q:"), marked(F.array(fragment), "f:"),
    )
    return F.array_distinct(F.coalesce(every, empty))


def mined_rules(labelled: DataFrame, scratch: Scratch, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """(key, tokens, confidence, support) of the rules tokens -> bad label. ``labelled`` has (tokens, bad).

    ``key`` is the rule's rarest token. Without labelled rows, or with none frequent enough, there are no rules."""
    items = labelled.select(F.when(F.col("bad"), F.array_append("tokens", F.lit(BAD))).otherwise(F.col("tokens")).alias("items"))
    items = scratch.written(items.where(F.size("items") > 0), "transactions")
    schema = "key string, tokens array<string>, confidence double, support double"
    n = items.count()
    if not n:
        return items.sparkSession.createDataFrame([], schema)
    least = max(min_support, LEAST_URLS / n)
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, least), minConfidence=min_confidence).fit(items)
    rules = model.associationRules.where(F.element_at("consequent", 1) == BAD)
    rules = rules.select(F.array_sort("antecedent").alias("tokens"), "confidence", "support")
    single = model.freqItemsets.where(F.size("items") == 1).select(F.element_at("items", 1).alias("token"), "freq")
    parts = rules.select("*", F.explode("tokens").alias("token")).join(single, "token")
    keyed = parts.groupBy("tokens", "confidence", "support").agg(F.min_by("token", F.struct("freq", "token")).alias("key"))
    return scratch.written(keyed.select("key", "tokens", "confidence", "support"), "rules")


def _itemsets(rows: DataFrame, least: int, n: int) -> DataFrame:
    """(items, freq) of the combinations in at least ``least`` of ``n`` rows (items)."""
    found = FPGrowth(itemsCol="items", minSupport=min(1.0, (least - 0.5) / n)).fit(rows).freqItemsets
    return found.select(F.array_sort("items").alias("items"), "freq")


def significant_rules(
    labelled: DataFrame, scratch: Scratch, alpha: float = ALPHA, min_share: float = MIN_SHARE, min_confidence: float = MIN_CONFIDENCE,
) -> tuple[DataFrame, DataFrame]:
    """((key, tokens, confidence, support, n) of the rules tokens -> bad label, (token, item)). ``labelled`` has (tokens, bad), a row per URL.

    A rule's ``tokens`` are items: tokens that stand for all tokens of the same labelled URLs, which the second table lists. ``key`` is
    the rarest. Without labelled rows, without bad or without good ones, or with none that chance does not explain, there are no rules."""
    spark = labelled.sparkSession
    none = (
        spark.createDataFrame([], "key string, tokens array<string>, confidence double, support double, n long"),
        spark.createDataFrame([], "token string, item string"),
    )
    rows = scratch.written(labelled.select(F.monotonically_increasing_id().alias("id"), "tokens", F.coalesce("bad", F.lit(False)).alias("bad")), "labelled")
    n, n_bad = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("bad").cast("int")), F.lit(0))).first()
    if not 0 < n_bad < n:
        return none
    base = n_bad / n
    tokens = rows.select("id", F.explode(F.array_distinct("tokens")).alias("token"))
    places = [F.expr(f"bit_xor(xxhash64(id, {k}))").alias(f"x{k}") for k in (1, 2)]
    same = ["freq", "x1", "x2"]  # equal for tokens of the same URLs
    by_token = scratch.written(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("freq"), *places), "tokens")
    classes = scratch.written(by_token.groupBy(*same).agg(F.min("token").alias("item")), "classes")
    # the least support at which not even single items, all their URLs bad, would pass by chance
    freq = W.orderBy(F.desc("freq"))  # a row per frequency
    steps = classes.groupBy("freq").count().withColumn("above", F.sum("count").over(freq)).withColumn("below", F.coalesce(F.lead("freq").over(freq), F.lit(0)))
    reach = F.greatest(F.col("below") + 1, F.ceil(F.log(F.col("above") / alpha) / -math.log(base)))
    least = steps.select("freq", reach.alias("reach")).where("reach <= freq").agg(F.min("reach")).first()[0]
    if least is None:
        return none
    least = max(least, math.ceil(min_share * n))
    frequent = classes.where(F.col("freq") >= least)
    items = scratch.written(by_token.join(frequent, same).select("token", "item", "freq"), "items")
    per_url = tokens.join(items, "token").groupBy("id").agg(F.collect_set("item").alias("items"))  # of one URL
    per_url = scratch.written(per_url.join(rows.select("id", "bad"), "id"), "transactions")
    n_all, n_found = per_url.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("bad").cast("int")), F.lit(0))).first()
    if not n_found:
        return none
    tried = scratch.written(_itemsets(per_url.select("items"), least, n_all), "tried")
    bound = math.log(max(1, tried.count()) / alpha)
    least_bad = max(1, math.ceil(bound / -math.log(base)))
    bad = _itemsets(per_url.where("bad").select("items"), least_bad, n_found).withColumnRenamed("freq", "bad")
    share, good = F.col("bad") / F.col("freq"), 1 - F.col("bad") / F.col("freq")
    divergence = share * F.log(share / base) + F.when(good > 0, good * F.log(good / (1 - base))).otherwise(0.0)
    rules = bad.join(tried, "items").where((share > max(base, min_confidence)) & (F.col("freq") * divergence >= bound))
    rules = rules.select(F.col("items").alias("tokens"), share.alias("confidence"), (F.col("bad") / n).alias("support"), F.col("freq").alias("n"))
    single = items.where("token = item").select(F.col("item").alias("token"), "freq")
    parts = rules.select("*", F.explode("tokens").alias("token")).join(single, "token")
    keyed = parts.groupBy("tokens", "confidence", "support", "n").agg(F.min_by("token", F.struct("freq", "token")).alias("key"))
    return scratch.written(keyed.select("key", "tokens", "confidence", "support", "n"), "rules"), items.select("token", "item")


def known_urls(labelled: DataFrame) -> DataFrame:
    """(url, tokens, bad), a row per URL of ``labelled`` (url, bad); a URL with any bad label is bad."""
    bad = F.max(F.coalesce("bad", F.lit(False))).alias("bad")
    return labelled.where(F.col("url").isNotNull()).groupBy("url").agg(bad).select("url", tokens_of(F.col("url")).alias("tokens"), "bad")


def rule_hits(urls: DataFrame, rules: DataFrame, items: DataFrame) -> DataFrame:
    """(url, confidence of its strongest rule) of the ``urls`` (url, own: tokens) that have all items of a rule."""
    own = urls.select("url", F.explode("own").alias("token")).join(items, "token").groupBy("url").agg(F.collect_set("item").alias("own"))
    found = own.select("url", "own", F.explode("own").alias("key")).join(rules, "key")
    return found.where(F.size(F.array_except("tokens", "own")) == 0).groupBy("url").agg(F.max("confidence").alias("confidence"))


def held_out(labelled: DataFrame, scratch: Scratch, folds: int = 2) -> tuple[int, int, int, int]:
    """(URLs, bad ones, URLs that rules block, bad ones among these), rules being mined without the fold that they are applied to."""
    known = scratch.written(known_urls(labelled).withColumn("fold", F.pmod(F.xxhash64("url"), F.lit(folds))), "known")
    sums = [0, 0, 0, 0]
    for fold in range(folds):
        rules, items = significant_rules(known.where(F.col("fold") != fold).select("tokens", "bad"), scratch)
        test = known.where(F.col("fold") == fold)
        hits = rule_hits(test.select("url", F.col("tokens").alias("own")), rules, items)
        bad = F.sum(F.col("bad").cast("int"))
        for k, rows in ((0, test), (2, test.join(hits, "url", "left_semi"))):
            found = rows.agg(F.count(F.lit(1)), F.coalesce(bad, F.lit(0))).first()
            sums[k], sums[k + 1] = sums[k] + found[0], sums[k + 1] + found[1]
    return tuple(sums)


def judge(
    pages: DataFrame, labelled: DataFrame, page_id: str = "page_id", url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES, significant: bool = False,
) -> DataFrame:
    """Rows (page_id, host, path, rule, verdict, confidence), one per row of ``pages``. ``labelled`` has (url, bad).

    URLs without a fixed rule are blocked if a mined rule's tokens are all among theirs; ``confidence`` is that of the
    strongest. ``significant`` mines by ``significant_rules``, otherwise by ``mined_rules``. NULL URLs have empty host and path and no tokens, and
    are allowed. Repeated rows get equal answers, a repeated labelled URL counts once (as bad if any of its labels is), a
    NULL label is not bad, and an empty table gives no rows.
    """
    scratch = Scratch(pages.sparkSession, "urlrules")
    known = known_urls(labelled).select("tokens", "bad")
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"))
    urls = rows.where("url is not null").select("url").distinct().withColumn("own", tokens_of(F.col("url")))
    if significant:
        found = rule_hits(urls, *significant_rules(known, scratch))
    else:
        found = urls.select("url", "own", F.explode("own").alias("key")).join(mined_rules(known, scratch), "key")
        found = found.where(F.size(F.array_except("tokens", "own")) == 0).groupBy("url").agg(F.max("confidence").alias("confidence"))
    found = scratch.written(found, "matches")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = rows.join(found, "url", "left").select("page_id", host.alias("host"), path.alias("path"), "confidence")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    mine = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    return rows.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, mine).alias("verdict"), "confidence")
