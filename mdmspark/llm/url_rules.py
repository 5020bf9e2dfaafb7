"""URL filtering by fixed rules and by association rules mined from labels.

A fixed rule (host and path prefix) decides first; the longest that fits wins.
All other urls go to mined rules: FP-growth over the token sets of labelled
urls, each with its label as one more item, finds the token combinations that
go with a block label. Combinations with too few block labels (an absolute
number, the same at every size of the table), too little confidence, or a share
of block labels that chance explains are dropped. A rule is indexed under its rarest token only; token sets look their
tokens up there and check the rest of the rule, so a token that most urls have
leads to few rules, and urls with equal token sets are matched once.

Everything is built from DataFrame functions. Every token of a url counts (see
:func:`all_tokens`). Mining is kept small without loss: only tokens that occur
with a block label as often as a rule must are listed, and tokens that occur
in exactly the same labelled urls stand for each other (see :func:`classes`).

Defined results: a null url, or one without ``://``, has an empty host and
path, no token and is allowed; an empty host fits no rule; repeated rows get
equal verdicts; repeated labels of a page count once each time they occur;
without labels no rule is mined; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdmspark.llm.common import materialize

# Fixed rules: (host, path, verdict).
FIXED = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
# A mined rule needs so many block labels, at every size of the table, and this
# share of block labels among the labelled pages it fits. That share must also
# lie above the one of all labelled pages by so many standard deviations.
MIN_PAGES, MIN_CONFIDENCE, MIN_DEVIATIONS = 8, 0.5, 3.0
BLOCK = "label=block"


def url_parts(url: str = "url") -> tuple[Column, Column, Column]:
    """(host, path, query) of a column of urls; empty where there is none."""
    rest = F.coalesce(F.when(F.instr(url, "://") > 0, F.col(url).substr(F.instr(url, "://") + 3, F.length(url))), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)


def fixed_rule(host: Column, path: Column, rules=FIXED) -> Column:
    """(rule, verdict) of the longest fixed rule that fits, else null."""
    ranked = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    fits = [((host == h) | host.endswith("." + h)) & path.startswith(p) for h, p, _ in ranked]
    return F.coalesce(*[F.when(f, F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for f, (h, p, v) in zip(fits, ranked)])


def all_tokens(host: Column, path: Column, query: Column) -> Column:
    """The token set of a url, sorted: all labels of the host, parts of the
    path and names of the query; digits read as ``0``."""
    labels, parts = F.split(host, r"\."), F.filter(F.split(path, "/"), lambda x: x != "")
    names = F.filter(F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1)), lambda x: x != "")
    digits = lambda c: F.regexp_replace(c, "[0-9]+", "0")
    tokens = F.concat(F.transform(labels, lambda x: F.concat(F.lit("h:"), digits(x))), F.transform(parts, lambda x: F.concat(F.lit("p:"), digits(x))),
                      F.transform(names, lambda x: F.concat(F.lit("q:"), digits(x))))
    return F.when(host != "", F.array_sort(F.array_distinct(F.filter(tokens, lambda x: x != "h:")))).otherwise(F.array().cast("array<string>"))


def classes(baskets: DataFrame, least: int) -> DataFrame:
    """(token, class) of the tokens that occur in at least ``least`` bad rows of
    ``baskets`` (id, tokens, bad): no other token is part of a rule. Tokens of
    exactly the same rows (told by two hash sums over them) form a class, named
    after the smallest: a rule with one of them holds with any other in its
    place, so a url has the class if it has one of its tokens."""
    rows = baskets.select("id", "bad", F.explode("tokens").alias("token"))
    marks = [F.sum(F.xxhash64("id", F.lit(i)).cast("decimal(20,0)")).alias(f"mark{i}") for i in (0, 1)]
    found = rows.groupBy("token").agg(F.count_if("bad").alias("n_bad"), F.count("*").alias("n"), *marks).where(F.col("n_bad") >= least)
    named = found.groupBy("n", "mark0", "mark1").agg(F.min("token").alias("class"), F.collect_list("token").alias("tokens"))
    return named.select(F.explode("tokens").alias("token"), "class")


def class_sets(rows: DataFrame, named: DataFrame) -> DataFrame:
    """(id, tokens): the classes of each row of ``rows`` (id, tokens) that has
    any. A join by key of two plain frames: Spark splits a token that a third of
    the rows have, and broadcasts ``named`` only below its threshold."""
    one = rows.select("id", F.explode("tokens").alias("token")).join(named, "token")
    return one.groupBy("id").agg(F.array_sort(F.collect_set("class")).alias("tokens"))


def stands_out(n_block: Column, n_fit: Column, base: float, deviations: float = MIN_DEVIATIONS) -> Column:
    """Whether ``n_block`` of ``n_fit`` pages lies above the share ``base`` by so many standard deviations of as many random pages."""
    above = n_block - n_fit * F.lit(base)
    return (above >= 0) & (above * above >= F.lit(deviations * deviations) * n_fit * F.lit(base * (1 - base)))


def mine_rules(labelled: DataFrame, *, min_pages: int = MIN_PAGES, min_confidence: float = MIN_CONFIDENCE, min_deviations: float = MIN_DEVIATIONS) -> DataFrame:
    """(tokens, n_fit, n_block): the token combinations of ``labelled``
    (tokens, bad) that lead to a block. FP-growth runs over distinct tasks'
    conditional trees; only frequent single items reach the driver."""
    n, n_bad = labelled.agg(F.count(F.lit(1)), F.count_if("bad")).first()
    baskets = labelled.where(F.size("tokens") > 0)
    held = baskets.count()
    if held < min_pages:
        return labelled.select("tokens", F.lit(0).cast("long").alias("n_fit"), F.lit(0).cast("long").alias("n_block")).limit(0)
    items = baskets.select(F.when(F.col("bad"), F.concat("tokens", F.array(F.lit(BLOCK)))).otherwise(F.col("tokens")).alias("items"))
    found = FPGrowth(itemsCol="items", minSupport=(min_pages - 0.5) / held, minConfidence=1.0).fit(items).freqItemsets
    blocked = F.array_contains("items", BLOCK)
    both = found.where(blocked).select(F.array_sort(F.array_remove("items", BLOCK)).alias("tokens"), F.col("freq").alias("n_block"))
    fit = found.where(~blocked).select(F.array_sort("items").alias("tokens"), F.col("freq").alias("n_fit"))
    sure = (F.col("n_block") >= F.col("n_fit") * F.lit(min_confidence)) & stands_out(F.col("n_block"), F.col("n_fit"), n_bad / n, min_deviations)
    return fit.join(both, "tokens").where(sure).select("tokens", "n_fit", "n_block")


def matched_sets(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct ``tokens`` of ``sets`` that some rule fits, by an inverted
    index from a rule's rarest token to the rule."""
    distinct = sets.select("tokens").distinct()
    entries = distinct.select("tokens", F.explode("tokens").alias("token"))
    common = entries.groupBy("token").agg(F.count("*").alias("n_sets"))
    spread = rules.select(F.col("tokens").alias("rule"), F.explode("tokens").alias("token"))
    ranked = spread.join(common, "token", "left").groupBy("rule").agg(F.min(F.struct(F.coalesce("n_sets", F.lit(0)).alias("n"), "token")).alias("key"))
    index = ranked.select(F.col("key.token").alias("token"), "rule")
    return entries.join(index, "token").where(F.size(F.array_except("rule", "tokens")) == 0).select("tokens").distinct()


def judge_urls(pages: DataFrame, labels: DataFrame, *, min_pages: int = MIN_PAGES, min_confidence: float = MIN_CONFIDENCE, min_deviations: float = MIN_DEVIATIONS) -> DataFrame:
    """page_id, host, path, rule (null if mined rules decide) and verdict of
    every row of ``pages`` (page_id, url); ``labels`` (page_id, bad)."""
    host, path, query = url_parts()
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"), query.alias("query"))
    parsed = parsed.withColumns({"tokens": all_tokens(F.col("host"), F.col("path"), F.col("query")), "fixed": fixed_rule(F.col("host"), F.col("path"))})
    marked = labels.where("bad is not null").select("page_id", "bad")
    baskets = parsed.select("page_id", "tokens").join(marked, "page_id").where(F.size("tokens") > 0)
    # Ids are fixed by writing them.
    baskets = materialize(baskets.select(F.monotonically_increasing_id().alias("id"), "tokens", "bad"), "url-baskets")
    named = materialize(classes(baskets, min_pages), "url-classes")
    short = baskets.select("id", "bad").join(class_sets(baskets, named), "id", "left").withColumn("tokens", F.coalesce("tokens", F.array().cast("array<string>")))
    rules = mine_rules(materialize(short.select("tokens", "bad"), "url-short-baskets"), min_pages=min_pages, min_confidence=min_confidence, min_deviations=min_deviations)
    sets = parsed.where("fixed is null").select("tokens").distinct().select(F.monotonically_increasing_id().alias("id"), "tokens")
    sets = materialize(sets, "url-sets")
    short = materialize(class_sets(sets, named), "url-short-sets")
    fits = materialize(matched_sets(short, rules), "url-short-hits")
    # As a written table the hits have a known size (few: Spark broadcasts them
    # below its threshold) and an exchange of their own (many: a token set that
    # a great part of the pages share is split by Spark's skew join).
    hits = sets.join(short.join(fits, "tokens").select("id"), "id").select("tokens")
    hits = materialize(hits, "url-hits").withColumn("hit", F.lit(True))
    out = parsed.join(hits, "tokens", "left")
    mined = F.when(F.col("hit"), "block").otherwise("allow")
    return out.select("page_id", "host", "path", F.col("fixed.rule").alias("rule"), F.coalesce("fixed.verdict", mined).alias("verdict"))
