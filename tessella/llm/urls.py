"""URL filters: host rules, and a character language-model ratio for the URLs that no rule fits.

Two smoothed variable-order Markov models (orders 0 to 4, each interpolated with the shorter one) are counted over
accepted and rejected URLs. A URL's score is the difference of its log-likelihoods, divided by its length; the threshold
is calibrated on seeds kept out of the counts. Only built-in functions are used: characters become 5-grams, each distinct
5-gram gets its log ratio from the counts of its endings, and a URL averages the ratios of its own.

Defined cases: a null URL, or one without ``://``, has empty host and path, fits no rule and scores as the text it is
(null: empty); repeated rows get equal results (every distinct URL is scored once, and counts as often as it occurs);
without accepted or without rejected seeds the threshold is 0; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_counted, materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORDER = 5
#: Weight of the shorter context's estimate, and probability of a character that nothing is known of.
BACKOFF = 4.0
UNSEEN = 1 / 256
#: Of every so many seeds one calibrates instead of being counted.
HOLD_OUT = 4
#: A key is frequent with more than one in so many rows; there are no more frequent keys than that.
SHARE = 10_000
#: Characters of URLs that a task takes apart.
TASK_CHARS = 1 << 23

Rule = tuple[str, str]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first :// up to / ? # or the end, A-Z lowered; path: on to ? # or the end; else both empty."""
    shape = "(?s)^.*?://([^/?#]*)([^?#]*)"
    known = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(known, shape, 1), UPPER, LOWER), F.regexp_extract(known, shape, 2)


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule for the host or a parent domain whose path begins the URL's; null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        of, slash, begin = text.partition("/")
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(slash + begin)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def grams(url: Column) -> Column:
    """A 5-gram ending at each character behind the scheme, and one at the end; a control character pads the beginning."""
    text = F.concat(F.translate(F.regexp_replace(F.coalesce(url, F.lit("")), "(?s)^[A-Za-z][A-Za-z0-9+.-]*://", ""), UPPER, LOWER), F.lit("\u0003"))
    letters = F.split(text, "")
    pad = F.lit("\u0002")
    return F.transform(letters, lambda c, i: F.concat(*[F.when(i >= k, F.get(letters, i - k)).otherwise(pad) for k in range(ORDER - 1, 0, -1)], c))


def gram_ratios(counts: DataFrame) -> DataFrame:
    """(gram, n, ratio) for counts (gram, accepted, rejected, n) of 5-grams: log-likelihood ratio of the last character.

    The counts of all shorter grams come from one grouping of the 5-grams' endings, those of the contexts from one more;
    each 5-gram then meets its five orders, and the interpolation is a fold over them."""
    sides = ("accepted", "rejected")
    endings = F.explode(F.array(*[F.substring("gram", ORDER - k + 1, k) for k in range(1, ORDER + 1)]))
    orders = counts.select(endings.alias("g"), *sides).groupBy("g").agg(*[F.sum(s).alias(s) for s in sides], F.count("*").alias("uses"))
    orders = materialise(orders, "url-orders")
    context = F.expr("substring(g, 1, length(g) - 1)")
    contexts = materialise(orders.groupBy(context.alias("c")).agg(*[F.sum(s).alias(f"of_{s}") for s in sides], F.count("*").alias("follow")), "url-contexts")
    known = join_counted(orders.withColumn("c", context), contexts, "c", "follow", SHARE)
    known = materialise(known.select("g", "uses", F.struct(F.length("g").alias("k"), *sides, *[f"of_{s}" for s in sides]).alias("at")), "url-known")
    met = join_counted(counts.select("gram", "n", endings.alias("g")), known, "g", "uses", SHARE).groupBy("gram").agg(F.first("n").alias("n"), F.array_sort(F.collect_list("at")).alias("orders"))

    def log_p(side: str) -> Column:
        step = lambda below, at: (at[side] + F.lit(BACKOFF) * below) / (at[f"of_{side}"] + F.lit(BACKOFF))
        return F.log(F.aggregate("orders", F.lit(UNSEEN), step))

    return met.select("gram", "n", (log_p("accepted") - log_p("rejected")).alias("ratio"))


def url_scores(seeds: DataFrame, hold_out: int = HOLD_OUT) -> tuple[DataFrame, float]:
    """Scores (url, score) of distinct URLs (url, n, seed) and the calibrated threshold.

    ``seed`` is allow, block or null; every ``hold_out``-th seed by checksum calibrates. URLs are dealt out by the characters
    that there are before any is taken apart, since their table is small for the work it gives; the most frequent grams
    meet their ratios by broadcast."""
    held = F.pmod(F.crc32(F.col("url").cast("binary")), F.lit(hold_out)) == 0
    weight = lambda said: F.sum(F.when((F.col("seed") == said) & ~F.col("held"), F.col("n")).otherwise(0))
    each = materialise(seeds.withColumn("held", held), "urls")
    chars = each.agg(F.coalesce(F.sum(F.length("url")), F.lit(0))).first()[0]
    rows = each.repartition(max(each.sparkSession.sparkContext.defaultParallelism, chars // TASK_CHARS), "url").withColumn("gram", F.explode(grams(F.col("url"))))
    counts = materialise(rows.groupBy("gram").agg(weight("allow").alias("accepted"), weight("block").alias("rejected"), F.count("*").alias("n")), "url-grams")
    ratios = materialise(gram_ratios(counts), "url-ratios")
    # The ratios of frequent grams come by broadcast; a URL's
    # other grams are gathered with its sum, where it is, and only they are shuffled.
    often = F.col("n") * SHARE > (ratios.agg(F.sum("n")).first()[0] or 0)
    first = lambda *names: [F.first(k).alias(k) for k in names]
    near = rows.join(F.broadcast(ratios.where(often).select("gram", "ratio")), "gram", "left").groupBy("url")
    partial = materialise(near.agg(*first("seed", "held"), F.sum("ratio").alias("sum"), F.count("*").alias("all"), F.collect_list(F.when(F.col("ratio").isNull(), F.col("gram"))).alias("rest")), "url-sums")
    rest = partial.select("url", F.explode("rest").alias("gram")).join(ratios.where(~often), "gram").groupBy("url").agg(F.sum("ratio").alias("more"))
    zero = F.lit(0.0)
    scores = partial.join(rest, "url", "left").select("url", ((F.coalesce("sum", zero) + F.coalesce("more", zero)) / F.col("all")).alias("score"), "seed", "held")
    scores = materialise(scores, "url-scores")
    side = {r.seed: r for r in scores.where("held and seed is not null").groupBy("seed").agg(F.avg("score").alias("mean"), F.stddev_pop("score").alias("spread")).collect()}
    threshold = 0.0
    if len(side) == 2:
        a, b = side["allow"], side["block"]
        spread = a.spread + b.spread
        threshold = (a.mean * b.spread + b.mean * a.spread) / spread if spread else (a.mean + b.mean) / 2
    return scores.select("url", "score"), threshold if math.isfinite(threshold) else 0.0


def filter_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id_col, host, path, rule, verdict, score, threshold) of every row: the longest rule's verdict, else the models'."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(id_col), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"))
    rule, said = fitting_rule(F.col("host"), F.col("path"), rules)
    distinct = rows.groupBy("url").agg(F.count("*").alias("n")).withColumn("host", host).withColumn("path", path)
    scores, threshold = url_scores(distinct.select("url", "n", said.alias("seed")))
    known = materialise(distinct.select("url", "n").join(scores, "url", "left"), "url-known")
    met = join_counted(rows, known, "url", "n").withColumn("host", host).withColumn("path", path)
    by_model = F.when(F.coalesce("score", F.lit(0.0)) >= threshold, "allow").otherwise("block")
    return met.select(id_col, "host", "path", rule.alias("rule"), F.coalesce(said, by_model).alias("verdict"), "score", F.lit(threshold).alias("threshold"))
