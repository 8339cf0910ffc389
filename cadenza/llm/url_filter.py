"""URL filter: rules first, then the ratio of two character language models.

The models are variable-order Markov models of accepted and of rejected URLs, those that a rule decides. A
character's probability is interpolated over all orders up to ``order`` (Witten-Bell): each context leaves as
much to the next shorter one as it has different continuations. A URL's score is the mean, over its characters,
of the difference of log-probabilities; the threshold is set on labelled URLs that were kept from training.

Everything is joins and sums of grams. The probabilities are found level by level on distinct grams, where a
gram has no more neighbours than there are characters, so no key is hot. Log-ratios are whole numbers of
millionths, which makes sums exact and reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm import common

#: The rules as they were given, longest wins.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
#: A text begins and ends with these, which no URL holds.
BEGIN, END = "\u0002", "\u0003"
#: Probability of any character where nothing is known.
FLOOR = 1 / 256
UNIT = 1e6
#: One labelled URL of so many sets the threshold, the others train.
HELD = 5


def host_of(url: Column) -> Column:
    """From the first :// up to /, ?, # or the end, A-Z in lower case; empty without :// or for null."""
    return common.lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """From the host's end up to ?, # or the end; empty without :// or for null."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    """The longest rule that fits, as (rule, verdict); null if none does. Of equally long ones the first."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(reversed(rules), key=lambda r: len(r[0])):
        of_host, slash, rest = rule.partition("/")
        fits = ((host == of_host) | F.endswith(host, F.lit("." + of_host))) & F.startswith(path, F.lit(slash + rest))
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _grams(text: Column, order: int) -> Column:
    """For each character after the first, it with up to ``order`` before it."""
    places = F.sequence(F.lit(2), F.char_length(text))
    return F.transform(
        places, lambda i: F.substr(text, F.greatest(F.lit(1), i - order), F.least(i, F.lit(order + 1)))
    )


def log_ratios(grams: DataFrame, order: int) -> DataFrame:
    """Rows (gram, ratio): millionths of log P(accepted) - log P(rejected) of each gram's last character.

    ``grams`` has (gram, accepted, rejected), the counts of grams of up to ``order`` + 1 characters; a
    gram may have none. Shorter orders are summed from them.
    """
    ends = F.transform(F.sequence(F.lit(1), F.char_length("gram")), lambda n: F.right(F.col("gram"), n))
    suffixes = grams.select(F.explode(ends).alias("gram"), "accepted", "rejected")
    counts = suffixes.groupBy("gram").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
    context = F.expr("left(gram, char_length(gram) - 1)")
    counts = common.written(counts.withColumn("context", context).withColumn("size", F.char_length("gram")), "grams")
    contexts = counts.groupBy("context").agg(
        F.sum("accepted").alias("_na"),
        F.sum("rejected").alias("_nr"),
        F.count(F.when(F.col("accepted") > 0, 1)).alias("_ta"),
        F.count(F.when(F.col("rejected") > 0, 1)).alias("_tr"),
    )
    known = common.written(counts.join(contexts, "context"), "contexts")

    def level(rows: DataFrame, before: Column, was: Column) -> list[Column]:
        pa = (F.col("accepted") + F.col("_ta") * before) / (F.col("_na") + F.col("_ta"))
        pr = (F.col("rejected") + F.col("_tr") * was) / (F.col("_nr") + F.col("_tr"))
        return [
            F.when(F.col("_na") > 0, pa).otherwise(before).alias("pa"),
            F.when(F.col("_nr") > 0, pr).otherwise(was).alias("pr"),
        ]

    first = known.where("size = 1")
    found = common.written(first.select("gram", *level(first, F.lit(FLOOR), F.lit(FLOOR))), "level")
    every = found
    for size in range(2, order + 2):
        rows = known.where(F.col("size") == size).withColumn("_shorter", F.expr("right(gram, char_length(gram) - 1)"))
        shorter = found.select(F.col("gram").alias("_shorter"), F.col("pa").alias("_pa"), F.col("pr").alias("_pr"))
        joined = rows.join(shorter, "_shorter")
        found = common.written(joined.select("gram", *level(joined, F.col("_pa"), F.col("_pr"))), "level")
        every = every.union(found)
    ratio = F.round((F.log("pa") - F.log("pr")) * UNIT).cast("long")
    return every.select("gram", ratio.alias("ratio"))


def judge(
    pages: DataFrame,
    rules: tuple[tuple[str, str], ...] = RULES,
    order: int = 4,
    url: str = "url",
    ids: str = "page_id",
    whole: bool = False,
) -> DataFrame:
    """One row per page: ``ids``, ``host``, ``path``, ``rule``, ``verdict``, ``score``, ``threshold``.

    A rule's verdict stands; of the others those with a score of at least the threshold are allowed. Models
    and threshold are learnt from the pages that a rule decides. Null or odd URLs have an empty host
    and path and are judged like any other text. Rows of one id are separate pages.

    ``whole``: the models learn and score the URL as it is, a null one as the empty text, and host and path are
    for the rules only. Otherwise they see host and path alone, so URLs that differ elsewhere score the same.
    """
    judged = ["url"] if whole else ["host", "path"]
    parsed = pages.select(
        F.col(ids).alias("id"),
        F.coalesce(F.col(url), F.lit("")).alias("url"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
    )
    parsed = parsed.withColumn("_match", matched(F.col("host"), F.col("path"), rules))
    parsed = parsed.select("id", "url", "host", "path", "_match.rule", F.col("_match.verdict").alias("label"))
    text = F.concat(F.lit(BEGIN), *judged, F.lit(END))
    held = F.pmod(F.xxhash64(*judged), F.lit(HELD)) == 0
    trains = F.col("label").isNotNull() & ~held
    # equal texts are scored once, with their number of pages
    texts = parsed.groupBy(*judged, "label").agg(F.count("*").cast("long").alias("pages"))
    texts = common.written(texts.withColumn("held", held).withColumn("text", F.xxhash64(*judged)), "texts")
    own = texts.withColumn("_own", text).select(
        "text",
        F.when(trains & (F.col("label") == "allow"), F.col("pages")).otherwise(0).alias("accepted"),
        F.when(trains & (F.col("label") == "block"), F.col("pages")).otherwise(0).alias("rejected"),
        F.explode(_grams(F.col("_own"), order)).alias("gram"),
    )
    top = own.groupBy("gram").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
    ratios = common.written(log_ratios(common.written(top, "top"), order), "ratios")
    scored = (
        own.select("text", "gram")
        .join(ratios, "gram")
        .groupBy("text")
        .agg((F.sum("ratio") / F.count("*") / UNIT).alias("score"))
    )
    scored = common.written(texts.join(scored, "text"), "scored")
    threshold = calibrated(scored.where("held AND label IS NOT NULL"))
    same = [F.col(f"p.{c}") == F.col(f"s.{c}") for c in judged]
    result = parsed.alias("p").join(scored.select(*judged, "score").alias("s"), same)
    model = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return result.select(
        F.col("p.id").alias(ids),
        F.col("p.host").alias("host"),
        F.col("p.path").alias("path"),
        F.col("p.rule").alias("rule"),
        F.coalesce("p.label", model).alias("verdict"),
        "score",
        F.lit(threshold).alias("threshold"),
    )


def calibrated(scored: DataFrame, step: float = 0.01, most: float = 6.0) -> float:
    """The score with the least sum of both error rates on labelled URLs, of steps nearest 0 the first.

    0.0 if one of the labels is missing. Scores are counted in steps, so few rows reach the driver.
    """
    place = F.round(F.greatest(F.lit(-most), F.least(F.lit(most), F.col("score"))) / step).cast("int")
    counts = scored.groupBy(place.alias("place")).agg(
        F.sum(F.when(F.col("label") == "allow", F.col("pages")).otherwise(0)).alias("a"),
        F.sum(F.when(F.col("label") == "block", F.col("pages")).otherwise(0)).alias("b"),
    )
    below = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1))
    missed = F.coalesce(F.sum("a").over(below), F.lit(0)) / F.sum("a").over(everything)
    passed = 1 - F.coalesce(F.sum("b").over(below), F.lit(0)) / F.sum("b").over(everything)
    rates = counts.select("place", F.sum("a").over(everything).alias("na"), F.sum("b").over(everything).alias("nb"), "a", "b")
    if not rates.where("na > 0 AND nb > 0").limit(1).count():
        return 0.0
    best = counts.select("place", F.round(missed + passed, 12).alias("errors")).orderBy("errors", F.abs("place"), "place").first()
    return round((best.place - 0.5) * step, 6)


def op6_url_language_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's whole URL, judged by the rules or else by the models."""
    return judge(common.table(spark, sf_dir, "pages"), whole=True)
