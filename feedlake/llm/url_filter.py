"""A filter of URLs: host and path rules first, character language models for the rest.

URLs that a rule allows or blocks are the examples of two character models. A model gives each
character a probability after the characters before it, up to CONTEXT of them. The estimate at
each length of context is mixed with that of the next shorter one, the more so the more
different characters have followed the context and the less often it was seen (Witten and
Bell's smoothing), down to an even chance for every character.

A URL scores the mean, over its characters, of the logarithm of the two models' ratio. The score
to pass is calibrated on examples that the models have not seen. Everything is a count or a join
of counts: texts and n-grams are aggregated before they are shuffled, and what is counted grows
with the URLs.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.frames import fresh, written

#: Characters of context.
CONTEXT = 3
#: Marks before the first character and after the last. No URL holds control characters.
START, END = "\x02", "\x03"
#: Of the examples, those whose MD5 sum starts with one of these digits calibrate the score.
CALIBRATION = "012"
#: Scores are calibrated in steps of 1 / STEPS, from -LIMIT to LIMIT.
STEPS, LIMIT = 100, 10
#: N-grams of a model, some 50 bytes each, up to which it is sent to all executors.
BROADCAST_ROWS = 200_000

ALLOW, BLOCK = "allow", "block"
#: (verdict, host, path), as the registered query uses them.
RULES = (
    (ALLOW, "com", "/"),
    (BLOCK, "example.com", "/en/"),
    (ALLOW, "www.example.com", "/en/"),
    (BLOCK, "net", "/es/"),
    (BLOCK, "net", "/fr/"),
)
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path. Both are empty if the URL is null or has no `://`."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(url, start + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, CAPITALS, CAPITALS.lower()), path


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The rule that fits, as host and path in one, and its verdict; null if none fits.

    A rule fits its host and all subdomains, if the path starts with its path. The longest
    wins, and of equally long ones that with the longer host.
    """
    rule = verdict = F.lit(None).cast("string")
    for says, at, below in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(below)
        rule = F.when(fits, F.lit(at + below)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """Adds host, path, rule and verdict to pages (url and any other columns).

    Columns of those names are replaced. verdict is that of the rule that fits, else `allow` if
    the URL scores at least as calibrated, and `block` if not. If rules give examples of one
    verdict only, or none, every other URL scores 0 and is allowed. A null url, or one without
    `://`, is judged as an empty text. An empty table gives no rows.
    """
    plain = pages.drop("host", "path", "rule", "verdict")
    host, path = parts(F.col("url"))
    rows = plain.withColumn("host", host).withColumn("path", path)
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("verdict", verdict)
    text, says, told = (fresh(rows, name) for name in ("judged_text", "says", "judged_score"))
    rows = rows.withColumn(text, F.concat("host", "path"))
    texts = written(
        rows.groupBy(F.col(text).alias("text")).agg(
            F.count(F.when(F.col("verdict") == ALLOW, 1)).alias("allowed"),
            F.count(F.when(F.col("verdict") == BLOCK, 1)).alias("blocked"),
        ),
        "texts",
    )
    scored = written(scores(texts), "scores")
    least = threshold(scored)
    judged = scored.where("allowed + blocked = 0").select(
        F.col("text").alias(told), F.when(F.col("score") >= least, ALLOW).otherwise(BLOCK).alias(says)
    )
    by_rule = rows.where("verdict is not null")
    by_model = rows.where("verdict is null").join(judged, F.col(text) == F.col(told))
    by_model = by_model.withColumn("verdict", F.col(says)).drop(says, told)
    return by_rule.unionByName(by_model).drop(text)


def _calibrates(text: Column) -> Column:
    return F.substring(F.md5(text), 1, 1).isin(*CALIBRATION)


def _grams(texts: DataFrame) -> DataFrame:
    """Every character of every text with the CONTEXT characters before it, as gram."""
    padded = F.concat(F.lit(START * CONTEXT), "text", F.lit(END))
    place = F.explode(F.sequence(F.lit(1), F.length("text") + 1)).alias("place")
    rows = texts.withColumn("padded", padded).select("*", place)
    gram = F.substring(F.col("padded"), F.col("place"), F.lit(CONTEXT + 1))
    return rows.withColumn("gram", gram).drop("padded", "place")


def scores(texts: DataFrame) -> DataFrame:
    """Adds score to texts (text, allowed, blocked: how often each is an example).

    Models are made of the examples that do not calibrate.
    """
    grams = _grams(texts)
    taught = ~_calibrates(F.col("text"))
    counts = grams.groupBy("gram").agg(
        F.sum(F.when(taught, F.col("allowed")).otherwise(0)).alias("allowed"),
        F.sum(F.when(taught, F.col("blocked")).otherwise(0)).alias("blocked"),
    )
    ratios = _ratios(written(counts, "grams"))
    if ratios.count() <= BROADCAST_ROWS:
        ratios = F.broadcast(ratios)
    # Steps of 2 ** -30 add up exactly, in whatever order.
    ratio = F.round(F.col("ratio") * 2**30).cast("long")
    summed = grams.select("text", "gram").join(ratios, "gram").groupBy("text").agg(
        F.sum(ratio).alias("total"), F.count("*").alias("n")
    )
    score = (F.col("total") / 2**30 / F.col("n")).alias("score")
    return texts.join(summed, "text").select("text", "allowed", "blocked", score)


def _ratios(counts: DataFrame) -> DataFrame:
    """Per gram the logarithm of how much likelier its last character is to the first model."""
    sides = ("allowed", "blocked")
    shares = None
    for order in range(CONTEXT + 1):
        gram = F.substring(F.col("gram"), CONTEXT + 1 - order, order + 1)
        seen = counts.groupBy(gram.alias("g")).agg(*[F.sum(side).alias(side) for side in sides])
        seen = seen.withColumn("context", F.substring("g", 1, order))
        context = seen.groupBy("context").agg(
            *[F.sum(side).alias(f"{side}_n") for side in sides],
            *[F.count(F.when(F.col(side) > 0, 1)).alias(f"{side}_kinds") for side in sides],
        )
        joined = seen.join(context, "context")
        if shares is None:
            known = F.lit(float(seen.count()))  # the characters there are
            joined = joined.withColumns({f"{side}_less": 1 / known for side in sides})
        else:
            less = shares.select(
                F.col("g").alias("shorter"), *[F.col(f"{side}_p").alias(f"{side}_less") for side in sides]
            )
            joined = joined.withColumn("shorter", F.substring("g", 2, order)).join(less, "shorter")
        for side in sides:
            n, kinds = F.col(f"{side}_n"), F.col(f"{side}_kinds")
            mixed = (F.col(side) + kinds * F.col(f"{side}_less")) / (n + kinds)
            share = F.when(n > 0, mixed).otherwise(F.col(f"{side}_less"))
            joined = joined.withColumn(f"{side}_p", share)
        shares = written(joined.select("g", *[f"{side}_p" for side in sides]), "shares")
    ratio = F.log("allowed_p") - F.log("blocked_p")
    taught = counts.agg(F.sum("allowed").alias("a"), F.sum("blocked").alias("b")).first()
    if not taught["a"] or not taught["b"]:
        ratio = F.lit(0.0)
    return written(shares.select(F.col("g").alias("gram"), ratio.alias("ratio")), "ratios")


def threshold(scored: DataFrame) -> float:
    """The score that parts the calibrating examples best: the largest share of allowed ones at
    or above it, plus share of blocked ones below it. Of equally good ones the lowest, and of
    those between two examples the middle; 0 if either kind has no example."""
    step = F.floor(F.col("score") * STEPS)
    step = F.least(F.greatest(step, F.lit(-LIMIT * STEPS)), F.lit(LIMIT * STEPS)).alias("step")
    examples = scored.where(_calibrates(F.col("text")) & (F.col("allowed") + F.col("blocked") > 0))
    steps = examples.groupBy(step).agg(F.sum("allowed").alias("a"), F.sum("blocked").alias("b"))
    below = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)  # 2001 rows
    everything = Window.partitionBy(F.lit(0))
    passed = steps.select(
        "step",
        F.coalesce(F.lag("step").over(Window.orderBy("step")) + 1, F.col("step")).alias("open"),
        F.coalesce(F.sum("a").over(below), F.lit(0)).alias("missed"),
        F.coalesce(F.sum("b").over(below), F.lit(0)).alias("caught"),
        F.sum("a").over(everything).alias("a"),
        F.sum("b").over(everything).alias("b"),
    ).where("a > 0 and b > 0")
    gain = F.col("caught") * F.col("a") - F.col("missed") * F.col("b")
    best = passed.orderBy(gain.desc(), "step").first()
    return (best["open"] + best["step"]) / 2 / STEPS if best else 0.0
