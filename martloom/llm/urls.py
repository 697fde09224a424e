"""URL filter: rules by host and path, and a character language model for the rest.

URLs that a rule allows and URLs that a rule blocks train a Markov model each. A
character is predicted from the two before it; its share there is mixed with that from
one character, from none, and from a uniform alphabet (Witten-Bell: the weight of the
shorter context is the share of first occurrences in the longer one). A URL's score is
the mean difference of its two log-likelihoods per character. The cut is calibrated on a
quarter of the training URLs that the models have not seen: between the mean scores of
both kinds, each at the same number of its standard deviations.

Characters are folded to 64 symbols, so the model is a table of 64^3 rows whatever the
input, and is broadcast.

Defined results: a null URL or one without ``://`` has empty host and path, matches no
rule and scores as the text it has (null: 0); without URLs of both kinds the score is 0
and all others are allowed; equal URLs get equal verdicts; an empty table gives an empty
table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.session import stored

#: (rule, verdict): host and path of a rule are split at its first slash.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"),
         ("com/de/", "block"))
SYMBOLS, SEED = 64, 5


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    whole_host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    host = F.translate(whole_host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(F.substring(rest, F.length(whole_host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none."""
    rule = verdict = F.lit(None).cast("string")
    for name, says in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # longer ones wrap shorter ones
        own_host, slash, rest = name.partition("/")
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, name).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def trigrams(url: Column) -> Column:
    """Every character with the two before it, as numbers below 64^3."""
    folded = F.transform(F.split(F.upper(F.coalesce(url, F.lit(""))), ""), lambda c: F.when(
        F.ascii(c).between(33, 95), F.ascii(c) - 32).otherwise(F.lit(0)))
    padded = F.concat(F.array(F.lit(0), F.lit(0)), folded)
    return F.transform(F.sequence(F.lit(1), F.size(folded)), lambda i: (
        F.element_at(padded, i) * SYMBOLS * SYMBOLS + F.element_at(padded, i + 1) * SYMBOLS + F.element_at(padded, i + 2)))


def _mixed(n: str, shorter: Column, *context: str) -> Column:
    """Share of ``third`` after ``context``, mixed with its share after a shorter one."""
    by = Window.partitionBy(*context)
    here = F.sum(n).over(Window.partitionBy(*context, "third"))
    total, kinds = F.sum(n).over(by), F.size(F.collect_set(F.when(F.col(n) > 0, F.col("third"))).over(by))
    return F.when(total > 0, (here + kinds * shorter) / (total + kinds)).otherwise(shorter)


def model(training: DataFrame) -> DataFrame:
    """(gram, llr): log-likelihood difference of every trigram; empty where one kind of
    URL is missing. ``training`` has grams and accepted."""
    counts = (training.select("accepted", F.explode("grams").alias("gram"))
              .groupBy("gram").agg(F.sum(F.col("accepted").cast("int")).alias("yes"), F.sum((~F.col("accepted")).cast("int")).alias("no")))
    codes = training.sparkSession.range(SYMBOLS ** 3).select(F.col("id").cast("int").alias("gram"))
    full = codes.join(counts, "gram", "left").select(
        "gram", F.coalesce("yes", F.lit(0)).alias("yes"), F.coalesce("no", F.lit(0)).alias("no"),
        F.shiftright("gram", 12).alias("first"), F.shiftright("gram", 6).bitwiseAND(F.lit(63)).alias("second"),
        F.col("gram").bitwiseAND(F.lit(63)).alias("third"))
    # Without context: one row per symbol.
    alone = full.groupBy("third").agg(F.sum("yes").alias("s_yes"), F.sum("no").alias("s_no"))
    every = Window.partitionBy(F.lit(0))
    alone = alone.withColumns({f"all_{k}": F.struct(F.sum(f"s_{k}").over(every).alias("n"), F.sum(
        (F.col(f"s_{k}") > 0).cast("int")).over(every).alias("kinds")) for k in ("yes", "no")}).select("third", *[
        F.when(F.col(f"all_{k}.n") > 0, (F.col(f"s_{k}") + F.col(f"all_{k}.kinds") / SYMBOLS)
               / (F.col(f"all_{k}.n") + F.col(f"all_{k}.kinds"))).otherwise(1.0 / SYMBOLS).alias(f"p_{k}") for k in ("yes", "no")])
    full = full.join(alone, "third")
    log = {k: F.log(_mixed(k, _mixed(k, F.col(f"p_{k}"), "second"), "first", "second")) for k in ("yes", "no")}
    scored = full.select("gram", "yes", "no", (log["yes"] - log["no"]).cast("float").alias("llr"))
    both = counts.agg(F.coalesce((F.sum("yes") > 0) & (F.sum("no") > 0), F.lit(False))).scalar()
    return scored.filter(both).select("gram", "llr")


def mean_scores(rows: DataFrame, llr: DataFrame) -> DataFrame:
    """``rows`` (with grams) with score in place of grams. A row's characters meet again
    in the task that read it, so what is shuffled is one sum per row."""
    keys = [c for c in rows.columns if c != "grams"]
    known = F.broadcast(llr)  # at most 64^3 rows of 8 bytes
    return (rows.withColumn("row", F.monotonically_increasing_id()).select("row", *keys, F.explode("grams").alias("gram"))
            .join(known, "gram", "left").groupBy("row", *keys)
            .agg(F.avg(F.coalesce(F.col("llr").cast("double"), F.lit(0.0))).alias("score")).drop("row"))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score for every row."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url")
    host, path = host_and_path(F.col("url"))
    parts = rows.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    parts = parts.withColumns({"rule": rule, "by_rule": verdict})
    training = parts.filter("by_rule IS NOT NULL").select(
        (F.col("by_rule") == "allow").alias("accepted"), trigrams(F.col("url")).alias("grams"),
        (F.pmod(F.xxhash64("url", F.lit(SEED)), F.lit(4)) == 0).alias("held"))
    training = stored(training, "url_training")
    llr = stored(model(training.filter("NOT held")), "url_model")
    held = mean_scores(training.filter("held").select("accepted", "grams"), llr)
    by_kind = held.groupBy("accepted").agg(F.avg("score").alias("mean"), F.coalesce(F.stddev_pop("score"), F.lit(0.0)).alias("sd"))
    side = lambda want, c: F.max(F.when(F.col("accepted") == want, F.col(c)))
    spread = side(True, "sd") + side(False, "sd")
    cut = by_kind.agg(F.coalesce(F.when(spread > 0, (side(True, "mean") * side(False, "sd") + side(False, "mean") * side(True, "sd")) / spread)
                                 .otherwise((side(True, "mean") + side(False, "mean")) / 2), F.lit(0.0)).alias("cut"))
    cut = stored(cut, "url_cut").scalar()
    scored = mean_scores(parts.withColumn("grams", trigrams(F.col("url"))).drop("url"), llr)
    return scored.select("page_id", "host", "path", "rule", F.coalesce(
        "by_rule", F.when(F.col("score") >= cut, "allow").otherwise("block")).alias("verdict"), "score")
