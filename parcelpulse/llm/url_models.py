"""URL filter: rules first, then the ratio of two character language models.

A URL that a rule fits has the rule's verdict. All URLs decided so are the training text of two
variable-order Markov models, one of allowed and one of blocked URLs. A character's probability
after a context is its share after the longest context of up to ``ORDER`` characters, smoothed by
the shorter ones (Witten and Bell): with n of N occurrences and d different successors,
p = (n + d p') / (N + d), where p' is that of the context without its first character; below the
empty context all characters have ``UNSEEN``. A context never met leaves p' as it is.

The score of a URL is the mean log-likelihood difference over its characters and its end. Three in
sixteen decided URLs, by their hash, are kept from the counts: the threshold is the one with the least
mean error rate on them, taken from counts per hundredth of score. Other URLs are allowed at or
above it. Without held-out URLs of both verdicts it is 0; without training text all scores are 0.

Every decided URL is counted, repeated ones as often as they stand. Models are tables of
distinct stretches of ``ORDER`` + 1 characters, made by grouped sums and joined level by level on
keys that at most one row per character shares; URLs are scored through a join on stretches, in which
the most frequent ones are broadcast (``lookup``). Only the error counts, some ten thousand rows
at most, reach the driver.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to
``?``, ``#`` or the end. A null URL or one without ``://`` has both empty and is judged by its end mark alone.
The longest fitting rule wins; of equally long ones that with the longer host. Rows are pages: ids may
repeat or be null. Columns other than ``page_id`` and ``url`` are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelpulse.llm.common import lookup, stash, whole_text

ORDER = 5
UNSEEN = 1 / 256
HELD_OUT = ("0", "1", "2")  # first hexadecimal digits of the hash of held-out URLs
SCORE_LIMIT = 20  # scores are counted between minus and plus this
BEGIN, END = "\x02", "\x03"

# Verdict, host and path of the contract's rules.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def address(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    text = whole_text(url)
    after = F.when(F.instr(text, "://") > 0, F.substring(text, F.instr(text, "://") + 3, F.length(text)))
    after = F.coalesce(after, F.lit(""))
    host = F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)


def ruling(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule, as text, and its verdict; null without one."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1])))
    fits = [
        ((host == r_host) | host.endswith("." + r_host)) & path.startswith(r_path) for _, r_host, r_path in ordered
    ]

    def first(values: list[str]) -> Column:
        chosen = [F.when(fit, value) for fit, value in zip(fits, values, strict=True)]
        return F.coalesce(*chosen, F.lit(None).cast("string"))

    return first([r[1] + r[2] for r in ordered]), first([r[0] for r in ordered])


def _stretches(texts: DataFrame) -> DataFrame:
    """A row per character of each text, and one for its end, with the characters before it."""
    padded = F.split(F.concat(F.lit(BEGIN * ORDER), F.col("address"), F.lit(END)), "")
    begin = F.explode(F.sequence(F.lit(1), F.size("chars") - ORDER)).alias("begin")
    return (
        texts.withColumn("chars", padded)
        .select(*texts.columns, "chars", begin)
        .withColumn("gram", F.array_join(F.slice("chars", F.col("begin"), ORDER + 1), ""))
        .drop("chars", "begin")
    )


def _probabilities(counts: DataFrame) -> DataFrame:
    """``gram``, ``asked``, ``p_allow``, ``p_block`` of the last character after those before it."""
    shorter = None
    for order in range(ORDER + 1):
        gram = F.substring("gram", ORDER + 1 - order, order + 1)
        level = (
            counts.groupBy(gram.alias("gram"))
            .agg(F.sum("asked").alias("asked"), F.sum("allow").alias("allow"), F.sum("block").alias("block"))
            .withColumn("tail", F.substring("gram", 2, order))
        )
        # At most one row per character shares a context or a tail.
        here = Window.partitionBy(F.substring("gram", 1, order))
        for kind in ("allow", "block"):
            level = level.withColumn(f"n_{kind}", F.sum(kind).over(here)).withColumn(
                f"d_{kind}", F.sum(F.when(F.col(kind) > 0, 1).otherwise(0)).over(here)
            )
        if shorter is None:
            level = level.withColumn("q_allow", F.lit(UNSEEN)).withColumn("q_block", F.lit(UNSEEN))
        else:
            level = level.join(
                shorter.select(
                    F.col("gram").alias("tail"), F.col("p_allow").alias("q_allow"), F.col("p_block").alias("q_block")
                ),
                "tail",
            )
        shorter = level.select("gram", "asked", *(_smoothed(kind) for kind in ("allow", "block")))
    return shorter


def _smoothed(kind: str) -> Column:
    own, total, kinds, wider = (F.col(f"{c}{kind}") for c in ("", "n_", "d_", "q_"))
    return F.when(total > 0, (own + kinds * wider) / (total + kinds)).otherwise(wider).alias(f"p_{kind}")


def _scores(texts: DataFrame) -> DataFrame:
    """``texts`` to be scored, with ``score``."""

    def weight(kind: str) -> Column:
        return F.sum(F.when((F.col("label") == kind) & ~F.col("held"), F.col("n")).otherwise(0)).alias(kind)

    asked = F.col("label").isNull() | F.col("held")
    counts = stash(
        _stretches(texts.select("address", "label", "held", "n"))
        .groupBy("gram")
        .agg(F.count(F.when(asked, 1)).alias("asked"), weight("allow"), weight("block")),
        "url-counts",
    )
    ratios = stash(
        _probabilities(counts)
        .where("asked > 0")
        .select("gram", "asked", (F.log("p_allow") - F.log("p_block")).alias("ratio")),
        "url-ratios",
    )
    wanted = texts.where(asked)
    sums = (
        lookup(_stretches(wanted.select("text_id", "address")).select("text_id", "gram"), ratios, ["gram"], "asked")
        .groupBy("text_id")
        .agg(F.avg("ratio").alias("score"))
    )
    return stash(wanted.join(sums, "text_id"), "url-scores")


def threshold(scored: DataFrame) -> float:
    """The hundredth of score with the least mean error rate on held-out URLs; the nearest to 0 of several."""
    limit = 100 * SCORE_LIMIT
    step = F.least(F.greatest(F.floor(F.col("score") * 100), F.lit(-limit)), F.lit(limit)).cast("int")
    rows = scored.where("held").groupBy("label", step.alias("step")).agg(F.sum("n").alias("n")).collect()
    totals = {kind: sum(r["n"] for r in rows if r["label"] == kind) for kind in ("allow", "block")}
    if not all(totals.values()):
        return 0.0
    change: dict[int, float] = {}
    for r in rows:  # a threshold above a step rejects the URLs of the step
        worth = r["n"] / totals[r["label"]]
        change[r["step"]] = change.get(r["step"], 0.0) + (worth if r["label"] == "allow" else -worth)
    steps = sorted(change)
    error, candidates = 1.0, []  # at or below the first step all is allowed
    for low, high in zip([-limit, *(s + 1 for s in steps)], [*steps, limit + 1], strict=True):
        error += change.get(low - 1, 0.0)
        nearest = min(max(0, low), high)  # all thresholds from low to high judge alike
        candidates.append((round(error, 9), abs(nearest), nearest))
    return min(candidates)[2] / 100


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, and the method's ``score`` where no rule fits."""
    host, path = address(F.col("url").cast("string"))
    rule, label = ruling(F.col("host"), F.col("path"), rules)
    judged = (
        pages.select(F.col("page_id").cast("bigint").alias("page_id"), host.alias("host"), path.alias("path"))
        .withColumn("rule", rule)
        .withColumn("label", label)
        .withColumn("address", F.concat("host", "path"))
    )
    held = F.substring(F.md5("address"), 1, 1).isin(*HELD_OUT) & F.col("label").isNotNull()
    texts = stash(
        judged.groupBy("address")
        .agg(F.first("label").alias("label"), F.count("*").alias("n"))
        .withColumn("held", held)
        .withColumn("text_id", F.monotonically_increasing_id()),
        "urls",
    )
    scored = _scores(texts)
    least = threshold(scored)
    by_rule = judged.where("rule is not null").select(
        "page_id", "host", "path", "rule", F.col("label").alias("verdict"), F.lit(None).cast("double").alias("score")
    )
    by_model = lookup(
        judged.where("rule is null"), scored.where("label is null").select("address", "n", "score"), ["address"], "n"
    ).select(
        "page_id",
        "host",
        "path",
        "rule",
        F.when(F.floor(F.col("score") * 100) >= round(100 * least), "allow").otherwise("block").alias("verdict"),
        "score",
    )
    return by_rule.unionByName(by_model)
