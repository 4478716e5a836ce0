"""Personal data: fixed forms as seeds, and bootstrapped contextual extraction beyond them.

Only DataFrame and SQL functions run. Positions are code points, ends exclusive.

1. Base spans of four kinds are found in every text. A regex splits a text into the parts
   between its matches, and lengths of parts and matches give the places.
2. Tokens with a digit or an at sign outside base spans are candidates, and so are groups of
   numbers parted by single blanks. The words around base spans (seeds) and candidates make
   lexical patterns: word before, two words before, words on both sides.
3. Patterns and instances form a graph with counted edges. In turns, a pattern's confidence for
   a kind is the smoothed share of its instances' scores, and a candidate's score is the
   noisy-or of its patterns. Seeds keep a score of one.
4. Candidates in the contexts of confident, well supported patterns become spans of that kind
   if their shape is likely for it: the share of the kind's seeds that have the same form and
   about as many digits, whatever the separators and prefixes. A span inside a longer one that
   is added falls out.

A null text is empty and has no span. Rows are documents: repeated and null ids stay apart. The
work on a text grows little more than its length, however many spans it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelpulse.llm.common import stash, whole_text

KINDS = ("email", "ip", "card", "phone")

# Each finds what the contract's pattern finds, in time linear in the text: a run of characters
# is entered at its start only (or where the last match ended) and not given back.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])(?=[0-9](?:[ -]?[0-9]){12})[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
CANDIDATE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
# Numbers that may hold brackets, dots, slashes and hyphens; a plus is at the front only.
GROUP = (
    r"(?<![^\x20\x09-\x0D])[+(]?[0-9][0-9().+/-]*+"
    r"(?:\x20[(]?[0-9][0-9().+/-]*+(?![^\x20\x09-\x0D,;:!?]))++"
)
NEAR_DIGITS = 2  # seeds with so many digits more or less count for a shape
LEAST_SHAPE = 0.05
CONTEXT = 60  # code points on either side of an instance that hold its context
CUT = 1_000  # code points of the pieces that contexts are looked up in
PIECE = 300  # matches whose places are summed at a time

LUHN = """aggregate(
    sequence(1, length(d)), 0,
    (sum, k) -> sum + CASE
        WHEN k % 2 = 1 THEN int(substr(d, -k, 1))
        WHEN int(substr(d, -k, 1)) > 4 THEN 2 * int(substr(d, -k, 1)) - 9
        ELSE 2 * int(substr(d, -k, 1)) END,
    sum -> sum % 10 = 0)"""
VALID = {
    "email": "true",
    "ip": "forall(split(s.value, '[.]'), p -> double(p) <= 255)",
    "card": "exists(array(regexp_replace(s.value, '[ -]', '')), d -> length(d) BETWEEN 13 AND 19 AND "
    + LUHN
    + ")",
    "phone": "length(regexp_replace(s.value, '[^0-9]', '')) BETWEEN 9 AND 15",
}
FIELDS = "s.start AS start, s.end AS end, s.value AS value"
NO_SPANS = "cast(array() AS array<struct<start: bigint, end: bigint, value: string>>)"


def _length(piece: Column) -> Column:
    """Code points of a piece of pairs (text before, match)."""
    zero = F.lit(0).cast("bigint")
    return F.aggregate(piece, zero, lambda n, p: n + F.length(p["before"]) + F.length(p["value"]))


def _spans_of(piece: Column, at: Column) -> Column:
    """The spans of a piece of pairs that begins at a code point."""

    def add(state: Column, pair: Column) -> Column:
        begin = (state["at"] + F.length(pair["before"])).cast("bigint")
        end = (begin + F.length(pair["value"])).cast("bigint")
        span = F.struct(begin.alias("start"), end.alias("end"), pair["value"].alias("value"))
        return F.struct(end.alias("at"), F.array_append(state["found"], span).alias("found"))

    start = F.struct(at.alias("at"), F.expr(NO_SPANS).alias("found"))
    return F.aggregate(piece, start, add, lambda state: state["found"])


def _placed(pairs: Column) -> Column:
    """All spans of pairs: lengths are summed over pieces of ``PIECE``, then within each piece.

    So appending copies short arrays only, and the work grows little more than their number.
    """

    def piece(k: Column) -> Column:
        return F.slice(pairs, k * PIECE + 1, F.lit(PIECE))

    last = F.floor((F.greatest(F.size(pairs), F.lit(1)) - 1) / PIECE).cast("int")
    numbers = F.sequence(F.lit(0), last)
    begins = F.aggregate(  # where each piece begins; and, too many, where the last one ends
        F.transform(numbers, lambda k: _length(piece(k))),
        F.array(F.lit(0).cast("bigint")),
        lambda sums, n: F.array_append(sums, F.element_at(sums, -1) + n),
    )
    both = F.filter(F.arrays_zip(numbers.alias("k"), begins.alias("at")), lambda p: p["k"].isNotNull())
    return F.flatten(F.transform(both, lambda p: _spans_of(piece(p["k"]), p["at"])))


def spans(text: Column, pattern: str) -> Column:
    """All matches with their places: ``array<struct<start, end, value>>``."""

    def pairs(parts: Column) -> Column:
        return F.arrays_zip(
            F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))).alias("before"),
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value"),
        )

    # Arrays of one hold what is used several times, so that it is made once.
    paired = F.transform(F.array(F.split(text, pattern, -1)), pairs)
    return F.element_at(F.transform(paired, _placed), 1)


def base_spans(docs: DataFrame) -> DataFrame:
    """``docs`` (with a non-null ``text``) and an array of valid spans per kind."""
    for kind in KINDS:
        found = spans(F.col("text"), PATTERNS[kind])
        if NEEDS[kind]:
            there = F.instr("text", NEEDS[kind]) > 0
        else:
            there = F.col("text").rlike(r"[0-9](?:[ -]?[0-9]){12}")
        docs = docs.withColumn(kind, F.when(there, found).otherwise(F.expr(NO_SPANS)))
        docs = docs.withColumn(kind, F.expr(f"filter({kind}, s -> {VALID[kind]})"))
    return docs


def with_places(docs: DataFrame) -> DataFrame:
    """Adds ``places``: seeds (with kind) and candidates (kind null) with the text around.

    The text is cut in pieces of ``CUT`` code points, so that a context is looked up in two short
    pieces and not in the whole text.
    """
    seeds = "concat(" + ", ".join(f"transform({k}, s -> struct('{k}' AS kind, {FIELDS}))" for k in KINDS) + ")"
    nothing = F.expr(NO_SPANS)
    candidates = F.concat(
        F.when(F.col("text").rlike("[0-9@]"), spans(F.col("text"), CANDIDATE)).otherwise(nothing),
        F.when(F.col("text").rlike(r"[0-9).+/-]\x20[(]?[0-9]"), spans(F.col("text"), GROUP)).otherwise(nothing),
    )
    open_ = f"transform(candidates, s -> struct(cast(NULL AS string) AS kind, {FIELDS}))"

    def around(first: str, local: str, length: str) -> str:
        """Text from a code point on: from the piece that holds it and the next."""
        piece = f"int({first} div {CUT})"
        both = f"concat(get(cuts, {piece}), coalesce(get(cuts, {piece} + 1), ''))"
        return f"coalesce(substring({both}, int({local}) + 1, int({length})), '')"

    begin = f"greatest(s.start - {CONTEXT}, 0)"
    left = around(begin, f"{begin} % {CUT}", f"least(s.start, {CONTEXT})")
    right = around("s.end", f"s.end % {CUT}", str(CONTEXT))
    return (
        docs.withColumn("seeds", F.expr(seeds))
        .withColumn("candidates", candidates)
        .withColumn("cuts", F.regexp_extract_all("text", F.lit(f"(?s).{{1,{CUT}}}"), F.lit(0)))
        .withColumn(
            "places",
            F.expr(
                f"transform(concat(seeds, {open_}), s -> struct(s.kind AS kind, {FIELDS}, "
                f"{left} AS left, {right} AS right))"
            ),
        )
        .drop("seeds", "candidates", "cuts")
    )


def apart_from_seeds(places: DataFrame) -> DataFrame:
    """The seeds, and the candidates that overlap none of their row.

    In the order of starts, a candidate overlaps a seed if one before reaches beyond its start, or
    the next one starts before its end.
    """
    seed = F.col("kind").isNotNull()
    order = (F.col("start"), F.when(seed, 0).otherwise(1), F.col("end"))
    inside = Window.partitionBy("row")
    before = inside.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = inside.orderBy(*(c.desc() for c in order)).rowsBetween(Window.unboundedPreceding, -1)
    reach = F.max(F.when(seed, F.col("end"))).over(before)
    following = F.min(F.when(seed, F.col("start"))).over(after)
    clear = F.coalesce(reach <= F.col("start"), F.lit(True)) & F.coalesce(following >= F.col("end"), F.lit(True))
    return places.withColumn("clear", seed | clear).where("clear").drop("clear")


def outermost(found: DataFrame) -> DataFrame:
    """Spans (``row``, ``kind``, ``start``, ``end``) that lie inside no longer one of their row."""
    distinct = found.groupBy("row", "start", "end").agg(F.collect_set("kind").alias("kinds"))
    before = (
        Window.partitionBy("row")
        .orderBy("start", F.desc("end"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        distinct.withColumn("reach", F.max("end").over(before))
        .where("reach IS NULL OR reach < end")
        .select("row", F.explode("kinds").alias("kind"), "start", "end")
    )


def patterned(places: DataFrame) -> DataFrame:
    """Replaces the text around by the lexical patterns it makes, and adds the shape."""
    gap = "[\\x20\\x09-\\x0D]+"

    def words(side: str) -> Column:
        """Lower-cased words around an instance; a run of digits counts as 0."""
        plain = F.regexp_replace(F.lower(F.col(side)), "[0-9]+", "0")
        return F.filter(F.split(plain, gap), lambda w: w != "")

    before = F.coalesce(F.try_element_at(words("left"), F.lit(-1)), F.lit("^"))
    earlier = F.coalesce(F.try_element_at(words("left"), F.lit(-2)), F.lit("^"))
    after = F.coalesce(F.try_element_at(words("right"), F.lit(1)), F.lit("$"))
    return places.select(
        "row",
        "kind",
        "start",
        "end",
        "value",
        form(F.col("value")).alias("form"),
        digits(F.col("value")).alias("digits"),
        F.array(
            F.concat(F.lit("1 "), before),
            F.concat_ws(" ", F.lit("2"), earlier, before),
            F.concat_ws(" ", F.lit("3"), before, F.lit("_"), after),
        ).alias("patterns"),
    )


def form(value: Column) -> Column:
    """Address, four numbers with dots, other digits, or other; punctuation at the ends is dropped."""
    core = F.regexp_replace(value, r"^[^\p{L}0-9@]+|[^\p{L}0-9]+$", "")
    return (
        F.when(core.rlike(r"^[^@]+@[^@]+$"), "address")
        .when(core.rlike(r"^[0-9]+(?:[.][0-9]+){3}$"), "dots")
        .when(~core.rlike(r"[\p{L}@]"), "digits")
        .otherwise("other")
    )


def digits(value: Column) -> Column:
    """Number of digits where they alone make the form, else 0."""
    return F.when(form(value) == "digits", F.length(F.regexp_replace(value, "[^0-9]", ""))).otherwise(0)


def likely_shapes(places: DataFrame) -> DataFrame:
    """``kind``, ``form``, ``digits`` that enough of the kind's seeds have, or nearly have."""
    seen = places.where("kind is not null").groupBy("kind", "form", "digits").agg(F.count("*").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy("kind"))
    near = F.when(
        F.col("form") == "digits",
        F.sequence(F.col("digits") - NEAR_DIGITS, F.col("digits") + NEAR_DIGITS),
    ).otherwise(F.array("digits"))
    return (
        seen.select("kind", "form", share.alias("share"), F.explode(near).alias("digits"))
        .groupBy("kind", "form", "digits")
        .agg(F.sum("share").alias("score"))
        .where((F.col("score") >= LEAST_SHAPE) & (F.col("form") != "other"))
        .select("kind", "form", "digits")
    )


def bootstrap(
    places: DataFrame, rounds: int = 3, least_support: int = 5, least_confidence: float = 0.8
) -> DataFrame:
    """Candidate instances (``value``, ``kind``, ``score``) that confident patterns yield.

    The graph has a node per distinct value and per distinct pattern, so frequent ones are
    counted edges. Of several kinds the best score wins, ties go to the first name.
    """
    edges = stash(
        places.select("value", "kind", F.explode("patterns").alias("pattern"))
        .groupBy("pattern", "value", "kind")
        .agg(F.count("*").alias("n")),
        "edges",
    )
    seeds = edges.where("kind is not null")
    # Candidates only matter under patterns that some seed has.
    seeded = seeds.groupBy("pattern").agg(F.count_distinct("value").alias("support"))
    open_ = edges.where("kind is null").drop("kind")
    size = edges.groupBy("pattern").agg(F.sum("n").alias("all"))
    mass = seeds.groupBy("pattern", "kind").agg(F.sum("n").alias("mass"), F.count_distinct("value").alias("support"))
    graph = stash(open_.join(seeded.select("pattern"), "pattern", "left_semi"), "graph")
    base = stash(mass.join(size, "pattern"), "patterns")
    scores = None
    for _ in range(rounds):
        if scores is None:
            patterns = base.withColumn("gain", F.lit(0.0))
        else:
            gain = (
                graph.join(scores, "value").groupBy("pattern", "kind").agg(F.sum(F.expr("n * score")).alias("gain"))
            )
            patterns = base.join(gain, ["pattern", "kind"], "left").fillna(0.0, ["gain"])
        confident = patterns.select(
            "pattern", "kind", "support", ((F.col("mass") + F.col("gain")) / (F.col("all") + 1.0)).alias("confidence")
        ).where(F.col("confidence") > 0.05)
        scores = stash(
            graph.join(confident, "pattern")
            .groupBy("value", "kind")
            .agg(
                (1 - F.exp(F.sum(F.log(1 - F.least("confidence", F.lit(0.999)))))).alias("score"),
                F.max(
                    (F.col("confidence") >= least_confidence) & (F.col("support") >= least_support)
                ).alias("sure"),
            ),
            "scores",
        )
    best = F.row_number().over(Window.partitionBy("value").orderBy(F.desc("score"), "kind"))
    return (
        scores.where("sure").withColumn("best", best).where((F.col("best") == 1) & (F.col("score") >= least_confidence))
        .select("value", "kind", "score")
    )


def personal_data(docs: DataFrame) -> DataFrame:
    """Base columns of the contract, all spans, and ``n_found`` spans that the method adds.

    Returns ``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone``, ``base_sha256``,
    ``spans``, ``n_found``; counts and digest hold base spans only.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        whole_text().alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    held = stash(with_places(base_spans(rows)).drop("text"), "places")
    listed = held.select("row", F.explode("places").alias("p")).select("row", "p.*")
    places = stash(patterned(apart_from_seeds(listed)), "instances")
    found = (
        places.where("kind is null")
        .drop("kind")
        .join(bootstrap(places), "value")
        .join(likely_shapes(places), ["kind", "form", "digits"], "left_semi")
    )
    added = outermost(found).groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("added"))
    order = "CASE s.kind " + " ".join(f"WHEN '{k}' THEN {n}" for n, k in enumerate(KINDS)) + " END"
    base = "concat(" + ", ".join(
        f"transform({k}, s -> struct('{k}' AS kind, s.start AS start, s.end AS end))" for k in KINDS
    ) + ")"
    joined = "concat_ws(',', transform({0}, s -> concat_ws(':', s.kind, s.start, s.end)))"
    return (
        held.join(added, "row", "left")
        .withColumn("base", F.expr(base))
        .withColumn("added", F.expr("coalesce(added, filter(base, s -> false))"))
        .withColumn(
            "all",
            F.expr(
                f"transform(array_sort(transform(concat(base, added), s -> struct({order} AS k, s.start, s.end, "
                "s.kind))), s -> s)"
            ),
        )
        .select(
            "doc_id",
            *(F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS),
            F.sha2(F.expr(joined.format("base")), 256).alias("base_sha256"),
            F.expr(joined.format("all")).alias("spans"),
            F.size("added").cast("bigint").alias("n_found"),
        )
    )
