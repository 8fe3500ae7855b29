"""Personal data by candidate spans and gradient-boosted trees.

Base patterns find emails, IP addresses, card and phone numbers in their usual forms; a check drops those that can't be
real. Wide patterns, one or more per kind, propose spans in looser forms, which overlap each other and the base. Candidates that
cover a base span are positive examples; those that fail the kind's check, touch other word characters, lie on a span
of another kind, or pass but follow words of other numbers (order, version, token) are negative ones. Trees are boosted
on a bounded sample of both, on the form of the span and what is around it, without the signs that define the base forms
or the labels. Candidates that are neither are then scored, and redacted beyond a threshold per kind. It is taken from
held-out examples like those scored: real ones, and negative ones that only the words before them tell. Base spans always
stay. A kind with too few real examples held out, or whose scores don't separate, adds nothing; ``judged`` names the
kinds that have a threshold.

All of it is column expressions, aggregations and windows, and Spark's own boosted trees. Texts are read once, and only
spans with a few characters around them go on from there.

Positions count code points from 0, ends are exclusive. Defined results: a null or empty text has no spans; rows that
repeat, ids among them, each get a row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.session import stage

# The kinds in their order, and the base forms. Runs are possessive and start where a run starts, which
# finds the same spans in time that grows with the text alone. \G is where the span before ended.
KINDS = ["email", "ip", "card", "phone"]
CARD, PHONE, RUNS = 2, 3, 4
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": [
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:@|[\[({]\x20?at\x20?[\])}])\x20?[A-Za-z0-9-]++"
        r"(?:\x20?(?:\.|[\[({]\x20?dot\x20?[\])}])\x20?[A-Za-z0-9-]++)*+"
    ],
    "ip": [
        r"(?<![0-9])[0-9]{1,3}+\x20?[.,:]\x20?[0-9]{1,3}+\x20?[.,:]\x20?[0-9]{1,3}+\x20?[.,:]\x20?[0-9]{1,3}+",
    ],
    "card": [
        r"(?<![0-9])[0-9](?:[\x20./-]{0,2}+[0-9]){11,18}(?![0-9])",
        r"(?<![0-9])[0-9]{12,19}(?![0-9])",
        r"(?<![0-9])[0-9]{4}(?:[\x20-][0-9]{4}){2}[\x20-][0-9]{1,7}(?![0-9])",
    ],
    "phone": [
        r"(?<![0-9])\+?\(?[0-9](?:[\x20()./-]{0,3}+[0-9]){6,15}(?![0-9])",
        r"\+[0-9]{1,3}[\x20-]?\(?[0-9]{2,4}\)?[\x20-]?[0-9]{3,4}[\x20-]?[0-9]{3,4}(?![0-9])",
    ],
}
# Numbers side by side: runs of groups of digits, cut at their separators. Every sequence of neighbouring groups whose
# digits are as many as a kind's is proposed, as a phone or, without brackets and long separators, as a card.
RUN = r"(?<![0-9])\+?\(?[0-9]++(?:[\x20()./-]{1,3}+[0-9]++)*+"
PREFIX = r"^\+?\(?"
AS_CARD = r"^[0-9](?:[\x20./-]{0,2}+[0-9])*+$"
CARD_DIGITS, PHONE_DIGITS = (12, 19), (9, 15)
# Texts that hold none of these have no spans of any kind.
SIGNS = r"[0-9@]|[\[({]\x20?at\x20?[\])}]"
# Words that go before personal data, and words and signs that go before other numbers.
NEARBY = {
    "email": r"mail|contact|write|address",
    "ip": r"\bip\b|host|server|client|from",
    "card": r"card|visa|credit|payment|paid",
    "phone": r"tel|phone|call|fax|mobile",
    "other": r"order|invoice|version|isbn|token|password|passwd|secret|key|id\b|no\.|#|=|[\"']",
}

# Characters kept on either side of a span; examples the trees are grown on, on average, trees, and their depth.
AROUND = 24
SAMPLE_ROWS = 20_000
TREES = 10
DEPTH = 3
SEED = 5
# One example in so many is held out; the part of the held-out spans beyond a threshold that must be real, and how many
# real ones there must be; bins of scores.
HELD_OUT = 4
PRECISION = 0.995
LEAST_REAL = 20
BINS = 1000

FEATURES = [
    "kind", "length", "digits", "letters", "separators", "different_separators", "groups", "longest_group",
    "near_own", "line_start", "after_word", "before_stop",
]


def _found(spans: Column, pieces: Column, around: int) -> Column:
    """A pattern's spans in order, from the spans and the pieces of text around them: the characters before each since
    the last, the span, and its surroundings."""
    n = F.size(spans)
    before, after = F.slice(pieces, F.lit(1), n), F.slice(pieces, F.lit(2), n)
    return F.arrays_zip(
        F.transform(before, F.length).alias("skip"),
        spans.alias("span"),
        F.transform(before, lambda p: F.right(p, F.lit(around))).alias("before"),
        F.transform(after, lambda p: F.left(p, F.lit(around))).alias("after"),
    )


def matches(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every document's row number and id, and its base and wide spans: the one pass over the texts.

    Each pattern cuts a text once; what is taken from the pieces is a column of its own, so that nothing is cut again
    for every span.
    """
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    some = docs.select(F.col("doc_id").cast("bigint"), content.alias("text")).withColumn(
        "row", F.monotonically_increasing_id()
    )
    with_signs = F.when(F.col("text").rlike(SIGNS), F.col("text")).otherwise(F.lit(""))
    patterns = [(i, n, p) for i, name in enumerate(KINDS) for n, p in enumerate([BASE[name], *WIDE[name]])]
    patterns.append((RUNS, 1, RUN))
    cut = some.select("row", "doc_id", with_signs.alias("text")).select(
        "row",
        "doc_id",
        *[F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(f"spans_{i}_{n}") for i, n, p in patterns],
        *[F.split("text", p, -1).alias(f"pieces_{i}_{n}") for i, n, p in patterns],
    )
    kind = "array<struct<skip:int,span:string,before:string,after:string>>"
    columns = [
        F.struct(
            F.lit(i).alias("kind"),
            F.lit(n).alias("form"),
            _found(F.col(f"spans_{i}_{n}"), F.col(f"pieces_{i}_{n}"), AROUND if n else 0).cast(kind).alias("found"),
        )
        for i, n, _ in patterns
    ]
    every = F.filter(F.array(*columns), lambda c: F.size(c["found"]) > 0)
    return stage(cut.select("row", "doc_id", every.alias("matches")), "matches")


def candidates(found: DataFrame) -> DataFrame:
    """One row per span with its place, whether it has the base form, and whether its check holds."""
    each = found.select("row", F.explode("matches").alias("m")).select(
        "row", "m.kind", "m.form", F.posexplode("m.found").alias("nth", "s")
    )
    order = Window.partitionBy("row", "kind", "form").orderBy("nth")
    passed = F.sum(F.col("s.skip") + F.length("s.span")).over(order)
    placed = (
        each.withColumn("end", passed)
        .withColumn("start", F.col("end") - F.length("s.span"))
        .withColumn("base", F.col("form") == 0)
    )
    plain = placed.filter(F.col("kind") != RUNS)
    placed = plain.select("row", "kind", "form", "base", "start", "end", "s.span", "s.before", "s.after").unionByName(
        side_by_side(placed.filter(F.col("kind") == RUNS))
    )
    same = Window.partitionBy("row", "kind", "base", "start", "end").orderBy("form")
    once = placed.withColumn("copy", F.row_number().over(same)).filter("copy = 1")
    digits = F.regexp_replace("span", "[^0-9]", "")
    return once.withColumn("digits", digits).withColumn("checked", checked()).select(
        "row", "kind", "base", "start", "end", "checked", "digits", "span", "before", "after"
    )


def side_by_side(runs: DataFrame) -> DataFrame:
    """Of runs of digit groups, every sequence of neighbouring groups that has as many digits as a card or a phone.

    Every group is a row with the groups that follow it, as many as the longest card has digits. A sequence's digits
    are the difference of two running sums. From the start of a group, at most one sequence has a given number of
    digits: they grow with the text alone.
    """
    least, most = PHONE_DIGITS[0], CARD_DIGITS[1]
    cut = runs.filter(F.length(F.regexp_replace("s.span", "[^0-9]", "")) >= least).select(
        "row",
        F.col("start").alias("from"),
        F.col("s.before").alias("ahead"),
        F.col("s.after").alias("behind"),
        F.regexp_extract_all("s.span", F.lit("[0-9]++"), F.lit(0)).alias("numbers"),
        F.split("s.span", "[0-9]++", -1).alias("gaps"),
    )
    zipped = F.arrays_zip(F.slice("gaps", F.lit(1), F.size("numbers")).alias("gap"), F.col("numbers").alias("number"))
    groups = cut.select("row", "from", "ahead", "behind", F.posexplode(zipped).alias("nth", "g")).select(
        "row", "from", "ahead", "behind", "nth", "g.gap", F.length("g.number").alias("n"), F.concat("g.gap", "g.number").alias("piece")
    )
    order = Window.partitionBy("row", "from").orderBy("nth")
    passed = order.rowsBetween(Window.unboundedPreceding, 0)

    def text_of(piece: Column, first: int, last: int) -> Column:
        return F.array_join(F.collect_list(piece).over(order.rowsBetween(first, last)), "")

    # A group has a digit at least: as many groups as characters are enough for the surroundings.
    lead = F.when(F.col("nth") == 0, F.regexp_extract("gap", PREFIX, 0)).otherwise(F.regexp_extract("gap", r"(?<=.)\($", 0))
    ahead = F.concat("ahead", text_of(F.right("piece", F.lit(AROUND)), -AROUND, -1), F.left("gap", F.length("gap") - F.length("prefix")))
    placed = (
        groups.withColumn("prefix", lead)
        .withColumn("end", F.col("from") + F.sum(F.length("piece")).over(passed))
        .withColumn("total", F.sum("n").over(passed))
        .withColumn("before", F.right(ahead, F.lit(AROUND)))
        .withColumn("after", F.left(F.concat(text_of(F.left("piece", F.lit(AROUND)), 1, AROUND), "behind"), F.lit(AROUND)))
        .withColumn("start", F.col("end") - F.col("n") - F.length("prefix"))
    )
    # Longer groups are in no sequence.
    short = F.when(F.col("n") <= most, F.col("piece"))
    follower = F.struct("nth", "total", "end", "after", short.alias("piece"))
    shorter = F.col("total") - F.col("n")
    each = (
        placed.withColumn("following", F.collect_list(follower).over(order.rowsBetween(0, most - 1)))
        .withColumn("fits", F.filter("following", lambda f: (f["total"] - shorter).between(least, most)))
        .select(
            "row", "nth", "start", "before", "prefix", "gap", shorter.alias("shorter"),
            F.col("following.piece").alias("pieces"), F.explode("fits").alias("f"),
        )
        .withColumn("joined", F.array_join(F.slice("pieces", F.lit(1), F.col("f.nth") - F.col("nth") + 1), ""))
        .withColumn("number", F.substr("joined", F.length("gap") + 1))
        .withColumn("n", F.col("f.total") - F.col("shorter"))
    )
    phone = F.struct(
        F.lit(PHONE).alias("kind"), F.lit(len(WIDE["phone"]) + 1).alias("form"), F.col("start"),
        F.concat("prefix", "number").alias("span"), F.col("before"),
    )
    card = F.struct(
        F.lit(CARD).alias("kind"), F.lit(len(WIDE["card"]) + 1).alias("form"),
        (F.col("start") + F.length("prefix")).alias("start"), F.col("number").alias("span"),
        F.right(F.concat("before", "prefix"), F.lit(AROUND)).alias("before"),
    )
    both = F.array(
        F.when(F.col("n") <= PHONE_DIGITS[1], phone),
        F.when((F.col("n") >= CARD_DIGITS[0]) & F.col("number").rlike(AS_CARD), card),
    )
    return each.select("row", "f", F.explode(F.filter(both, lambda c: c.isNotNull())).alias("c")).select(
        "row", "c.kind", "c.form", F.lit(False).alias("base"), "c.start", F.col("f.end").alias("end"),
        "c.span", "c.before", F.col("f.after").alias("after"),
    )


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    places = F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1)))

    def add(total: Column, i: Column) -> Column:
        value = F.coalesce(F.substr(F.reverse(digits), i, F.lit(1)).try_cast("int"), F.lit(0))
        twice = F.when(i % 2 == 0, 2 * value).otherwise(value)
        return total + F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(places, F.lit(0), add) % 10 == 0


def checked() -> Column:
    """The check of a span's kind; of the wide forms, what the base form would make of it."""
    n, span = F.length("digits"), F.col("span")
    parts = F.filter(F.split(span, r"[^0-9]+", -1), lambda p: p != "")
    mail = F.regexp_replace(F.regexp_replace(span, r"[\[({]\x20?dot\x20?[\])}]", "."), r"\x20", "")
    return (
        F.when(F.col("kind") == 0, F.col("base") | mail.rlike(r"\.[A-Za-z]{2,}$"))
        .when(F.col("kind") == 1, F.forall(parts, lambda p: p.try_cast("decimal(38,0)") <= 255))
        .when(F.col("kind") == 2, F.when(n.between(*CARD_DIGITS), luhn(F.col("digits"))).otherwise(F.lit(False)))
        .otherwise(n.between(*PHONE_DIGITS))
    )


def base_spans(spans: DataFrame) -> DataFrame:
    return spans.filter(F.col("base") & F.coalesce("checked", F.lit(False))).select("row", "kind", "start", "end")


def examples(spans: DataFrame) -> DataFrame:
    """The wide spans with their features and ``label``: 1 over a base span, 0 if they can't be real, else null.

    Those that cut a base span of their kind short are parts of what stays anyway, and are left out."""
    real = F.col("base") & F.coalesce("checked", F.lit(False))
    some = spans.filter(~F.col("base") | real)

    def overlaps(*keys: str) -> Column:
        """Whether a base span that starts no later ends beyond this one's start, or one that starts later does so
        before this one's end. Base spans come first where starts are equal."""
        order = Window.partitionBy(*keys).orderBy("start", F.desc("base"), "end")
        upto = F.max(F.when(F.col("base"), F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
        back = Window.partitionBy(*keys).orderBy(F.desc("start"), "base", F.desc("end"))
        following = F.min(F.when(F.col("base"), F.col("start"))).over(back.rowsBetween(Window.unboundedPreceding, -1))
        return F.coalesce(upto > F.col("start"), F.lit(False)) | F.coalesce(following < F.col("end"), F.lit(False))

    # Base spans of a kind don't overlap: of those that start no earlier, the first ends first.
    back = Window.partitionBy("row", "kind").orderBy(F.desc("start"), F.desc("base"), F.desc("end"))
    later = back.rowsBetween(Window.unboundedPreceding, -1)
    covers = F.coalesce(F.min(F.when(F.col("base"), F.col("end"))).over(later) <= F.col("end"), F.lit(False))
    marked = (
        some.withColumn("on_own", overlaps("row", "kind"))
        .withColumn("on_any", overlaps("row"))
        .withColumn("covers", covers)
    )
    wide = marked.filter(~F.col("base") & (F.col("covers") | ~F.col("on_own")))
    touches = F.col("before").rlike("[A-Za-z0-9_]$") | F.col("after").rlike("^[A-Za-z0-9_]")
    near = F.lower("before")
    own = F.lit(False)
    for i, name in enumerate(KINDS):
        own = F.when(F.col("kind") == i, near.rlike(NEARBY[name])).otherwise(own)
    rest = F.regexp_replace("span", "[0-9A-Za-z]", "")
    groups = F.filter(F.split("span", "[^0-9A-Za-z]+", -1), lambda g: g != "")
    passes = F.coalesce("checked", F.lit(False))
    refused = ~passes | touches | F.col("on_any")
    label = F.when(F.col("covers"), 1.0).when(refused | near.rlike(NEARBY["other"]), 0.0)
    features = {
        "length": F.length("span"),
        "letters": F.length(F.regexp_replace("span", "[^A-Za-z]", "")),
        "separators": F.length(rest),
        "different_separators": F.size(F.array_distinct(F.split(rest, ""))),
        "groups": F.size(groups),
        "longest_group": F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)),
        "near_own": own,
        "line_start": F.col("before").rlike(r"(^|\n)\s*$"),
        "after_word": F.col("before").rlike(r"[A-Za-z][:,]?\x20?$"),
        "before_stop": F.col("after").rlike(r"^[.,;:]?(\s|$)"),
    }
    return wide.select(
        "row",
        "start",
        "end",
        label.alias("label"),
        (F.col("covers") | ~refused).alias("alike"),
        (F.pmod(F.xxhash64(F.lit(SEED), "row", "kind", "start"), F.lit(HELD_OUT)) == 0).alias("held_out"),
        F.col("kind").cast("double").alias("kind"),
        F.length("digits").cast("double").alias("digits"),
        *[c.cast("double").alias(name) for name, c in features.items()],
    )


def thresholds(scored: DataFrame) -> dict[int, float]:
    """By kind, the lowest score beyond which enough held-out examples are real, of those that pass all that is asked of
    a span before it is scored; one row per bin comes to the driver."""
    bins = (
        scored.filter(F.col("held_out") & F.col("alike") & F.col("label").isNotNull())
        .groupBy("kind", F.least(F.floor(F.col("score") * BINS), F.lit(BINS - 1)).alias("bin"))
        .agg(F.sum("label").alias("real"), F.count("*").alias("n"))
        .collect()
    )
    found: dict[int, float] = {}
    for kind in {r["kind"] for r in bins}:
        real = n = 0.0
        for r in sorted((r for r in bins if r["kind"] == kind), key=lambda r: -r["bin"]):
            real, n = real + r["real"], n + r["n"]
            if real >= LEAST_REAL and real >= PRECISION * n:
                found[int(kind)] = r["bin"] / BINS
    return found


def added_spans(spans: DataFrame) -> tuple[DataFrame, list[str]]:
    """Spans beyond the base that the trees select, and the kinds that have a threshold."""
    table = stage(examples(spans), "examples")
    nothing = table.filter(F.lit(False)).select("row", F.col("kind").cast("int"), "start", "end")
    labelled = table.filter(~F.col("held_out") & F.col("label").isNotNull())
    chance = F.lit(SAMPLE_ROWS / max(1, labelled.count()))
    drawn = F.pmod(F.xxhash64(F.lit(SEED + 1), "row", "start", "kind"), F.lit(2**40)) / F.lit(float(2**40))
    sample = stage(labelled.filter(drawn < chance), "sample")
    if sample.select("label").distinct().count() < 2:
        return nothing, []
    trees = GBTClassifier(
        featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, seed=SEED, checkpointInterval=-1
    )
    model = Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), trees]).fit(sample)
    scored = model.transform(table).withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    limits = thresholds(scored)
    if not limits:
        return nothing, []
    limit = F.lit(None).cast("double")
    for kind, value in limits.items():
        limit = F.when(F.col("kind") == kind, F.lit(value)).otherwise(limit)
    chosen = scored.filter(F.col("label").isNull() & (F.col("score") >= limit))
    return joined(chosen), [KINDS[kind] for kind in sorted(limits)]


def joined(chosen: DataFrame) -> DataFrame:
    """Spans of a kind that overlap in a chain as one span, so that nothing of what was accepted is left out."""
    by_place = Window.partitionBy("row", "kind").orderBy("start", "end")
    reached = F.max("end").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    apart = F.coalesce(F.col("start") >= reached, F.lit(True)).cast("int")
    chained = chosen.withColumn("apart", apart).withColumn("chain", F.sum("apart").over(by_place))
    found = chained.groupBy("row", "kind", "chain").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return found.select("row", F.col("kind").cast("int"), "start", "end")


def find_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: id, its spans as structs (start, kind, end, base) in order, where ``kind`` indexes KINDS,
    and the kinds to which the trees could add spans."""
    found = matches(docs, text)
    spans = stage(candidates(found), "spans")
    added, judged = added_spans(spans)
    every = base_spans(spans).withColumn("base", F.lit(True)).unionByName(added.withColumn("base", F.lit(False)))
    grouped = every.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "base"))).alias("spans"))
    return (
        found.select("row", "doc_id")
        .join(grouped, "row", "left")
        .select(
            "row",
            "doc_id",
            F.coalesce("spans", F.expr("array()").cast(grouped.schema["spans"].dataType)).alias("spans"),
            F.lit(",".join(judged)).alias("judged"),
        )
    )


def listed(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    name = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans are replaced as one."""
    name = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(state: Column, s: Column) -> Column:
        between = F.substr(text, state["at"] + 1, s["start"].cast("int") - state["at"])
        longer = F.concat(state["out"], between, F.get(name, s["kind"]))
        apart = s["start"] >= state["at"]
        return F.struct(
            F.when(apart, longer).otherwise(state["out"]).alias("out"),
            F.greatest(state["at"], s["end"].cast("int")).alias("at"),
        )

    return F.aggregate(
        spans, start, step, lambda s: F.concat(s["out"], F.substr(text, s["at"] + 1, F.greatest(F.length(text), F.lit(1))))
    )
