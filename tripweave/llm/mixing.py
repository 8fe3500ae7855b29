"""Mixing sources to target weights by iterative proportional fitting, with sampling by calibrated probabilities.

Token weights are raked until the expected tokens of the sample meet the target shares of sources, languages and topics
at once. A document's probability is its source's factor times its language's times its topic's, at most one; factors
of sources are solved exactly in each sweep with that limit in place, those of languages and topics are then adjusted.

Sources may be many: their weights stay in a table with one row per source and one number per pair of language and
topic class, and a sweep is one aggregation of it to one row. Languages and topics are those named in the targets; all
others, null among them, form one class that gets what the named ones leave. If they leave nothing, that class keeps its
share of all tokens, and the named targets are parts of the rest. A class without tokens has the mean factor.

A source that has fewer tokens than its target is taken whole and falls short. A language or topic is never asked for
more than nine tenths of its tokens; the others share what is left of its target. Targets of sources are their tokens to
the power ``flatten``: 1 keeps their shares, 0 makes them equal. Targets that can't be met at once end after ``SWEEPS``
sweeps: the rows then say ``converged`` false, and a sample is drawn with a warning.

Defined results: a null or empty text weighs nothing and is kept with its class's probability; a null source is a
source of its own; a null id is drawn like any other, and rows that repeat an id are drawn together; with no tokens at
all, and in an empty table, every row has probability zero; other columns pass through untouched.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.session import stage

# The largest part of a language's or topic's tokens that is asked for: near all of them, its factor has no bound.
MOST = 0.9
# Sweeps at most, and how near the shares must come to their targets, as a part of each.
SWEEPS = 60
NEAR = 1e-5
# Of the shares, what rounding may leave.
NOTHING = 1e-9
# Factors are moved somewhat further than one step alone would, which takes fewer sweeps.
RELAX = 1.5
# Steps of the uniform numbers that documents are drawn with.
STEPS = 2**52

OTHER = "*"


@dataclass
class Mix:
    """Factors of the languages and topics, and the table of the sources' factors."""

    languages: dict[str, float]
    topics: dict[str, float]
    sources: DataFrame
    sweeps: int
    deviation: float

    @property
    def converged(self) -> bool:
        return self.deviation <= NEAR


def word_count(text: Column) -> Column:
    """Words between blanks of ASCII; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def class_of(value: Column, targets: dict[str, float]) -> Column:
    return F.when(value.isin(list(targets)), value).otherwise(F.lit(OTHER))


def _shares(targets: dict[str, float], found: dict[str, float]) -> dict[str, float]:
    """Target shares of the classes that have tokens, adding up to one."""
    left = max(0.0, 1.0 - sum(targets.values()))
    if left <= NOTHING and found.get(OTHER, 0.0) > 0:
        left = found[OTHER] / sum(found.values())
        named = sum(w for c, w in targets.items() if found.get(c, 0.0) > 0)
        targets = {c: w * (1.0 - left) / named for c, w in targets.items()} if named else {}
    wanted = {c: targets.get(c, left if c == OTHER else 0.0) for c, tokens in found.items() if tokens > 0}
    total = sum(wanted.values())
    return {c: (w / total if total else 1.0 / len(wanted)) for c, w in wanted.items()}


def within_reach(shares: dict[str, float], owned: dict[str, float], budget: float) -> dict[str, float]:
    """Shares of which none asks for more than ``MOST`` of a class's tokens; what is cut off goes to the others, in
    proportion. If all are at that limit, they add up to less than one."""
    limit = {c: MOST * owned[c] / budget for c in shares}
    held: dict[str, float] = {}
    while True:
        rest = {c: s for c, s in shares.items() if c not in held}
        left = 1.0 - sum(held.values())
        total = sum(rest.values())
        scaled = {c: s * left / total if total else 0.0 for c, s in rest.items()}
        over = {c: limit[c] for c, s in scaled.items() if s > limit[c]}
        if not over:
            return {c: held.get(c, scaled.get(c, 0.0)) for c in shares}
        held |= over


def _literals(values: list[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])


def source_factor(target: Column, x: list[float]) -> Column:
    """The factor a with sum(w * min(1, a * x)) = target, for the array column ``weights`` in the order of x.

    The sum is the least of one line in a for each set of cells held at one; the sets are the first of the cells by
    falling x. So the factor is the largest of the lines' solutions, or large enough to hold all cells.
    """
    enough = 1.0 / min((v for v in x if v > 0), default=float("inf"))
    cells = F.zip_with("weights", _literals(x), lambda w, v: F.struct((-v).alias("x"), w.alias("w")))
    product = F.aggregate(cells, F.lit(0.0), lambda s, c: s - c["x"] * c["w"])
    start = F.struct(F.lit(0.0).alias("held"), product.alias("slope"), F.lit(0.0).alias("best"))

    def hold(state: Column, c: Column) -> Column:
        # What rounding leaves of a slope that has been used up is no slope.
        solution = F.when(state["slope"] > 1e-12 * product, (target - state["held"]) / state["slope"])
        return F.struct(
            (state["held"] + c["w"]).alias("held"),
            (state["slope"] + c["x"] * c["w"]).alias("slope"),
            F.greatest(state["best"], F.coalesce(solution, F.lit(0.0))).alias("best"),
        )

    best = F.aggregate(F.array_sort(cells), start, hold, lambda s: s["best"])
    usable = F.aggregate(cells, F.lit(0.0), lambda s, c: s + F.when(c["x"] < 0, c["w"]).otherwise(0.0))
    return F.when(target >= usable, F.lit(enough)).otherwise(F.least(best, F.lit(enough)))


def rake(
    weights: DataFrame,
    languages: dict[str, float],
    topics: dict[str, float],
    keep: float,
    flatten: float,
) -> Mix:
    """Fit factors to rows (source, language, topic, tokens) whose languages and topics are classes."""
    pairs = [(lang, topic) for lang in [*languages, OTHER] for topic in [*topics, OTHER]]
    cell = {p: F.sum(F.when((F.col("language") == p[0]) & (F.col("topic") == p[1]), F.col("tokens"))) for p in pairs}
    table = stage(
        weights.groupBy("source").agg(
            F.sum("tokens").cast("double").alias("total"),
            F.array(*[F.coalesce(c, F.lit(0)).cast("double") for c in cell.values()]).alias("weights"),
        ),
        "source-weights",
    )

    def summed(cells: Column) -> list[Column]:
        return [F.sum(F.get(cells, F.lit(i))).alias(f"w{i}") for i in range(len(pairs))]

    # A source without tokens has nothing to sample; zero to the power zero would give it a share.
    flat = F.when(F.col("total") > 0, F.pow("total", F.lit(flatten))).otherwise(F.lit(0.0))
    first = table.agg(
        F.sum("total").alias("all"), F.sum(flat).alias("flat"), *summed(F.col("weights"))
    ).first()
    budget = keep * (first["all"] or 0.0)
    if not budget:
        nothing = table.select("source", F.lit(0.0).alias("factor"))
        return Mix(dict.fromkeys([*languages, OTHER], 0.0), dict.fromkeys([*topics, OTHER], 0.0), nothing, 0, 0.0)

    def margins(cells: list[float], side: int) -> dict[str, float]:
        out: dict[str, float] = {}
        for pair, tokens in zip(pairs, cells, strict=True):
            out[pair[side]] = out.get(pair[side], 0.0) + tokens
        return out

    owned = [first[f"w{i}"] for i in range(len(pairs))]
    wanted = []
    for side, targets in enumerate((languages, topics)):
        found = margins(owned, side)
        wanted.append(within_reach(_shares(targets, found), found, budget))
    factors = [{c: 1.0 if c in w else 0.0 for c in margins(owned, side)} for side, w in enumerate(wanted)]
    share = flat / F.lit(first["flat"])

    deviation, sweeps = float("inf"), 0
    while True:
        x = [factors[0][lang] * factors[1][topic] for lang, topic in pairs]
        factor = source_factor(share * budget, x)
        drawn = F.zip_with("weights", _literals(x), lambda w, v: w * F.least(F.lit(1.0), F.col("factor") * v))
        row = table.withColumn("factor", factor).agg(*summed(drawn)).first()
        cells = [row[f"w{i}"] for i in range(len(pairs))]
        all_ = sum(cells)
        deviation = max(
            (
                abs(margins(cells, side)[c] / all_ - s / sum(wanted[side].values())) / s
                for side in (0, 1)
                for c, s in wanted[side].items()
                if s > 0
            ),
            default=0.0,
        )
        sweeps += 1
        if deviation <= NEAR or sweeps == SWEEPS:
            for side in (0, 1):
                own = margins(owned, side)
                mean = sum(factors[side][c] * n for c, n in own.items()) / sum(own.values())
                factors[side] = {c: f if own[c] else mean for c, f in factors[side].items()}
            return Mix(factors[0], factors[1], table.select("source", factor.alias("factor")), sweeps, deviation)
        for side in (0, 1):
            have = margins(cells, side)
            asked = all_ / sum(wanted[side].values())
            step = {c: s * asked / have[c] if have[c] else 1.0 for c, s in wanted[side].items()}
            factors[side] = {c: f * step.get(c, 1.0) ** RELAX for c, f in factors[side].items()}
            cells = [n * step.get(pair[side], 1.0) for pair, n in zip(pairs, cells, strict=True)]


def _by_class(value: Column, factors: dict[str, float]) -> Column:
    chosen = F.lit(factors[OTHER])
    for name, factor in factors.items():
        chosen = F.when(value == name, F.lit(factor)).otherwise(chosen)
    return chosen


def with_probability(rows: DataFrame, mix: Mix, key: str, seed: int) -> DataFrame:
    """Add ``probability`` and ``sampled`` to rows with source, language and topic; keyed by the column ``key``."""
    factor = mix.sources.withColumnRenamed("source", "_source")
    joined = rows.join(factor, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    x = _by_class(F.col("language"), mix.languages) * _by_class(F.col("topic"), mix.topics)
    probability = F.least(F.lit(1.0), F.coalesce("factor", F.lit(0.0)) * x)
    drawn = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(STEPS)) / F.lit(float(STEPS))
    return (
        joined.withColumn("probability", probability)
        .drop("factor")
        .withColumn("sampled", drawn < F.col("probability"))
    )


def mixed(
    docs: DataFrame,
    languages: dict[str, float],
    topics: dict[str, float],
    topic: Column,
    keep: float = 0.5,
    flatten: float = 0.7,
    seed: int = 1,
    carry: list[str] | None = None,
    text: str = "text",
) -> DataFrame:
    """Id, source, language and topic class, tokens, probability, sampled, and whether the shares came as near to their
    targets as asked; ``document`` with the columns to carry."""
    rows = docs.select(
        *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("document")] if carry else []),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        class_of(F.col("lang").cast("string"), languages).alias("language"),
        class_of(topic, topics).alias("topic"),
        word_count(F.col(text).cast("string")).alias("tokens"),
    )
    if not carry:
        rows = stage(rows, "weights")
    mix = rake(rows.drop("document"), languages, topics, keep, flatten)
    if not mix.converged:
        warnings.warn(f"shares are off their targets by up to {mix.deviation:.3%} after {mix.sweeps} sweeps", stacklevel=2)
    return with_probability(rows, mix, "doc_id", seed).withColumn("converged", F.lit(mix.converged))


def sample(docs: DataFrame, *args, **options) -> DataFrame:
    """The sampled documents with all their columns; arguments as for ``mixed``."""
    chosen = mixed(docs, *args, carry=docs.columns, **options).filter("sampled")
    return chosen.select(*[F.col("document")[c].alias(c) for c in docs.columns])
