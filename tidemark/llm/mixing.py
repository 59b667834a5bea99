"""Mixing sources to target weights by temperature.

Token shares of the sources are raised to an exponent and normalised. The exponent is
bisected, to the largest that meets a target entropy or a repetition limit. Each source's
weighted budget is then realised as whole passes over the source and a part of one, in
blocks of a permutation that differs by pass.

Sources stay a table: the search sums over all sources in Spark, and the driver sees the sums.
A source is cut into blocks by hash, as many as it has rows for, so a source that holds a
third of all rows is many blocks. Prefix sums run over blocks; only the block in which a
budget ends is ordered row by row.
"""

from collections.abc import Callable
from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACES, stored

BLOCK_ROWS = 2048
BISECTIONS = 24
# Exponents tried per pass over the sources: a bisection of several levels at once.
LEVELS = 4
SEED = 17


@dataclass(frozen=True)
class Target:
    """`entropy`: of the weights, as a share of the largest possible. `repeats`: most passes over a source.

    With both, both hold. `budget`: tokens of the mixture; all tokens of the sources if None.
    """

    entropy: float | None = 0.95
    repeats: float | None = 4.0
    budget: int | None = None


def tokens_of(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"[^{SPACES}]+")).cast("long")


def _sums(sources: DataFrame, exponents: list[float]) -> list[tuple[float, float, float]]:
    """For each exponent, sums over sources of s^x and s^x ln s^x, and the largest s^x / tokens."""
    share = F.col("tokens") / F.col("total")
    columns = []
    for k, x in enumerate(exponents):
        power = F.pow(share, F.lit(x))
        columns += [
            F.sum(power).alias(f"z{k}"), F.sum(power * F.log(power)).alias(f"e{k}"), F.max(power / F.col("tokens")).alias(f"m{k}"),
        ]
    row = sources.agg(*columns).first()
    return [(row[f"z{k}"], row[f"e{k}"], row[f"m{k}"]) for k in range(len(exponents))]


def exponent(sources: DataFrame, target: Target) -> float:
    """The largest exponent in [0, 1] that meets the target; the nearest to it if none does.

    Entropy falls with the exponent and repeats of small sources fall as it grows, so the
    entropy bounds it from above and the repetition limit from below. The limit on repeats
    goes first: it cannot be made up for by more of the same text.
    """
    size = sources.agg(F.count("*").alias("n"), F.max("total").alias("total")).first()
    if size["n"] < 2:
        return 1.0
    budget = target.budget if target.budget is not None else size["total"]

    def flat(sums: tuple) -> bool:
        z, e, _ = sums
        return target.entropy is None or log(z) - e / z >= target.entropy * log(size["n"]) - 1e-12

    def rare(sums: tuple) -> bool:
        z, _, most = sums
        return target.repeats is None or budget * most / z <= target.repeats * (1 + 1e-9)

    def bisect(low: float, high: float, holds: Callable[[tuple], bool]) -> tuple[float, float]:
        """Closes in on the border between exponents for which `holds` is true, below, and the others."""
        for _ in range(0, BISECTIONS, LEVELS):
            parts = 1 << LEVELS
            tried = [low + (high - low) * k / parts for k in range(1, parts)]
            passed = [holds(sums) for sums in _sums(sources, tried)]
            first = passed.index(False) if False in passed else len(passed)
            low, high = ([low, *tried])[first], ([*tried, high])[first]
        return low, high

    at_one = _sums(sources, [1.0])[0]
    top = 1.0 if flat(at_one) else bisect(0.0, 1.0, flat)[0]
    if rare(_sums(sources, [top])[0]):
        return top
    # Flatter weights repeat small sources too often: back up to where they do not.
    return bisect(top, 1.0, lambda sums: not rare(sums))[1] if rare(at_one) else 1.0


def weights(docs: DataFrame, target: Target) -> DataFrame:
    """`source, tokens, rows, weight, budget`: a stored row per source with tokens."""
    counted = docs.select("source", tokens_of(F.col("text")).alias("tokens")).groupBy("source")
    sources = counted.agg(F.sum("tokens").alias("tokens"), F.count("*").alias("rows")).filter("tokens > 0")
    total = sources.agg(F.sum("tokens").alias("total")).first()["total"] or 0
    sources = stored(sources.withColumn("total", F.lit(total).cast("double")), "mix-sources")
    if total == 0:
        return sources.select("source", "tokens", "rows", F.lit(0.0).alias("weight"), F.lit(0).cast("long").alias("budget"))
    power = exponent(sources, target)
    z = _sums(sources, [power])[0][0]
    weight = F.pow(F.col("tokens") / F.col("total"), F.lit(power)) / F.lit(z)
    budget = F.lit(target.budget if target.budget is not None else total)
    return stored(
        sources.select("source", "tokens", "rows", weight.alias("weight"), F.round(weight * budget).cast("long").alias("budget")),
        "mix-weights",
    )


def mix(docs: DataFrame, target: Target = Target(), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """A row per use of a document: `doc_id, source, n_tokens, epoch, block, place`.

    `epoch` counts passes over a source from 0. A source's budget is filled in the order of
    its permutation up to the document that reaches it. `place` in [0, 1) orders the mixture:
    how far into its source's share a document comes, so that any stretch holds the sources
    in their weights. Documents without words are not used. A null source is a source;
    repeated rows are used as often as they stand there.
    """
    plan = weights(docs, target)
    sized = docs.select(
        "doc_id",
        "source",
        tokens_of(F.col("text")).alias("n_tokens"),
        F.xxhash64("doc_id", F.xxhash64("text"), F.lit(SEED)).alias("key"),
    )
    rows = stored(sized.filter("n_tokens > 0").withColumn("row", F.monotonically_increasing_id()), "mix-rows")
    passes = plan.select(
        F.col("source").alias("s"),
        F.col("tokens").alias("source_tokens"),
        F.col("budget"),
        F.greatest(F.lit(1), F.ceil(F.col("rows") / block_rows)).alias("blocks"),
        F.floor(F.col("budget") / F.col("tokens")).alias("whole"),
    )
    # Whole passes need no order between rows; a pass that is cut short does.
    epochs = passes.withColumn(
        "epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("budget") / F.col("source_tokens")).cast("long") - 1))
    ).filter("epoch >= 0 and budget > 0")
    used = rows.join(epochs, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    permuted = used.withColumn("order", F.xxhash64("key", "row", "epoch")).withColumn(
        "block", F.pmod(F.shiftrightunsigned("order", 1), F.col("blocks"))
    )
    sums = permuted.groupBy("source", "epoch", "block").agg(F.sum("n_tokens").alias("block_tokens"))
    # One row per block: two thousand documents or so each.
    before_block = F.sum("block_tokens").over(
        Window.partitionBy("source", "epoch").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    blocks = sums.select(
        F.col("source").alias("s"), F.col("epoch").alias("e"), F.col("block").alias("b"),
        F.coalesce(before_block, F.lit(0)).alias("before"),
    )
    placed = permuted.join(
        blocks,
        F.col("source").eqNullSafe(F.col("s")) & (F.col("epoch") == F.col("e")) & (F.col("block") == F.col("b")),
    )
    inside = F.sum("n_tokens").over(
        Window.partitionBy("source", "epoch", "block").orderBy("order", "row").rowsBetween(Window.unboundedPreceding, -1)
    )
    reached = F.col("epoch") * F.col("source_tokens") + F.col("before") + F.coalesce(inside, F.lit(0))
    return (
        placed.withColumn("reached", reached)
        .filter(F.col("reached") < F.col("budget"))
        .select("doc_id", "source", "n_tokens", "epoch", "block", (F.col("reached") / F.col("budget")).alias("place"))
    )
