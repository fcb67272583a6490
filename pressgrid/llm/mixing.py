"""Mixing sources to target weights by iterative proportional fitting, in Spark functions alone."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressgrid.sources.staging import stage

#: Rounds of raking, each over all margins, between two looks at what is left.
ROUNDS = 4
#: Largest distance of a share from its target at which raking ends.
TOLERANCE = 1e-12
#: Share of all tokens that a sample is to hold.
BUDGET = 0.8
#: Power of a margin's own share that the default target is proportional to: below 1 lifts small groups.
TEMPER = 0.5
WORD = r"[^\x20\x09-\x0D]+"


def token_count(text: Column) -> Column:
    """Words of a text, and 1 for a text without any."""
    return F.greatest(F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)), F.lit(1)).cast("long")


def text_form(text: Column, tokens: Column) -> Column:
    """A topic for documents without one, from what their text looks like."""
    return (
        F.when(F.contains(text, F.lit(" | ")), "table").when(F.contains(F.lower(text), F.lit("license")), "legal")
        .when(F.contains(text, F.lit("@")), "contact").when(tokens < 100, "note").when(tokens < 400, "article")
        .otherwise("long")
    )


def tempered(cells: DataFrame, margin: str, power: float = TEMPER) -> DataFrame:
    """Target shares of a margin in proportion to a power of its tokens: ``margin``, ``share``."""
    sums = cells.groupBy(margin).agg(F.pow(F.sum("tokens"), F.lit(power)).alias("part"))
    whole = sums.agg(F.sum("part")).first()[0] or 1.0
    return sums.select(margin, (F.col("part") / whole).alias("share"))


def _over(margin: str) -> Column:
    return F.sum("weight").over(Window.partitionBy(margin))


def rake(cells: DataFrame, targets: Mapping[str, DataFrame], tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` with ``weight``: token mass scaled so that each margin has its target shares, and ``residual``.

    ``targets`` gives ``share`` for the values of a margin; they are scaled to sum to one over the values that occur, and
    values without a target get none of the mass. A margin is scaled by a sum over its cells, so nothing is joined;
    every few rounds the cells are written to the shared folder. Raking goes on until no share is further from its target
    than ``tolerance``, or, for targets that exclude each other, until the distance no longer shrinks; ``residual`` is the
    largest distance that is left, the same for all cells.
    """
    now = cells.withColumn("weight", F.col("tokens").cast("double"))
    shares = {margin: f"_share_{margin}" for margin in targets}
    for margin, target in targets.items():
        asked = target.select(margin, F.col("share").cast("double").alias(shares[margin]))
        now = now.join(asked, margin, "left").na.fill(0.0, [shares[margin]])
    now = stage(now, "cells")
    alone = {share: F.col(share) / F.count("*").over(Window.partitionBy(margin)) for margin, share in shares.items()}
    mass, *wholes = now.select("weight", *(part.alias(share) for share, part in alone.items())).agg(
        F.sum("weight"), *map(F.sum, alone)
    ).first()
    mass = mass or 0.0
    wanted = {m: F.col(share) / (whole or 1.0) for (m, share), whole in zip(shares.items(), wholes, strict=True)}
    far = [F.abs(_over(m) / (mass or 1.0) - share) for m, share in wanted.items()]
    left = float("inf")
    while True:
        for _ in range(ROUNDS):
            for margin, share in wanted.items():
                held = _over(margin)
                now = now.withColumn("weight", F.when(held > 0, F.col("weight") * (share * mass / held)).otherwise(0.0))
        now = stage(now, "raked")
        before, left = left, now.select(F.greatest(F.lit(0.0), *far).alias("far")).agg(F.max("far")).first()[0] or 0.0
        if left <= tolerance or left > 0.99 * before:
            return now.drop(*shares.values()).withColumn("residual", F.lit(left))


def calibrate(raked: DataFrame, budget: float = BUDGET) -> DataFrame:
    """``raked`` with ``probability`` = min(1, scale * weight / tokens), so that the expected tokens are the budget.

    The scale is exact: cells that reach 1 are set aside and the rest is scaled anew until no more do.
    """
    ratio = F.col("weight") / F.col("tokens")
    total, mass = raked.agg(F.sum("tokens"), F.sum("weight")).first()
    if not mass:
        return raked.withColumn("probability", F.lit(0.0))
    wanted, scale = budget * total, 0.0
    while True:
        full = ratio * scale >= 1
        sure, rest = raked.agg(F.sum(F.when(full, F.col("tokens"))), F.sum(F.when(~full, F.col("weight")))).first()
        if not rest or (now := (wanted - (sure or 0)) / rest) <= scale:
            break
        scale = now
    chance = F.when(full, 1.0).otherwise(F.least(F.lit(1.0), ratio * scale))
    return raked.withColumn("probability", F.when(F.col("weight") > 0, chance).otherwise(0.0))


def even(doc_id: Column, seed: int) -> Column:
    """A number from 0 to 1 that depends on id and seed alone; null ids have 1."""
    digits = F.substring(F.md5(F.concat(doc_id.cast("string"), F.lit(f":{seed}"))), 1, 13)
    return F.coalesce(F.conv(digits, 16, 10).cast("double") / float(1 << 52), F.lit(1.0))


def mix(
    docs: DataFrame, targets: Mapping[str, DataFrame] | None = None, margins: Sequence[str] = ("source", "lang", "topic"),
    budget: float = BUDGET, tolerance: float = TOLERANCE, seed: int = 17, id_column: str = "doc_id", text_column: str = "text",
    topic: Column | None = None,
) -> DataFrame:
    """``docs`` with ``topic``, ``tokens``, ``weight`` (of one token), ``probability`` and ``sampled``.

    Documents are summed to cells of source, language and topic; the cells' token mass is raked to the target shares of
    each margin (by default tempered shares of the table's own), and each document is sampled with its cell's calibrated
    probability, by a hash of its id. Only sums over cells are shuffled; texts stay where they are read, and a source
    that holds most rows is summed within each task first. ``topic`` may be given as a column; without one, and without a
    column of that name, it is what the text looks like. A null margin value counts as ''. Null
    and empty texts count one token. Repeated rows share their fate; rows without an id are sampled at probability 1 only. Columns of
    ``docs`` with the names of results are replaced. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    base = docs.drop("tokens", "weight", "probability", "sampled").withColumn("tokens", token_count(text))
    if topic is not None or "topic" not in docs.columns:
        base = base.withColumn("topic", topic if topic is not None else text_form(text, F.col("tokens")))
    base = base.withColumns({m: F.coalesce(F.col(m).cast("string"), F.lit("")) for m in margins})
    cells = stage(base.groupBy(*margins).agg(F.sum("tokens").alias("tokens")), "cells")
    wanted = targets or {m: tempered(cells, m) for m in margins}
    found = stage(calibrate(rake(cells, wanted, tolerance), budget), "calibrated").select(
        *margins, (F.col("weight") / F.col("tokens")).alias("weight"), "probability"
    )
    chance = F.col("probability")
    return base.join(found, list(margins)).withColumn(
        "sampled", (even(F.col(id_column), seed) < chance) | (chance >= 1)
    )
