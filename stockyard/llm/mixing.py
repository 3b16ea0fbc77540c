"""Mixing sources to target weights by temperature.

A source's weight is its share of the tokens to the power of an exponent between 0 (all alike) and 1
(as they are), normalised. The exponent is narrowed down until the weights meet a target entropy or a
limit on repetition. Each source then has a budget of tokens, which passes over a fixed permutation of
its documents use up; the places of the passes in the stream part it into blocks of about equal
length, each of which holds all sources in their weights.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockyard.llm.common import bits_for, stored, with_running_total

# Exponents tried in each of the passes over the table of sources that narrow the exponent down.
GRID, PASSES = 32, 4
EXACT = "decimal(38,18)"


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def _narrowed(shares: DataFrame, enough) -> float:
    """The largest exponent for which `enough(exponent, sum of powers, entropy)` holds, or 0.

    The sums are taken in decimals, so they do not depend on the order of the rows.
    """
    low, high = 0.0, 1.0
    for turn in range(PASSES):
        tries = [low + (high - low) * i / GRID for i in range(GRID + 1)]
        p = F.col("share")
        sums = []
        for i, a in enumerate(tries):
            sums.append(F.sum(F.pow(p, F.lit(a)).cast(EXACT)).cast("double").alias(f"z{i}"))
            sums.append(F.sum((F.pow(p, F.lit(a)) * F.ln(p)).cast(EXACT)).cast("double").alias(f"l{i}"))
        row = shares.agg(*sums).first()
        good = [enough(a, row[f"z{i}"], math.log(row[f"z{i}"]) - a * row[f"l{i}"] / row[f"z{i}"]) for i, a in enumerate(tries)]
        if good[-1] and turn == 0:
            return 1.0
        last = max((i for i in range(GRID + 1) if good[i]), default=0)
        low, high = tries[last], tries[min(last + 1, GRID)]
    return low


def budgets(
    totals: DataFrame,
    most_epochs: float | None = None,
    entropy: float | None = None,
    budget: int | None = None,
) -> DataFrame:
    """`totals` (source, total) with `weight` and `budget`, in tokens.

    Without `budget` it is the smallest with which every source is used whole at least once.
    `entropy` is the least entropy of the weights, as a part of the highest one that is possible; among
    the exponents that reach it the largest is taken. `most_epochs` limits how often any source is
    repeated: the exponent is raised as far as that needs, and no further than to 1.
    """
    counted = totals.agg(
        F.sum("total").alias("all"),
        F.count_if(F.col("total") > 0).alias("n"),
        F.min(F.when(F.col("total") > 0, F.col("total"))).alias("least"),
        F.max("total").alias("most"),
    ).first()
    if not counted["all"]:
        return totals.withColumn("weight", F.lit(0.0)).withColumn("budget", F.lit(0).cast("long"))
    everything, least, most = counted["all"], counted["least"] / counted["all"], counted["most"] / counted["all"]
    shares = totals.filter("total > 0").select((F.col("total") / F.lit(everything)).alias("share"))
    exponent = 1.0
    if entropy is not None:
        exponent = _narrowed(shares, lambda a, z, h: h >= entropy * math.log(counted["n"]) - 1e-9)
    elif most_epochs is not None:
        exponent = 0.0

    def epochs(a: float, z: float) -> float:
        """How often the smallest source is repeated."""
        return (least / most) ** (a - 1) if budget is None else least ** (a - 1) / z * budget / everything

    if most_epochs is not None:
        # 1 - exponent grows as long as the limit holds.
        p, low, high = F.col("share"), exponent, 1.0
        for _ in range(PASSES):
            tries = [low + (high - low) * i / GRID for i in range(GRID + 1)]
            row = shares.agg(
                *[F.sum(F.pow(p, F.lit(a)).cast(EXACT)).cast("double").alias(f"z{i}") for i, a in enumerate(tries)]
            ).first()
            fits = [i for i, a in enumerate(tries) if epochs(a, row[f"z{i}"]) <= most_epochs]
            first = min(fits, default=GRID)
            low, high = tries[max(0, first - 1)], tries[first]
            if first == 0:
                break
        exponent = high
    z = shares.agg(F.sum(F.pow(F.col("share"), F.lit(exponent)).cast(EXACT)).cast("double").alias("z")).first()["z"]
    share = F.col("total") / F.lit(everything)
    scale = most ** (exponent - 1) if budget is None else z * everything / budget
    weight = F.when(F.col("total") > 0, F.pow(share, F.lit(exponent)) / F.lit(z)).otherwise(0.0)
    repeated = F.when(F.col("total") == F.lit(counted["most"]), F.lit(1.0)) if budget is None else F.when(F.lit(False), 1.0)
    repeated = repeated.otherwise(F.pow(share, F.lit(exponent - 1)) / F.lit(scale))
    spent = F.when(F.col("total") > 0, F.floor(F.col("total") * repeated + F.lit(0.5))).otherwise(0).cast("long")
    return totals.withColumn("weight", weight).withColumn("budget", spent)


def mixed(
    df: DataFrame,
    most_epochs: float | None = None,
    entropy: float | None = None,
    budget: int | None = None,
    block_tokens: int = 1 << 18,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per occurrence of a document in the mixture, with its place (`block`, `slot`).

    `copy` counts a document's occurrences from 0. A source's occurrences never exceed its budget, and
    fall short of it by less than one document. Rows with the same identifier and source are one
    document, their words added up. A null source is a source of its own; a null or empty text has no
    words, and such a document occurs once if its source is used whole. Other columns are ignored; an
    empty table gives an empty result.
    """
    rows = df.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words_of(F.col(text_col)).alias("n")
    )
    units = stored(rows.groupBy("doc_id", "source").agg(F.sum("n").alias("n_tokens")), "mixture")
    totals = stored(units.groupBy("source").agg(F.sum("n_tokens").alias("total"), F.count("*").alias("docs")), "sources")
    plan = budgets(totals, most_epochs, entropy, budget)
    size = plan.agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("docs"), F.coalesce(F.sum("budget"), F.lit(0)).alias("b")).first()
    blocks = max(1, int(size["b"]) // block_tokens)
    placed = with_running_total(units, ["source"], ["doc_id"], F.col("n_tokens"), bits_for(size["docs"]), "before")
    plan = plan.withColumnRenamed("source", "of_source")
    joined = placed.join(plan, F.col("source").eqNullSafe(F.col("of_source")))
    end = F.col("before") + F.col("n_tokens")
    passes = F.when(F.col("total") > 0, F.floor(F.col("budget") / F.col("total"))).otherwise(0).cast("int")
    each = joined.withColumn("copy", F.explode(F.sequence(F.lit(0), passes)))
    fits = (F.col("copy") * F.col("total") + end <= F.col("budget")) & ((F.col("n_tokens") > 0) | (F.col("copy") == 0))
    along = (F.col("copy") * F.col("total") + F.col("before")) / F.greatest(F.col("budget"), F.lit(1))
    block = F.least(F.floor(along * blocks), F.lit(blocks - 1)).cast("long")
    drawn = each.filter(fits).withColumn("block", block)
    order = Window.partitionBy("block").orderBy(F.xxhash64("doc_id", "source", "copy"), "doc_id", "source", "copy")
    return drawn.select(
        "doc_id", "source", "copy", "n_tokens", "weight", "block", (F.row_number().over(order) - 1).cast("long").alias("slot")
    )


def mixture(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", **how) -> DataFrame:
    """The rows of `df` as often as they occur in the mixture, with all their columns."""
    drawn = mixed(df, id_col=id_col, source_col=source_col, **how)
    places = drawn.select(F.col("doc_id").alias("drawn_id"), F.col("source").alias("drawn_source"))
    rows = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("row"))
    same = F.col(f"row.{id_col}").eqNullSafe(F.col("drawn_id")) & F.col(f"row.{source_col}").eqNullSafe(F.col("drawn_source"))
    return rows.join(places, same).select("row.*")
