"""Mutual information of numbers with a class, from the distances to nearest neighbours.

For a row, the ball around its value ends at the k-th nearest other row of its own
class; the more rows of any class lie inside, the less the number tells about the
class. With psi the digamma function, N rows, N_c rows of the row's class and m rows
inside the ball, the estimate is psi(N) + mean(psi(k) - psi(N_c) - psi(m)).

Numbers with few values (counters) have balls without a radius, which the estimate is
not made for: it comes out far below 0. With ``keys`` every number is moved by up to
1e-10 of the feature's mean size, by a digest of the row's keys and not by chance, so
that equal numbers lie side by side and the same rows always give the same estimate.

Rows are added up per feature, class and value first, so a value with most rows is
one cell. Cells are numbered in the order of their values by running totals over
slices and dealt out in blocks of equal size; a block also gets the ``neighbours``
cells beyond its two borders, so every ball is found inside one block, and no task
holds a whole class. Rows inside the balls come from running totals over all values
and ball ends, by equijoins. Nothing is gathered on the driver or broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom.functions import columns as X
from clickloom.functions.curves import ONE_TASK_SCORES, running_totals
from clickloom.session import stage

#: cells of one class and feature that one task looks through
BLOCK_CELLS = 50_000
#: of the mean size of a feature's numbers, and of 1 at least
SPREAD = 1e-10
_SHIFT = 10


def digamma(n: Column) -> Column:
    """The digamma function of a number of 1 or more: asymptotic series at ``n + 10``, brought back by recurrence."""
    high = n.cast("double") + _SHIFT
    square = 1 / (high * high)
    series = F.log(high) - 0.5 / high - square * (1 / 12 - square * (1 / 120 - square * (1 / 252 - square / 240)))
    for step in range(_SHIFT):
        series = series - 1 / (n + step)
    return series


def _spread(df: DataFrame, features: Sequence[str], keys: Sequence[str], seed: int) -> list[Column]:
    """The numbers, moved a little by a digest of the keys if there are any."""
    numbers = [F.col(f"`{c}`").cast("double") for c in features]
    if not keys:
        return numbers
    sizes = df.agg(*[F.avg(F.when(F.abs(x) < float("inf"), F.abs(x))).alias(f"s{k}") for k, x in enumerate(numbers)]).first()
    columns = [F.col(f"`{k}`") for k in keys]
    moved = []
    for name, x, size in zip(features, numbers, sizes):
        share = X.hash_share(*columns, F.lit(name), seed=seed)
        moved.append(x + (2 * share - 1) * F.lit(SPREAD * max(1.0, size or 0.0)))
    return moved


def _cells(df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str], seed: int) -> DataFrame:
    """``feature, y, x, n`` with the rows of the class and of the feature, without classes of one row."""
    numbers = _spread(df, features, keys, seed)
    lines = F.array(*[F.struct(F.lit(c).alias("feature"), x.alias("x")) for c, x in zip(features, numbers)])
    rows = df.select(F.col(f"`{target}`").cast("string").alias("y"), F.inline(lines))
    known = F.col("y").isNotNull() & (F.abs("x") < float("inf"))  # leaves out null and NaN too
    cells = stage(rows.where(known).groupBy("feature", "y", "x").agg(F.sum(F.lit(1)).alias("n")), "cells")
    classes = cells.groupBy("feature", "y").agg(F.sum("n").alias("class_rows")).where("class_rows > 1")
    whole = classes.groupBy("feature").agg(F.sum("class_rows").alias("rows"))
    return cells.join(classes.join(whole, "feature"), ["feature", "y"]).withColumn("cell", F.lit(1))


def balls(cells: DataFrame, neighbours: int, block_cells: int = BLOCK_CELLS, one_task_scores: int = ONE_TASK_SCORES) -> DataFrame:
    """Adds ``k``, ``radius`` and the ends ``low`` and ``high`` of the open ball around each cell's value."""
    block_cells = max(block_cells, neighbours)
    keys = ["feature", "y"]
    placed = running_totals(cells, "x", ["cell"], keys, one_task_scores)
    placed = placed.withColumn("home", F.expr(f"cell_below div {block_cells}")).withColumn("spot", F.expr(f"cell_below % {block_cells}"))
    lent = F.expr(
        f"array_compact(array(home, IF(spot < {neighbours}, home - 1, NULL), IF(spot >= {block_cells - neighbours}, home + 1, NULL)))"
    )
    order = W.partitionBy(*keys, "block").orderBy("x")
    steps = range(1, neighbours + 1)
    near = {f"{c}_{side}{s}": shift(c, s).over(order) for side, shift in (("b", F.lag), ("a", F.lead)) for s in steps for c in ("x", "n")}
    seen = placed.withColumn("block", F.explode(lent)).withColumns(near)
    own = seen.where("block = home").withColumn("k", F.expr(f"least(class_rows - 1, {neighbours})"))
    x, lines = F.col("x"), []
    for s in steps:
        lines.append(F.when(F.col(f"x_b{s}").isNotNull(), F.struct((x - F.col(f"x_b{s}")).alias("d"), F.col(f"n_b{s}").alias("n"))))
        lines.append(F.when(F.col(f"x_a{s}").isNotNull(), F.struct((F.col(f"x_a{s}") - x).alias("d"), F.col(f"n_a{s}").alias("n"))))
    # other rows at the same value come first, then cell by cell until k rows are met; the sort puts absent neighbours last
    radius = """aggregate(distances, struct(k - n + 1 AS wanted, double(0) AS d),
                   (s, c) -> IF(s.wanted > 0 AND c IS NOT NULL, struct(s.wanted - c.n AS wanted, c.d AS d), s)).d"""
    ball = own.withColumn("distances", F.array_sort(F.array(*lines))).withColumn("radius", F.expr(radius))
    # the ball ends at the neighbour's own value where that is nearer than what adding the rounded distance gives
    r = F.col("radius")
    above = [F.when(F.col(f"x_a{s}") - x >= r, F.col(f"x_a{s}")) for s in steps]
    below = [F.when(x - F.col(f"x_b{s}") >= r, F.col(f"x_b{s}")) for s in steps]
    ball = ball.withColumns({"high": F.least(x + r, *above), "low": F.greatest(x - r, *below)})
    return ball.select(*cells.columns, "k", "radius", "low", "high")


def neighbour_information(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    neighbours: int = 3,
    keys: Sequence[str] = (),
    seed: int = C.SEED,
    block_cells: int = BLOCK_CELLS,
    one_task_scores: int = ONE_TASK_SCORES,
) -> DataFrame:
    """``feature, rows, estimate, mutual_info`` in nats of numbers with a class of any number of values.

    The estimate can fall below 0 where the number tells nothing; ``mutual_info`` does not.
    Rows with an unknown number or class are left out, feature by feature, and so are
    classes of one row, which have no neighbour. ``keys`` tell rows apart and spread equal
    numbers; without them numbers are taken as they are. A feature without rows has no line.
    Ball ends are sums in doubles.
    """
    found = stage(balls(_cells(df, features, target, keys, seed), neighbours, block_cells, one_task_scores), "balls")
    ends = found.select("feature", F.explode(F.array("low", "high")).alias("v"), F.lit(0).cast("long").alias("n"))
    values = found.select("feature", F.col("x").alias("v"), "n").unionByName(ends)
    values = stage(values.groupBy("feature", "v").agg(F.sum("n").alias("n")), "values")
    below = running_totals(values, "v", ["n"], ["feature"], one_task_scores)
    low = below.select("feature", F.col("v").alias("low"), (F.col("n_below") + F.col("n")).alias("upto_low"))
    high = below.select("feature", F.col("v").alias("high"), F.col("n_below").alias("below_high"), F.col("n").alias("at_high"))
    both = found.withColumns(
        # a ball without a radius holds the rows at its value
        {"low": F.when(F.col("radius") > 0, F.col("low")).otherwise(F.col("x")), "high": F.when(F.col("radius") > 0, F.col("high")).otherwise(F.col("x"))}
    ).join(low, ["feature", "low"]).join(high, ["feature", "high"])
    inside = F.when(F.col("radius") > 0, F.col("below_high") - F.col("upto_low")).otherwise(F.col("at_high"))
    terms = F.col("n") * (digamma(F.col("k")) - digamma(F.col("class_rows")) - digamma(inside))
    sums = both.groupBy("feature").agg(F.max("rows").alias("rows"), F.sum(terms).alias("terms"))
    estimate = digamma(F.col("rows")) + F.col("terms") / F.col("rows")
    return sums.select("feature", "rows", estimate.alias("estimate"), F.greatest(estimate, F.lit(0.0)).alias("mutual_info"))
