"""Quantiles and rounding."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from trolley.sources.storage import discard, settled

# A sketch tells ranks to one part in so many; what it brackets is settled exactly.
ACCURACY = 20_000
# So many different values are put in order by one task.
SETTLED_VALUES = 1_000_000


def exact_quantiles(df: DataFrame, column: str, shares: dict[str, float]) -> DataFrame:
    """One row with, per name in ``shares``, the smallest value that covers the share.

    Nulls and NaN are ignored; an empty column gives null. Infinite values count
    like others. See :func:`exact_quantiles_of`.
    """
    kind = dict(df.dtypes)[column]
    found = exact_quantiles_of(df, {name: (column, share) for name, share in shares.items()})
    return df.sparkSession.createDataFrame(
        [tuple(found[n] for n in shares)], ", ".join(f"`{n}` {kind}" for n in shares)
    )


def exact_quantiles_of(df: DataFrame, wanted: dict[str, tuple[str, float]]) -> dict:
    """Per name, the smallest value of a column that covers a share of its values; null for an empty column.

    ``wanted`` maps names to (column, share); the columns are of one type. One aggregation counts the values and
    sketches their ranks; it yields two values of the column between which the
    answer lies. A second one counts the values below the first exactly, and
    each different value between the two, of which there are few; from these the
    answer is read. Where more than ``SETTLED_VALUES`` different values are left,
    they are sketched in turn. ``df`` is read twice: store it first if it is costly.
    """
    open_ranges = {name: (column, float(share), None, None, None) for name, (column, share) in wanted.items()}
    return _settle(df, open_ranges, 2.0 / ACCURACY)


def _known(df: DataFrame, column: str) -> Column:
    """The values of a column that count, else null."""
    at = F.col(f"`{column}`")
    return F.when(~F.isnan(at), at) if dict(df.dtypes)[column] in ("double", "float") else at


def _settle(df: DataFrame, wanted: dict, margin: float) -> dict:
    """``wanted``: name to (column, share, low, high, rank).

    Of a range that is open still, the ends are given, and the exact rank of the
    answer among the values in it.
    """
    names = list(wanted)
    values = {n: _known(df, wanted[n][0]) for n in names}
    for n, (_, _, low, high, _) in wanted.items():
        if low is not None:
            values[n] = F.when(values[n].between(F.lit(low), F.lit(high)), values[n])
    counts = df.agg(
        *[F.count(values[n]).alias(f"n{i}") for i, n in enumerate(names)],
        *[F.min(values[n]).alias(f"low{i}") for i, n in enumerate(names)],
        *[F.max(values[n]).alias(f"high{i}") for i, n in enumerate(names)],
        *[
            F.percentile_approx(values[n], _around(wanted[n][1], margin), ACCURACY).alias(f"steps{i}")
            for i, n in enumerate(names)
        ],
    ).first()
    found, ranges, targets = {}, {}, {}
    for i, n in enumerate(names):
        _, share, _, _, rank = wanted[n]
        total = counts[f"n{i}"]
        if not total:
            found[n] = None
            continue
        target = max(1, math.ceil(share * total)) if rank is None else rank
        steps = counts[f"steps{i}"]
        low, high = _wider(steps[0], steps[-1])
        ranges[n], targets[n] = (max(low, counts[f"low{i}"]), min(high, counts[f"high{i}"])), target
    if not ranges:
        return found
    none = {n: F.lit(None).cast(dict(df.dtypes)[wanted[n][0]]) for n in ranges}
    inside = [
        F.when(values[n] < F.lit(low), F.struct(F.lit(n).alias("name"), none[n].alias("value"))).when(
            values[n] <= F.lit(high), F.struct(F.lit(n).alias("name"), values[n].alias("value"))
        )
        for n, (low, high) in ranges.items()
    ]
    table = settled(
        df.select(F.explode(F.array_compact(F.array(*inside))).alias("at")).groupBy("at").agg(F.count(F.lit(1)).alias("n")),
        "quantile-values",
    ).select("at.name", "at.value", "n")
    sizes = {r["name"]: r for r in table.groupBy("name").agg(
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("inside"),
        F.count("value").alias("values"),
    ).collect()}
    again, wider = {}, {}
    for n in ranges:
        below, held, several = (sizes[n][c] if n in sizes else 0 for c in ("below", "inside", "values"))
        if not below < targets[n] <= below + held:
            wider[n] = wanted[n]  # the sketch was off by more than it promises
        elif several > SETTLED_VALUES:
            rank = targets[n] - below
            again[n] = (wanted[n][0], (rank - 0.5) / held, *ranges[n], rank)
        else:
            earlier = W.orderBy("value").rowsBetween(W.unboundedPreceding, 0)
            reached = table.filter((F.col("name") == n) & F.col("value").isNotNull()).withColumn("_to", F.sum("n").over(earlier))
            found[n] = reached.filter(F.col("_to") >= targets[n] - below).agg(F.min("value")).first()[0]
    discard(table)
    if wider:
        if margin >= 1:
            raise ValueError(f"no quantile found for {sorted(wider)}")
        found |= _settle(df, wider, min(1.0, 16 * margin))
    if again:
        stuck = [n for n in again if again[n][2:4] == wanted[n][2:4]]
        if stuck:
            raise ValueError(f"the range of {stuck} does not shrink")
        found |= _settle(df, again, margin)
    return found


def _around(share: float, margin: float) -> list[float]:
    return [max(0.0, share - margin), min(1.0, share + margin)]


def _wider(low, high):
    """Ends that hold the true ones although the sketch has rounded whole numbers to doubles."""
    if isinstance(low, float):
        return low, high
    if isinstance(low, int):
        return low - (abs(low) >> 50) - 1, high + (abs(high) >> 50) + 1
    return low - abs(low) / (1 << 50), high + abs(high) / (1 << 50)


def approx_quantiles(df: DataFrame, column: str, shares: dict[str, float], error: float = 0.01) -> DataFrame:
    """As :func:`exact_quantiles`, from one mergeable sketch with the given rank error."""
    accuracy = max(1, round(1 / error))
    return df.agg(*[F.percentile_approx(column, share, accuracy).alias(n) for n, share in shares.items()])


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double; null where the whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def rounded_ratio(part: Column, whole: Column, digits: int, scale: int = 1) -> Column:
    """``scale * part / whole`` rounded half up, from whole or decimal numbers only.

    Rounding a double ratio can go either way at a half; this cannot. Parts with
    up to six decimals count exactly; cast a double to a decimal first.
    """
    power = 10**digits
    exact = part.cast("decimal(28,6)") * F.lit(2 * scale * power * 10**6)
    doubled = F.round(exact, 0).cast("decimal(38,0)") + whole.cast("decimal(20,0)") * F.lit(10**6)
    halves = F.nullif(whole.cast("decimal(20,0)") * F.lit(2 * 10**6), F.lit(0).cast("decimal(20,0)"))
    return F.call_function("div", doubled, halves).cast("double") / F.lit(float(power))
