"""Analyses on rates of places by year: what is missing to a target, inequality, trend, kinds of places.

Each is one aggregate of the rates and expressions on its few rows. Rates have two decimals,
so hundredths are whole numbers and every sum is exact, whatever the order of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.numbers import finite
from terrace.functions.targets import yearly_columns

#: Decimal places that quotients of whole hundredths are kept to.
PLACES = 6
LADDER = "_ladder"


# --- The path to a target ---------------------------------------------------------------


def targets_long(wide: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """The yearly target columns as rows: the keys, ``target_year`` and ``target``."""
    by_year = yearly_columns(wide.columns, prefix)
    if not by_year:
        raise ValueError(f"no column named {prefix}<year>")
    pairs = F.array(*[
        F.struct(F.lit(y).alias("target_year"), finite(F.col(c)).alias("target")) for y, c in by_year.items()
    ])
    return wide.select(*keys, F.inline(pairs)).filter("target IS NOT NULL")


def path_to_target(
    rates: DataFrame,
    targets: DataFrame,
    keys: Sequence[str],
    value: str,
    year: str = "ano",
) -> DataFrame:
    """Each rate with the next later year whose target it does not meet, and the growth a year to it.

    Adds ``next_year``, ``next_target`` and ``growth_needed`` (points a year, two decimals, half
    up); they are null where all later targets are met, there are none, or there is no rate.
    The targets of a place are gathered once, one entry a year, so no rate is multiplied.
    """
    ladder = targets.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("target_year", "target"))).alias(LADDER))
    met = rates.join(ladder, list(keys), "left")
    ahead = F.filter(LADDER, lambda t: (t["target_year"] > F.col(year)) & (t["target"] > finite(F.col(value))))
    next_one = F.get(ahead, 0)
    with_next = met.withColumns(
        {"next_year": next_one["target_year"], "next_target": next_one["target"]}
    ).drop(LADDER)
    missing = F.rint((F.col("next_target") - F.col(value)) * 100).cast("bigint")
    years = F.col("next_year") - F.col(year)
    growth = F.call_function("div", missing * 2 + years, years * 2).cast("double") / 100
    return with_next.withColumn("growth_needed", growth)


# --- Inequality within and between ------------------------------------------------------


def _hundredths(value: str) -> Column:
    return F.rint(finite(F.col(value)) * 100).cast("bigint")


def moments(rates: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``n``, ``total`` and ``squares`` of a rate in hundredths: whole numbers that merge by sums."""
    x = _hundredths(value).cast("decimal(19,0)")
    return rates.filter(x.isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(x).alias("total"), F.sum(x * x).alias("squares")
    )


def inequality(
    rates: DataFrame, value: str, levels: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """The squared deviations of places from their mean, split by level of territory.

    ``levels`` go from the smallest to the largest group, each within the next. For each of
    ``keep`` there is a row with ``n``, ``squares_total`` and, for each level, its part: what
    lies within the smallest groups (``within_<level>``), between those of one next larger
    group (``between_<level>``), and between the largest. The parts are decimals of six places
    that add up to the total exactly: each is a difference of the same few quotients.
    """
    unit = F.lit(10**PLACES).cast("decimal(7,0)")

    def explained(m: DataFrame, keys: list[str]) -> DataFrame:
        """Sum of the squares of group totals by their sizes."""
        part = F.call_function("div", F.col("total") * F.col("total") * unit, F.col("n"))
        own = m.select(*keep, part.cast("decimal(38,0)").alias("part"))
        return own.groupBy(*keep).agg(F.sum("part").alias("explained")) if keep else own.agg(F.sum("part").alias("explained"))

    def regrouped(m: DataFrame, keys: list[str]) -> DataFrame:
        sums = [F.sum(c).alias(c) for c in ("n", "total", "squares")]
        return m.groupBy(*keys).agg(*sums) if keys else m.agg(*sums)

    own = moments(rates, [*keep, *levels], value)
    whole = regrouped(own, list(keep))
    result = whole.select(*keep, "n", (F.col("squares") * unit).alias("squares_up"), "total")
    names, m = [], own
    for i, level in enumerate(levels):
        if i:
            m = regrouped(m, [*keep, *levels[i:]])
        part = explained(m, list(keep)).withColumnRenamed("explained", f"_{level}")
        result = result.join(part, list(keep)) if keep else result.crossJoin(F.broadcast(part))
        names.append(f"_{level}")
    overall = F.call_function("div", F.col("total") * F.col("total") * unit, F.col("n")).cast("decimal(38,0)")
    steps = [F.col("squares_up"), *[F.col(c) for c in names], overall]
    labels = [f"within_{levels[0]}", *[f"between_{x}" for x in levels]]
    # Of hundredths squared, so ten thousand to a point squared.
    point = F.lit(Decimal(1).scaleb(-PLACES - 4))
    scaled = lambda c: c.cast("decimal(27,0)") * point  # noqa: E731  exact: 38 digits, ten of them decimals
    parts = [scaled(steps[i] - steps[i + 1]).alias(name) for i, name in enumerate(labels)]
    return result.select(*keep, "n", scaled(steps[0] - steps[-1]).alias("squares_total"), *parts)


# --- Trend and risk ---------------------------------------------------------------------


def trend(rates: DataFrame, keys: Sequence[str], value: str, year: str = "ano") -> DataFrame:
    """Least squares of the rate on the year in each group: ``n``, ``slope`` and ``intercept``.

    One aggregate makes the sums of the normal equations, from whole numbers, so they are exact
    and merge; the two equations are solved in an expression. A group of one year has neither.
    """
    x, y = F.col(year).cast("decimal(10,0)"), _hundredths(value).cast("decimal(19,0)")
    sums = rates.filter(y.isNotNull() & x.isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).cast("decimal(19,0)").alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"),
        F.sum(x * x).alias("sxx"), F.sum(x * y).alias("sxy"),
    )
    spread = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    slope = (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")).cast("double") / spread.cast("double")
    level = (F.col("sy") * F.col("sxx") - F.col("sx") * F.col("sxy")).cast("double") / spread.cast("double")
    return sums.select(
        *keys, F.col("n").cast("bigint").alias("n"),
        F.when(spread > 0, slope / 100).alias("slope"), F.when(spread > 0, level / 100).alias("intercept"),
    )


def at_risk(fitted: DataFrame, targets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """For every target of a group, the rate that its trend gives for that year, and ``at_risk``:
    whether this is below the target; null without a trend."""
    expected = F.col("intercept") + F.col("slope") * F.col("target_year")
    met = targets.join(fitted.select(*keys, "slope", "intercept"), list(keys), "left")
    return met.withColumn("expected", expected).withColumn("at_risk", expected < F.col("target")).drop("slope", "intercept")


# --- Kinds of places --------------------------------------------------------------------


def standardised(table: DataFrame, features: Sequence[str]) -> DataFrame:
    """The rows that have all features, these as whole thousandths of a standard deviation."""
    full = table
    for c in features:
        full = full.filter(finite(F.col(c)).isNotNull())
    units = {c: F.rint(F.col(c) * 10_000).cast("bigint") for c in features}
    full = full.withColumns({f"_{c}": u for c, u in units.items()})
    wide = {c: F.col(f"_{c}").cast("decimal(19,0)") for c in features}
    stats = full.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(x).cast("string").alias(f"s_{c}") for c, x in wide.items()],
        *[F.sum(x * x).cast("string").alias(f"q_{c}") for c, x in wide.items()],
    ).first()
    n, out = stats["n"], {}
    for c in features:
        if not n:
            out[f"z_{c}"] = F.lit(None).cast("bigint")
            continue
        total, squares = int(stats[f"s_{c}"]), int(stats[f"q_{c}"])
        deviation = max(n * squares - total * total, 0) ** 0.5
        z = (F.col(f"_{c}") * n - F.lit(float(total))) / F.lit(deviation or 1.0) * 1000
        out[f"z_{c}"] = F.rint(z).cast("bigint")
    return full.withColumns(out).drop(*[f"_{c}" for c in features])


def clusters(
    table: DataFrame, features: Sequence[str], k: int, iterations: int = 20
) -> DataFrame:
    """``cluster`` of every row that has all features, by k-means on their standard scores.

    The first centres are fixed: points along the diagonal, from one standard deviation below
    the means to one above. Each iteration is one aggregate of whole numbers, of which
    ``k`` rows come to the driver, so labels are the same on every run and partitioning. It
    stops when the centres do. Clusters are numbered by their centres, in order of the
    features; ties of distance go to the lower number.
    """
    if k < 1:
        raise ValueError("k is at least 1")
    scaled = standardised(table, features)
    z = [F.col(f"z_{c}") for c in features]
    at = [-1000 + (2000 * i) // max(k - 1, 1) if k > 1 else 0 for i in range(k)]
    centres = [tuple(a for _ in features) for a in at]

    def nearest(centres: list[tuple[int, ...]]) -> Column:
        each = [
            F.struct(sum((x - F.lit(c)) * (x - F.lit(c)) for x, c in zip(z, centre, strict=True)).alias("d"), F.lit(i).alias("i"))
            for i, centre in enumerate(centres)
        ]
        return (F.least(*each) if k > 1 else each[0])["i"]

    for _ in range(iterations):
        sums = scaled.groupBy(nearest(centres).alias("i")).agg(
            F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(f"s{j}") for j, x in enumerate(z)]
        )
        after = list(centres)
        for row in sums.collect():  # k rows
            after[row["i"]] = tuple((2 * row[f"s{j}"] + row["n"]) // (2 * row["n"]) for j in range(len(features)))
        if after == centres:
            break
        centres = after
    centres = sorted(centres)
    return scaled.withColumn("cluster", nearest(centres)).drop(*[f"z_{c}" for c in features])
