"""Exact interpolated quantiles, also for groups too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from packtrace.session import durable
from packtrace.spec import Skew

PIVOTS = 500
MAX_LARGE = 500_000  # groups above a task's size, whose keys are broadcast
ACCURACY = 100_000  # of the approximate percentiles that bracket a rank


def by_group(
    df: DataFrame,
    keys: Sequence[str],
    value: Column,
    probs: Sequence[float],
    skew: Skew = Skew(),
    approx: bool = False,
) -> DataFrame:
    """One row per key with ``quantiles``, an array in the order of ``probs``.

    The built-in exact percentile keeps every distinct value of a group in one
    buffer, so groups above ``skew.rows_per_task`` go through ``select_exact``.
    """
    keys = list(keys)
    rows = df.select(*keys, value.alias("_v")).filter(F.col("_v").isNotNull())
    if approx:
        return rows.groupBy(*keys).agg(F.percentile_approx("_v", list(probs), 10_000).alias("quantiles"))
    exact = F.percentile("_v", F.array(*[F.lit(float(p)) for p in probs])).alias("quantiles")
    sizes = rows.groupBy(*keys).count().filter(F.col("count") > skew.rows_per_task).drop("count")
    if not keys:
        big = rows.count() > skew.rows_per_task
        return select_exact(rows, keys, F.col("_v"), probs, skew) if big else rows.agg(exact)
    large = sizes.limit(MAX_LARGE + 1).collect()  # at most table_rows / rows_per_task keys
    if len(large) > MAX_LARGE:
        raise ValueError(f"more than {MAX_LARGE} groups above the size of a task: raise rows_per_task")
    if not large:
        return rows.groupBy(*keys).agg(exact)
    table = F.broadcast(df.sparkSession.createDataFrame(large, sizes.schema))
    small = rows.join(table, keys, "left_anti").groupBy(*keys).agg(exact)
    return small.unionByName(select_exact(rows.join(table, keys, "left_semi"), keys, F.col("_v"), probs, skew))


def select_exact(
    df: DataFrame, keys: Sequence[str], value: Column, probs: Sequence[float], skew: Skew, settled: bool = False
) -> DataFrame:
    """Exact quantiles of large groups, none of which is ever gathered.

    Each wanted rank lives in an open interval of values. A round takes two pivots
    close to the rank from an approximate percentile, counts exactly how many values
    lie below, at and between them, and keeps the part that holds the rank, so the
    interval shrinks some hundredfold whatever the values look like. What is left
    below one task's worth is ranked exactly.

    One small row per group and rank travels to the tasks. The values are read several
    times; they are written to the shared folder first unless ``settled`` says that
    reading ``df`` again is cheap.
    """
    keys = list(keys)
    rows = df.select(*keys, value.cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    if not settled:
        rows = durable(rows)
    wanted = F.array(*[F.struct(F.lit(i).alias("p"), F.lit(float(p)).alias("prob")) for i, p in enumerate(probs)])
    lowest, highest = F.lit(float("-inf")), F.lit(float("inf"))
    sizes = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("_v") == lowest).alias("n_lowest"),
        F.count_if(F.col("_v") == highest).alias("n_highest"),
    )
    ranks = sizes.filter("n > 0").select("*", F.explode(wanted).alias("w")).select("*", "w.p", "w.prob")
    at = F.col("prob") * (F.col("n") - 1)
    infinite = F.when(F.floor(at) < F.col("n_lowest"), lowest)
    infinite = infinite.when(F.floor(at) >= F.col("n") - F.col("n_highest"), highest)
    ranks = ranks.select(
        *keys,
        "p",
        F.floor(at).alias("rank"),
        (at - F.floor(at)).alias("part"),
        lowest.alias("lo"),
        highest.alias("hi"),
        F.col("n_lowest").alias("below"),
        (F.col("n") - F.col("n_lowest") - F.col("n_highest")).alias("held"),
        infinite.alias("found"),
    )
    ranks = durable(ranks)
    wide = F.col("found").isNull() & (F.col("held") > skew.rows_per_task)
    while not ranks.filter(wide).isEmpty():
        narrowed = _narrow(rows, ranks.filter(wide), keys)
        ranks = durable(ranks.filter(~wide).unionByName(narrowed))
    return _interpolate(rows, _rank_rest(rows, ranks, keys), keys)


def _beside(rows: DataFrame, ranks: DataFrame, keys: list[str]) -> DataFrame:
    """Every value next to the ranks wanted of its group; few rows per group."""
    if not keys:
        ranks = ranks.groupBy().agg(F.collect_list(F.struct("*")).alias("_r"))
        return rows.join(F.broadcast(ranks), on=F.lit(True), how="left").select("_v", F.inline("_r"))
    named = F.broadcast(ranks.withColumnsRenamed({k: f"_k_{k}" for k in keys}))
    match = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return rows.join(named, match).drop(*[f"_k_{k}" for k in keys])


def _narrow(rows: DataFrame, ranks: DataFrame, keys: list[str]) -> DataFrame:
    """One round: replace each interval by the part of it that holds the rank."""
    state = [*keys, "p", "rank", "part", "lo", "hi", "below", "held"]
    inside = (F.col("_v") > F.col("lo")) & (F.col("_v") < F.col("hi"))
    grid = [i / PIVOTS for i in range(PIVOTS + 1)]
    pivots = _beside(rows, ranks, keys).filter(inside).groupBy(*state).agg(
        F.percentile_approx("_v", grid, 2 * PIVOTS).alias("c")
    )
    place = (F.floor((F.col("rank") - F.col("below")) / F.col("held") * PIVOTS)).cast("int")
    pivots = pivots.select(
        *state,
        F.get("c", F.greatest(place - 1, F.lit(0))).alias("a"),
        F.get("c", F.least(place + 2, F.lit(PIVOTS))).alias("b"),
    )
    v, a, b = F.col("_v"), F.col("a"), F.col("b")
    counts = _beside(rows, pivots, keys).filter(inside).groupBy(*state, "a", "b").agg(
        F.count_if(v < a).alias("n_low"),
        F.count_if(v == a).alias("n_a"),
        F.count_if((v > a) & (v < b)).alias("n_mid"),
        F.count_if((v == b) & (v > a)).alias("n_b"),
    )
    r = F.col("rank") - F.col("below")
    upto_a = F.col("n_low") + F.col("n_a")
    upto_mid = upto_a + F.col("n_mid")
    upto_b = upto_mid + F.col("n_b")
    low, mid, high = r < F.col("n_low"), (r >= upto_a) & (r < upto_mid), r >= upto_b
    return counts.select(
        *keys,
        "p",
        "rank",
        "part",
        F.when(mid, a).when(high, b).otherwise(F.col("lo")).alias("lo"),
        F.when(mid, b).when(low, a).otherwise(F.col("hi")).alias("hi"),
        (F.col("below") + F.when(mid, upto_a).when(high, upto_b).otherwise(0)).alias("below"),
        F.when(low, F.col("n_low")).when(mid, F.col("n_mid")).otherwise(F.col("held") - upto_b).alias("held"),
        F.when((r >= F.col("n_low")) & (r < upto_a), a).when((r >= upto_mid) & (r < upto_b), b).alias("found"),
    )


def _rank_rest(rows: DataFrame, ranks: DataFrame, keys: list[str]) -> DataFrame:
    """Settle the ranks whose interval now fits a task."""
    inside = (F.col("_v") > F.col("lo")) & (F.col("_v") < F.col("hi"))
    state = [*keys, "p", "rank", "part", "below"]
    left = _beside(rows, ranks.filter("found is null"), keys).filter(inside).groupBy(*state, "_v").count()
    upto = F.sum("count").over(Window.partitionBy(*keys, "p").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    left = left.withColumn("upto", F.col("below") + upto).filter(F.col("upto") > F.col("rank"))
    left = left.groupBy(*keys, "p", "rank", "part").agg(F.min("_v").alias("found"))
    return ranks.filter("found is not null").select(*left.columns).unionByName(left)


def _interpolate(rows: DataFrame, ranks: DataFrame, keys: list[str]) -> DataFrame:
    v, found = F.col("_v"), F.col("found")
    sides = _beside(rows, ranks, keys).groupBy(*keys, "p", "rank", "part", "found").agg(
        F.count_if(v <= found).alias("upto"), F.min(F.when(v > found, v)).alias("next")
    )
    upper = F.when(F.col("upto") > F.col("rank") + 1, found).otherwise(F.coalesce("next", "found"))
    value_at = F.when(F.col("part") == 0, found).otherwise(found + F.col("part") * (upper - found))
    per_key = sides.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("p", value_at.alias("q")))).alias("q"))
    return per_key.select(*keys, F.col("q")["q"].alias("quantiles"))


def by_column(
    df: DataFrame, columns: Sequence[Column], probs: Sequence[float], approx: bool = False, accuracy: int = ACCURACY
) -> DataFrame:
    """One row per column of a wide table: place, n, mean, std and exact interpolated quantiles.

    Starts no job, writes nothing and reads ``df`` twice. The first pass merges one quantile sketch
    per column, whose cuts bracket each rank within 5 / accuracy of the rows; it is one scalar
    subquery, referred to once. The second counts values inside a bracket by value and all
    others by the stretch between brackets they fall into, so one running total proves each
    bracket and settles its rank. A rank outside its bracket is an error, never a wrong value.
    Columns of at most ``accuracy`` values are ranked whole. ``approx`` stops after the first pass.
    """
    probs = [float(p) for p in probs]
    places = range(len(columns))
    names = [f"_c{i}" for i in places]
    values = df.select(*[c.cast("double").alias(n) for c, n in zip(columns, names)])
    grid = [min(1.0, max(0.0, p + side * 4 / accuracy)) for p in probs for side in (-1, 1)]
    wanted = probs if approx else grid

    def facts(name: str) -> Column:
        moments = [F.avg(name).alias("mean"), F.stddev_samp(name).alias("std")] if approx else []
        return F.struct(F.count(name).alias("n"), *moments, F.percentile_approx(name, wanted, accuracy).alias("cuts"))

    first = values.agg(F.array(*[facts(n) for n in names]).alias("_f"))
    if approx:
        return first.select(F.posexplode("_f").alias("place", "f")).select("place", "f.n", "f.mean", "f.std", F.col("f.cuts").alias("quantiles"))

    # one row: where brackets begin and end, apart
    ends = lambda side: lambda f: F.filter(f["cuts"], lambda x, k: k % 2 == side)
    first = first.select(F.transform("_f", lambda f: F.struct(f["n"].alias("n"), ends(0)(f).alias("lo"), ends(1)(f).alias("hi"))).alias("_f"))

    def passed(i: int) -> dict[str, Column]:
        """How many brackets begin at or below the value, how many end below it, and whether the column is ranked whole."""
        v, fact = F.col(names[i]), F.get("_f", F.lit(i))
        return {
            f"_whole{i}": fact["n"] <= accuracy,
            f"_begun{i}": F.size(F.filter(fact["lo"], lambda x: x <= v)),
            f"_ended{i}": F.size(F.filter(fact["hi"], lambda x: x < v))}

    def placed(i: int) -> Column:
        v, whole = F.col(names[i]), F.col(f"_whole{i}")
        begun, ended = F.col(f"_begun{i}"), F.col(f"_ended{i}")
        slot = F.when(whole, 0).otherwise(begun + ended)  # grows with the value
        return F.when(v.isNotNull(), F.struct(
            F.lit(i).alias("place"), slot.alias("slot"), F.when(whole | (begun > ended), v).alias("v"), v.alias("x")))

    beside = values.withColumn("_f", first.scalar())
    beside = beside.withColumns({name: c for i in places for name, c in passed(i).items()})
    picked = beside.select(F.explode(F.array_compact(F.array(*[placed(i) for i in places]))).alias("x")).select("x.*")
    held = picked.groupBy("place", "slot", "v").agg(F.count(F.lit(1)).alias("k"), F.avg("x").alias("m"), F.var_pop("x").alias("q"))
    place = Window.partitionBy("place")
    upto = F.sum("k").over(place.orderBy("slot", "v").rowsBetween(Window.unboundedPreceding, 0))
    held = held.withColumns({"upto": upto, "n": F.sum("k").over(place), "total": F.sum(F.col("k") * F.col("m")).over(place)})
    mean = F.col("total") / F.col("n")
    square = F.sum(F.col("k") * (F.col("q") + (F.col("m") - mean) * (F.col("m") - mean)))
    found = []
    for j, p in enumerate(probs):
        at = F.lit(p) * (F.col("n") - 1)
        for name, rank in (("a", F.floor(at)), ("b", F.least(F.floor(at) + 1, F.col("n") - 1))):
            found.append(F.min(F.when(F.col("upto") > rank, F.struct("slot", "v")))["v"].alias(f"{name}{j}"))
    spread = F.when(F.max("n") > 1, F.sqrt(square / (F.max("n") - 1)))
    ranked = held.groupBy("place").agg(F.max("n").alias("n"), F.max(mean).alias("mean"), spread.alias("std"), *found)

    def quantile(j: int, p: float) -> Column:
        at = F.lit(p) * (F.col("n") - 1)
        over = at - F.floor(at)
        a, b = F.col(f"a{j}"), F.col(f"b{j}")
        value = F.when(over == 0, a).otherwise(a + over * (b - a))
        return F.coalesce(value, F.raise_error(F.lit("a rank lies outside its bracket: raise the accuracy")).cast("double"))

    settled = ranked.select("place", "n", "mean", "std", F.array(*[quantile(j, p) for j, p in enumerate(probs)]).alias("quantiles"))
    listed = df.sparkSession.range(len(names), numPartitions=1).select(F.col("id").cast("int").alias("place"))
    found = listed.join(F.broadcast(settled), "place", "left")  # one short row per column
    return found.select("place", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), "mean", "std", "quantiles")
