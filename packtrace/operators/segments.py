"""Ordered scans of devices of any length, cut into segments of their order.

A segment is a stretch of a device's order that fits a task: a span of time, or of arrival numbers.
It follows from a row's own values, so no borders are sampled, shipped or broadcast. Rows travel
once, to their segment, and windows stay inside it. What has to cross a border is one small row per
segment - its first and last reading, its count, the run at its end - which are scanned in order
per device, merged, and joined back. Where borders fall changes task sizes, never results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from packtrace.spec import Skew

SEG = "_seg"
MAX_HOT = 1_000_000  # devices above a task's size; each holds at least two tasks' rows


class Cut:
    """How wide segments are: one width for all keys, or a row (keys, _us, _arrivals) per long key.

    A key is a device, or a device's cycle. Other keys then stay whole. ``crowded`` lists instants
    (keys, t_us) with more rows than a task should hold; those are cut by arrival.
    """

    def __init__(self, us: int | None, arrivals: int | None, hot: DataFrame | None = None, crowded: DataFrame | None = None,
                 keys: Sequence[str] = ("device",)):
        self.us, self.arrivals, self.hot, self.crowded, self.keys = us, arrivals, hot, crowded, list(keys)

    def _wide(self, df: DataFrame) -> tuple[DataFrame, Column, Column]:
        if self.hot is None:
            return df, F.lit(self.us), F.lit(self.arrivals)
        return df.join(F.broadcast(self.hot), self.keys, "left"), F.col("_us"), F.col("_arrivals")  # MAX_HOT rows at most

    def by_time(self, df: DataFrame) -> DataFrame:
        """Add ``SEG``, which grows with (t_us, seq)."""
        df, us, arrivals = self._wide(df)
        zero = F.lit(0).cast("bigint")
        bucket, sub, part = F.coalesce(F.floor(F.col("t_us") / us), zero), zero, zero
        if self.crowded is not None:
            listed = self.crowded.join(F.broadcast(self.hot), self.keys).withColumn("_bucket", bucket)
            listed = listed.groupBy(*self.keys, "_bucket").agg(F.collect_set("t_us").alias("_instants"))
            df = df.withColumn("_bucket", bucket).join(F.broadcast(listed), [*self.keys, "_bucket"], "left")  # fewer than tasks
            instants = F.coalesce("_instants", F.array().cast("array<bigint>"))
            inside = F.array_contains(instants, F.col("t_us"))
            sub = (2 * F.size(F.filter(instants, lambda x: x < F.col("t_us"))) + inside.cast("int")).cast("bigint")
            bucket, part = F.col("_bucket"), F.when(inside, F.floor(F.col("seq") / arrivals)).otherwise(zero)
        out = df.withColumn(SEG, F.struct(bucket.alias("bucket"), sub.alias("sub"), part.alias("part")))
        return out.drop("_us", "_arrivals", "_bucket", "_instants")

    def by_arrival(self, df: DataFrame) -> DataFrame:
        """Add ``SEG``, which grows with seq."""
        df, _, arrivals = self._wide(df)
        return df.withColumn(SEG, F.coalesce(F.floor(F.col("seq") / arrivals), F.lit(0).cast("bigint"))).drop("_us", "_arrivals")


def measure(df: DataFrame, skew: Skew, keys: Sequence[str] = ("device",)) -> Cut | None:
    """The cut that ``skew`` names, or one from a sample of the table; None if every key fits a task.

    The sample holds ``per_chunk`` rows for each ``rows_per_task`` of the table; a segment is as wide as
    the shortest stretch of a key's order with so many sampled rows.
    """
    keys = list(keys)
    if skew.segment_us:
        return Cut(skew.segment_us, skew.segment_seq or skew.rows_per_task, keys=keys)
    picked = df.select(*keys, "t_us", "seq")
    if skew.rate < 1.0:
        picked = picked.sample(fraction=skew.rate, seed=skew.seed)
    # a row of no key: Spark drops the plan below an empty shuffle, and with it what is observed there
    nobody = df.sparkSession.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in picked.schema])
    picked = picked.unionByName(nobody)
    key = Window.partitionBy(*keys)
    back = lambda c, *order: F.col(c) - F.lag(c, skew.per_chunk).over(key.orderBy(*order))
    spans = picked.select(*keys, back("t_us", "t_us", "seq").alias("us"), back("seq", "seq").alias("arrivals"))
    hot = spans.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("us") > 0, F.col("us"))).alias("_us"),
        F.min(F.when(F.col("arrivals") > 0, F.col("arrivals"))).alias("_arrivals"))
    hot = hot.filter(F.col("n") >= 2 * skew.per_chunk).drop("n")
    rows = hot.limit(MAX_HOT + 1).collect()
    if not rows:
        return None
    if len(rows) > MAX_HOT:
        raise ValueError("too many keys above the size of a task: raise rows_per_task")
    spark = df.sparkSession
    table = spark.createDataFrame(rows, hot.schema)
    often = picked.join(F.broadcast(table.select(*keys)), keys).groupBy(*keys, "t_us").count().filter(F.col("count") >= skew.per_chunk).drop("count")
    crowded = often.collect()  # each holds a task's rows
    return Cut(None, None, table, spark.createDataFrame(crowded, often.schema) if crowded else None, keys)


def by_key(keys: Sequence[str], order: Sequence[str] = (SEG,)):
    return Window.partitionBy(*keys).orderBy(*order)


def by_device():
    return by_key(["device"])


def joined(rows: DataFrame, carried: DataFrame, keys: Sequence[str] = ("device",)) -> DataFrame:
    """Rows with what their segment's small row carries; rows are already placed by key and segment."""
    return rows.join(carried, [*keys, SEG], "left")


def numbered_after(df: DataFrame, cut: Cut, columns: Sequence[str]) -> DataFrame:
    """Rows in time order over all segments of their key: ``_pos`` from 1, ``_n`` rows of the key, ``_b_`` columns of the row before."""
    keys, at = cut.keys, F.struct("t_us", "seq")
    small = cut.by_time(df.select(*dict.fromkeys([*keys, "seq", "t_us", *columns]))).groupBy(*keys, SEG).agg(
        F.count(F.lit(1)).alias("k"), F.max_by(F.struct(*columns), at).alias("tail"))
    line = by_key(keys)
    small = small.select(
        *keys, SEG, F.sum("k").over(Window.partitionBy(*keys)).alias("_n"), (F.sum("k").over(line) - F.col("k")).alias("_earlier"),
        F.lag("tail").over(line).alias("_tail"))
    inside = by_key([*keys, SEG], ["t_us", "seq"])
    rows = cut.by_time(df).withColumns({"_pos": F.row_number().over(inside), **{f"_b_{c}": F.lag(c).over(inside) for c in columns}})
    rows = joined(rows, small, keys)
    first = F.col("_pos") == 1
    rows = rows.withColumns({f"_b_{c}": F.when(first, F.col("_tail")[c]).otherwise(F.col(f"_b_{c}")) for c in columns})
    return rows.withColumn("_pos", F.col("_pos") + F.col("_earlier")).drop("_tail", "_earlier", SEG)


def previous_arrival(df: DataFrame, cut: Cut, column: str, name: str) -> DataFrame:
    """Add the value of ``column`` in the arrival before, over all segments of the device."""
    ends = cut.by_arrival(df.select("device", "seq", column)).groupBy("device", SEG).agg(F.max_by(column, "seq").alias("_end"))
    carried = ends.select("device", SEG, F.lag("_end").over(by_device()).alias("_carried"))
    inside = Window.partitionBy("device", SEG).orderBy("seq")
    rows = cut.by_arrival(df).withColumns({"_first": F.row_number().over(inside) == 1, "_before": F.lag(column).over(inside)})
    rows = joined(rows, carried).withColumn(name, F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_before")))
    return rows.drop(SEG, "_first", "_before", "_carried")


def same_reading(a: str, b: str) -> Column:
    """Whether voltage and current, both known, did not change."""
    return F.coalesce((F.col(f"{a}voltage") == F.col(f"{b}voltage")) & (F.col(f"{a}current") == F.col(f"{b}current")), F.lit(False))


_READING = ("t_us", "voltage", "current", "temperature")


def summaries(df: DataFrame, cut: Cut) -> DataFrame:
    """One row per device and segment, in a single column ``s``: first and last reading, rows, the run at the end, time steps.

    Merging is associative: ``carried`` scans these rows. They are dealt out by device in one column,
    so that both its readers use the same shuffle.
    """
    line = cut.by_time(df.select("device", "seq", *_READING))
    inside = Window.partitionBy("device", SEG).orderBy("t_us", "seq")
    line = line.withColumns({"_pos": F.row_number().over(inside), **{f"_{c}": F.lag(c).over(inside) for c in ("t_us", "voltage", "current")}})
    step = F.abs(F.col("t_us") - F.col("_t_us"))
    at = F.struct("t_us", "seq")
    rows = line.groupBy("device", SEG).agg(
        F.count(F.lit(1)).alias("n"), F.min_by(F.struct(*_READING), at).alias("head"), F.max_by(F.struct(*_READING), at).alias("tail"),
        # rows at the end that repeat the reading before them
        (F.count(F.lit(1)) - F.max(F.when(~same_reading("", "_"), F.col("_pos")))).alias("run"),
        F.collect_list(F.when(step != 0, step)).alias("steps"))  # of one segment
    packed = F.array(F.struct("n", "head", "tail", "run", "steps")).alias("s")
    return rows.select("device", SEG, packed).repartition("device")


def carried(found: DataFrame, with_median: bool) -> DataFrame:
    """Per device and segment: the reading before it, the instant after it, the run that reaches it, and the median step."""
    s = F.element_at("s", 1)
    line = by_device()
    small = found.select("device", SEG, s["n"].alias("n"), s["run"].alias("run"), s["head"].alias("head"), s["tail"].alias("tail"))
    small = small.withColumns({"p": F.lag("tail").over(line), "next": F.lead("head.t_us").over(line)})
    repeats = F.coalesce((F.col("head.voltage") == F.col("p.voltage")) & (F.col("head.current") == F.col("p.current")), F.lit(False))
    # a segment that repeats one reading throughout lengthens the run; any other starts a new one
    small = small.withColumn("through", repeats & (F.col("run") == F.col("n") - 1))
    small = small.withColumn("_from", F.sum((~F.col("through")).cast("int")).over(line))
    runs = Window.partitionBy("device", "_from").orderBy(SEG)
    small = small.withColumn("_run", F.sum(F.when(F.col("through"), F.col("n")).otherwise(F.col("run"))).over(runs))
    out = small.select(
        "device", SEG, *[F.col(f"p.{c}").alias(f"_c_{c}") for c in _READING], F.col("next").alias("_c_next"),
        F.coalesce(F.lag("_run").over(line), F.lit(0)).alias("_c_run"))
    return out.join(median_step(found), "device", "left") if with_median else out


def median_step(found: DataFrame) -> DataFrame:
    """(device, _median) of the time steps that are not zero, those across borders among them."""
    s = F.element_at("s", 1)
    across = F.abs(s["head"]["t_us"] - F.lag(s["tail"]["t_us"]).over(by_device()))
    steps = found.select("device", s["steps"].alias("steps"), across.alias("across"))
    steps = steps.select("device", F.explode(F.array_append("steps", F.when(F.col("across") != 0, F.col("across")))).alias("step"))
    steps = steps.filter("step is not null")
    steps = steps.groupBy("device", "step").agg(F.count(F.lit(1)).alias("k"))
    whole = Window.partitionBy("device")
    steps = steps.withColumns({"upto": F.sum("k").over(whole.orderBy("step")), "n": F.sum("k").over(whole)})
    low, high = F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2)
    middle = F.min(F.when(F.col("upto") > low, F.col("step"))) + F.min(F.when(F.col("upto") > high, F.col("step")))
    return steps.groupBy("device").agg((middle / 2).alias("_median"))


def ranked_quantile(values: DataFrame, keys: Sequence[str], prob: float, name: str) -> DataFrame:
    """(keys, name): the exact interpolated quantile per key of the column ``x`` of ``values``.

    Equal values are counted before they are shuffled; a key's distinct values are then ranked in order.
    """
    counted = values.filter("x is not null").groupBy(*keys, "x").agg(F.count(F.lit(1)).alias("k"))
    whole = Window.partitionBy(*keys)
    counted = counted.withColumns({"upto": F.sum("k").over(whole.orderBy("x")), "n": F.sum("k").over(whole)})
    at = F.lit(prob) * (F.col("n") - 1)
    low = F.min(F.when(F.col("upto") > F.floor(at), F.col("x")))
    high = F.min(F.when(F.col("upto") > F.ceil(at), F.col("x")))
    over = F.max(at - F.floor(at))
    return counted.groupBy(*keys).agg(F.when(over == 0, low).otherwise(low + over * (high - low)).alias(name))
