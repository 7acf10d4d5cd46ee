"""Half-open validity windows, and runs that start soon after a flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from openloop.functions.clock import (
    DAY_US,
    MINUTE_US,
    day_of,
    day_start_micros,
    epoch_micros,
    month_of,
    slot_of,
)
from openloop.functions.durable import staged
from openloop.functions.sizing import hinted


def in_force(at: Column, start: Column, end: Column) -> Column:
    """``start <= at < end``, where a NULL end means still in force."""
    return (start <= at) & (end.isNull() | (at < end))


def policies_in_force(policy: DataFrame, as_of: Column) -> DataFrame:
    """Policies in force at one instant."""
    return policy.filter(in_force(as_of, F.col("effective_from"), F.col("effective_to")))


def policies_by_month(policy: DataFrame, first: Column, last: Column) -> DataFrame:
    """(policy columns, month) for every month start from ``first`` to ``last`` at which a
    policy is in force. Each policy lists its own months, so no join is needed."""
    start = F.greatest(month_of(policy, "effective_from"), first)
    stop = F.least(F.coalesce(day_of(policy, "effective_to"), last), last)
    months = F.when(start <= stop, F.sequence(start, stop, F.expr("interval 1 month")))
    listed = policy.withColumns(
        {
            "month": F.explode(months),
            "from_us": epoch_micros(policy, "effective_from"),
            "to_us": epoch_micros(policy, "effective_to"),
        }
    )
    at = day_start_micros(F.col("month"))
    return listed.filter(in_force(at, F.col("from_us"), F.col("to_us"))).drop("from_us", "to_us")


# Instants and bounds of windows are placed in [0, 2 ** TOP) microseconds; the years 1 to 9999
# lie inside.
TOP = 59
_SHIFT = 1 << (TOP - 1)
CELL = ["dyadic_level", "dyadic_cell"]


def _placed(us: Column) -> Column:
    return us + F.lit(_SHIFT).cast("bigint")


def window_cells(windows: DataFrame, start: Column, end: Column) -> DataFrame:
    """``windows`` with (dyadic_level, dyadic_cell): one row for each dyadic cell of the half-open window from
    ``start`` to ``end`` microseconds; a NULL end is open, a NULL start no window.

    Cell c of level l covers the microseconds from c x 2^l up to (c + 1) x 2^l. At each level a
    window has at most two cells that no larger cell of it covers, so it has at most
    2 x log2(its length) of them, an instant lies in exactly one, and no list of dates is made.
    """
    low, high = _placed(start), F.coalesce(_placed(end), F.lit(1 << TOP).cast("bigint"))

    def of_level(level: Column) -> Column:
        # The cells of a level that the window covers whole are first .. last - 1; those that do
        # not pair up to a cell of the next level are an odd first one and an even last one.
        size = F.call_function("shiftleft", F.lit(1).cast("bigint"), level)
        first = F.call_function("shiftright", low + size - F.lit(1), level)
        last = F.call_function("shiftright", high, level)
        some = first < last

        def cell(wanted: Column, number: Column) -> Column:
            return F.when(some & wanted, F.struct(level.alias("dyadic_level"), number.alias("dyadic_cell")))

        one = F.lit(1).cast("bigint")
        return F.array(cell(first % 2 == 1, first), cell(last % 2 == 1, last - one))

    levels = F.sequence(F.lit(0), F.lit(TOP))
    cells = F.filter(F.flatten(F.transform(levels, of_level)), lambda c: c.isNotNull())
    return windows.withColumn("_cell", F.explode(cells)).select(*windows.columns, "_cell.*")


def instant_cells(instants: DataFrame, us: Column, levels: list[int]) -> DataFrame:
    """``instants`` with (dyadic_level, dyadic_cell): the cells of ``levels`` around the instant ``us``."""

    def around(level: Column) -> Column:
        number = F.call_function("shiftright", _placed(us), level)
        return F.struct(level.alias("dyadic_level"), number.alias("dyadic_cell"))

    cells = F.transform(F.array(*(F.lit(n) for n in sorted(levels))), around)
    return instants.withColumn("_cell", F.explode(cells)).select(*instants.columns, "_cell.*")


def _levels_of(cells: DataFrame) -> list[int]:
    """The levels in use; there are at most TOP + 1."""
    return [row.dyadic_level for row in cells.select("dyadic_level").distinct().collect()]


WINDOW = ["window_from", "window_to"]


def _policy_windows(policy: DataFrame, columns: list[str]) -> DataFrame:
    return policy.select(
        *columns,
        epoch_micros(policy, "effective_from").alias("window_from"),
        epoch_micros(policy, "effective_to").alias("window_to"),
    )


def _cells_of(windows: DataFrame) -> DataFrame:
    return window_cells(windows, *(F.col(c) for c in WINDOW)).drop(*WINDOW)


# Versions of one key that an instant is compared with one by one. Windows of whole days have
# cells at more levels than that, and each level costs an instant a row of its own.
FEW_VERSIONS = 32


def policies_at(
    instants: DataFrame, us: str, policy: DataFrame, keys: dict[str, str] | None = None
) -> DataFrame:
    """``instants`` joined to the policies in force at their ``us``: one row for each pair, found
    by equality of dyadic cells. ``keys`` names columns that must be equal as well ({column of
    instants: column of policy}); with a policy's own key each instant meets its versions only.

    An instant has a row at every level in use, so where the keys alone leave at most
    FEW_VERSIONS versions, they are joined and their windows compared, and an instant stays one
    row. Only the instants of keys with more versions are listed by cell.
    """
    keys = keys or {}
    windows = _policy_windows(policy, policy.columns)
    if not keys:
        return _met_in_cells(instants, us, policy, windows, keys)
    own = list(keys.values())
    some = F.col("window_to").isNull() | (F.col("window_from") < F.col("window_to"))
    windows = staged(windows.filter(F.col("window_from").isNotNull() & some).dropna(subset=own))
    many = staged(
        windows.groupBy(*own).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > FEW_VERSIONS).select(*own)
    )
    if many.isEmpty():
        return _met_by_key(instants, us, policy, windows, keys)
    few = windows.join(hinted(many), own, "left_anti").select(*windows.columns)
    rest = windows.join(hinted(many), own, "left_semi").select(*windows.columns)
    popular = many.toDF(*(f"many_{n}" for n in range(len(own))))
    on = [instants[a] == popular[f"many_{n}"] for n, a in enumerate(keys)]
    listed = instants.join(hinted(popular), on, "left_semi")
    found = _met_by_key(instants, us, policy, few, keys)
    return found.union(_met_in_cells(listed, us, policy, rest, keys))


def _beside(instants: DataFrame, found: DataFrame, keys: dict[str, str]) -> tuple[DataFrame, dict[str, str]]:
    """``found`` with a leading ``_`` before the names that ``instants`` has as well, and its new
    name of each column."""
    given = [c for c in instants.columns if c not in keys.values()]
    names = {c: f"_{c}" if c in given else c for c in found.columns}
    return found.select(*(F.col(c).alias(n) for c, n in names.items())), names


def _taken_over(instants: DataFrame, policy: DataFrame, keys: dict[str, str]) -> list[str]:
    return [c for c in policy.columns if c not in instants.columns and c not in keys.values()]


def _met_by_key(
    instants: DataFrame, us: str, policy: DataFrame, windows: DataFrame, keys: dict[str, str]
) -> DataFrame:
    named, name = _beside(instants, windows, keys)
    on = [instants[a] == named[name[b]] for a, b in keys.items()]
    on.append(in_force(instants[us], *(named[name[c]] for c in WINDOW)))
    met = instants.join(hinted(named), on)
    kept = [named[c] for c in _taken_over(instants, policy, keys)]
    return met.select(*(instants[c] for c in instants.columns), *kept)


def _met_in_cells(
    instants: DataFrame, us: str, policy: DataFrame, windows: DataFrame, keys: dict[str, str]
) -> DataFrame:
    cells = staged(_cells_of(windows))
    wanted = instant_cells(instants, F.col(us), _levels_of(cells))
    named, name = _beside(wanted, cells, keys)
    on = [wanted[c] == named[name[c]] for c in CELL]
    on += [wanted[a] == named[name[b]] for a, b in keys.items()]
    met = wanted.join(hinted(named), on)
    kept = [named[c] for c in _taken_over(instants, policy, keys)]
    return met.select(*(wanted[c] for c in instants.columns), *kept)


def number_in_force(instants: DataFrame, us: str, policy: DataFrame) -> DataFrame:
    """``instants`` with ``in_force``, the number of policies in force at their ``us``; 0 for a
    NULL instant. Windows fold to one count per cell and instants to their distinct values
    before they meet, so neither a popular cell nor a hot instant is listed row by row."""
    cells = _cells_of(_policy_windows(policy, [])).groupBy(*CELL).agg(F.count(F.lit(1)).alias("n"))
    cells = staged(cells)
    moments = staged(instants.select(F.col(us).alias("_us")).filter("_us IS NOT NULL").distinct())
    met = instant_cells(moments, F.col("_us"), _levels_of(cells)).join(
        hinted(cells), CELL
    )
    counted = met.groupBy("_us").agg(F.sum("n").alias("in_force"))
    found = instants.join(counted, instants[us] == counted["_us"], "left").drop("_us")
    return found.withColumn("in_force", F.coalesce("in_force", F.lit(0).cast("bigint")))


def first_run_after(
    flags: DataFrame, flag_us: str, runs: DataFrame, run_id: str = "scan_run_id"
) -> DataFrame:
    """``flags`` with the run that starts first after ``flag_us`` (microseconds, strictly after):
    its id (of runs that start together the smallest), ``run_us`` and ``wait_us``, all NULL where
    no run is left.

    No flag is paired with a run. Runs and flags fold to one mark per instant; a mark takes over
    the next run of its own minute, else the first run of a later minute of its day, else the
    first run of a later day, so every window holds one minute, one day or one row per day.
    """
    starts = runs.select(epoch_micros(runs, "started_at").alias("us"), F.col(run_id).alias("run"))
    starts = starts.filter("us IS NOT NULL AND run IS NOT NULL").groupBy("us").agg(F.min("run").alias("run"))
    moments = staged(flags.select(F.col(flag_us).alias("us")).filter("us IS NOT NULL").distinct())
    nothing = F.lit(None).cast(starts.schema["run"].dataType)
    marks = starts.withColumn("asked", F.lit(False)).unionByName(
        moments.select("us", nothing.alias("run"), F.lit(True).alias("asked"))
    )
    marks = marks.groupBy("us").agg(F.min("run").alias("run"), F.max("asked").alias("asked"))
    marks = staged(
        marks.withColumns(
            {"day": slot_of(F.col("us"), DAY_US), "minute": slot_of(F.col("us"), MINUTE_US)}
        )
    )

    def next_of(group: list[str], order: str, value: str) -> Column:
        """The value of the nearest later row that has one, by going backwards."""
        later = Window.partitionBy(*group).orderBy(F.desc(order))
        return F.last(value, ignorenulls=True).over(later.rowsBetween(Window.unboundedPreceding, -1))

    start = F.when(F.col("run").isNotNull(), F.struct("us", "run"))
    heads = marks.filter("run IS NOT NULL").groupBy("day", "minute").agg(F.min(F.struct("us", "run")).alias("head"))
    asked = marks.filter("asked").select("day", "minute").distinct().withColumn("head", F.lit(None).cast(heads.schema["head"].dataType))
    minutes = staged(heads.unionByName(asked).groupBy("day", "minute").agg(F.min("head").alias("head")))
    # One row per calendar day.
    days = minutes.groupBy("day").agg(F.min("head").alias("head"))
    days = days.select("day", next_of([], "day", "head").alias("next_day"))
    minutes = minutes.select("day", "minute", next_of(["day"], "minute", "head").alias("next_minute"))
    minutes = minutes.join(days, "day").select(
        "minute", F.coalesce("next_minute", "next_day").alias("elsewhere")
    )
    near = marks.withColumn("start", start).select(
        "us", "minute", "asked", next_of(["minute"], "us", "start").alias("here")
    )
    found = near.filter("asked").join(minutes, "minute").select(
        F.col("us").alias("_us"), F.coalesce("here", "elsewhere").alias("_run")
    )
    met = flags.join(found, flags[flag_us] == found["_us"], "left").select(*flags.columns, "_run")
    return met.select(
        *flags.columns,
        F.col("_run.run").alias(run_id),
        F.col("_run.us").alias("run_us"),
        (F.col("_run.us") - F.col(flag_us)).alias("wait_us"),
    )


def _running_runs(marks: DataFrame) -> DataFrame:
    """Adds to marks (us, n), one row per instant, the number of runs started up to and
    including each instant. The total is built from days, minutes of a day and instants of a
    minute, so that every window stays short however many runs there are."""
    upto = (Window.unboundedPreceding, Window.currentRow)
    marks = marks.withColumns(
        {"day": slot_of(F.col("us"), DAY_US), "minute": slot_of(F.col("us"), MINUTE_US)}
    )
    minutes = marks.groupBy("day", "minute").agg(F.sum("n").alias("in_minute"))
    days = minutes.groupBy("day").agg(F.sum("in_minute").alias("in_day"))
    # One row per calendar day.
    before_day = F.sum("in_day").over(Window.orderBy("day").rowsBetween(*upto)) - F.col("in_day")
    days = days.select("day", before_day.alias("before_day"))
    in_day = Window.partitionBy("day").orderBy("minute").rowsBetween(*upto)
    minutes = minutes.join(days, "day").select(
        "minute",
        (F.col("before_day") + F.sum("in_minute").over(in_day) - F.col("in_minute")).alias("before"),
    )
    in_minute = Window.partitionBy("minute").orderBy("us").rowsBetween(*upto)
    return marks.join(minutes, "minute").select(
        "us", (F.col("before") + F.sum("n").over(in_minute)).alias("runs_upto")
    )


def eligible_runs(flags: DataFrame, runs: DataFrame, days: int) -> DataFrame:
    """``flags`` with ``eligible``, the number of runs that start in (t, t + days].

    The number is a difference of two running totals, so no flag is paired with a run. Flags
    are folded to their distinct instants before they meet the totals.
    """
    width = days * DAY_US
    flag_us = epoch_micros(flags, flags_time(flags))
    starts = runs.select(epoch_micros(runs, "started_at").alias("us")).groupBy("us")
    starts = starts.agg(F.count(F.lit(1)).alias("n"))
    moments = staged(flags.select(flag_us.alias("flag_us")).distinct())
    ends = moments.select(
        F.explode(F.array(F.col("flag_us"), F.col("flag_us") + F.lit(width))).alias("us"),
        F.lit(0).cast("bigint").alias("n"),
    )
    marks = starts.unionByName(ends).groupBy("us").agg(F.sum("n").alias("n"))
    totals = staged(_running_runs(staged(marks)))
    opening = totals.select(F.col("us").alias("flag_us"), F.col("runs_upto").alias("at_flag"))
    closing = totals.select(
        (F.col("us") - F.lit(width)).alias("flag_us"), F.col("runs_upto").alias("at_end")
    )
    counted = moments.join(opening, "flag_us").join(closing, "flag_us")
    counted = counted.select("flag_us", (F.col("at_end") - F.col("at_flag")).alias("eligible"))
    return flags.withColumn("flag_us", flag_us).join(counted, "flag_us").drop("flag_us")


def flags_time(flags: DataFrame) -> str:
    return "flagged_at" if "flagged_at" in flags.columns else "detected_at"
