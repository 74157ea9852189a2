"""Cron text and fire times of schedules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: cron numbers of days and months ---------------------------------
DAYS = {"sun": 0, "mon": 1, "tue": 2, "wed": 3, "thu": 4, "fri": 5, "sat": 6}
MONTHS = {
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "may": 5, "jun": 6,
    "jul": 7, "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12,
}
DEFAULT_SCHEDULE_DAYS = 7
# ------------------------------------------------------------------------------------


def _numbers(names: Column, table: dict[str, int]) -> Column:
    lookup = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.transform(names, lambda n: F.try_element_at(lookup, n))


def _listed(names: Column, table: dict[str, int]) -> Column:
    """Comma list of cron numbers; ``*`` when no name is given."""
    some = F.size(F.coalesce(names, F.array().cast("array<string>"))) > 0
    numbers = F.transform(_numbers(names, table), lambda n: n.cast("string"))
    return F.when(some, F.array_join(numbers, ",")).otherwise("*")


def _known(names: Column, table: dict[str, int]) -> Column:
    return F.coalesce(F.forall(_numbers(names, table), lambda n: n.isNotNull()), F.lit(True))


def valid_schedule(hour: Column, minute: Column, days: Column, months: Column) -> Column:
    """Hour or minute given, both in range, names known."""
    total_hours = F.floor(minute / 60)
    ranges = (
        F.when(hour.isNotNull() & minute.isNotNull(), hour.between(0, 23) & minute.between(0, 59))
        .when(hour.isNotNull(), hour.between(0, 23))
        .when(minute.isNotNull(), total_hours.between(0, 23))
        .otherwise(False)
    )
    return ranges & _known(days, DAYS) & _known(months, MONTHS)


def cron_expr(
    hour: Column, minute: Column, days: Column, months: Column, minute_of_hour: int = 0
) -> Column:
    """Cron text of a schedule; null when it is invalid.

    Both given: at that time on the days and months. Only ``hour``: every that many hours, at
    ``minute_of_hour``. Only ``minute``: every that many minutes; 60 and more count hours too.
    The two "every" forms run on all days.
    """
    stepped_hours = F.floor(minute / 60)
    fixed = F.concat_ws(
        " ",
        minute.cast("string"),
        hour.cast("string"),
        F.lit("*"),
        _listed(months, MONTHS),
        _listed(days, DAYS),
    )
    by_hour = F.concat(F.lit(f"{minute_of_hour} */"), hour.cast("string"), F.lit(" * * *"))
    by_minute = F.concat(
        F.lit("*/"),
        (minute % 60).cast("string"),
        F.lit(" "),
        F.when(stepped_hours > 0, F.concat(F.lit("*/"), stepped_hours.cast("string"))).otherwise(
            "*"
        ),
        F.lit(" * * *"),
    )
    text = (
        F.when(hour.isNotNull() & minute.isNotNull(), fixed)
        .when(hour.isNotNull(), by_hour)
        .otherwise(by_minute)
    )
    return F.when(valid_schedule(hour, minute, days, months), text)


def _steps(size: int, step: Column) -> Column:
    """Cron ``*/step``: multiples of the step below ``size``; none for a step of 0."""
    multiples = F.sequence(F.lit(0), F.lit(size - 1), F.greatest(step, F.lit(1)))
    return F.when(step > 0, multiples).otherwise(F.array().cast("array<int>"))


def schedule_fire_times(schedules: DataFrame, minute_of_hour: int = 0) -> DataFrame:
    """Fire times of each schedule between ``starts`` and ``ends`` (both inclusive).

    ``schedules``: id, hour, minute, days, months, starts, ends; a null ``ends`` is a week after
    ``starts``. Days are opened first and filtered by weekday and month before hours and minutes
    are, so only days that fire grow into times.
    """
    hour, minute = F.col("hour"), F.col("minute")
    fixed = hour.isNotNull() & minute.isNotNull()
    stepped_hours = F.floor(minute / 60).cast("int")
    hours = (
        F.when(fixed, F.array(hour))
        .when(hour.isNotNull(), _steps(24, hour))
        .when(stepped_hours > 0, _steps(24, stepped_hours))
        .otherwise(F.sequence(F.lit(0), F.lit(23)))
    )
    minutes = (
        F.when(fixed, F.array(minute))
        .when(hour.isNotNull(), F.array(F.lit(minute_of_hour)))
        .otherwise(_steps(60, minute % 60))
    )
    ends = F.coalesce("ends", F.col("starts") + F.make_dt_interval(F.lit(DEFAULT_SCHEDULE_DAYS)))
    ok = valid_schedule(hour, minute, F.col("days"), F.col("months")) & (F.col("starts") <= ends)
    timed = schedules.where(ok).select(
        "*", ends.alias("__ends"), hours.alias("__hs"), minutes.alias("__ms")
    )
    open_days = timed.select(
        "*", F.explode(F.sequence(F.to_date("starts"), F.to_date("__ends"))).alias("__day")
    )

    def fits(names: str, table: dict[str, int], number: Column) -> Column:
        none = F.coalesce(F.size(names) <= 0, F.lit(True))
        return ~fixed | none | F.array_contains(_numbers(F.col(names), table), number)

    times = (
        open_days.where(fits("days", DAYS, F.dayofweek("__day") - 1))
        .where(fits("months", MONTHS, F.month("__day")))
        .select("id", "starts", "__ends", "__day", F.explode("__hs").alias("__h"), "__ms")
        .select("id", "starts", "__ends", "__day", "__h", F.explode("__ms").alias("__m"))
    )
    fire = F.timestamp_seconds(
        F.unix_seconds(F.col("__day").cast("timestamp")) + F.col("__h") * 3600 + F.col("__m") * 60
    )
    return (
        times.withColumn("fire_at", fire)
        .where(F.col("fire_at").between(F.col("starts"), F.col("__ends")))
        .select("id", "fire_at")
    )
