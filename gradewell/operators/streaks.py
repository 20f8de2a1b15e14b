"""Streaks and completion of daily habits from an event table.

A habit is an event type, and a day counts as done when it has an event.  All
windows run over distinct days of one user and habit, so their size is bounded
by the calendar and not by the number of events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GOAL_DAYS = 66
HABIT = ("user_id", "event_type")


def completed_days(events: DataFrame) -> DataFrame:
    """Days on which a user fulfilled a habit."""
    return events.select(*HABIT, F.to_date("ts").alias("day")).distinct()


def last_day(days: DataFrame) -> Column:
    """The latest day in the data, the reference day of the reports."""
    return days.agg(F.max("day")).scalar()


def runs(days: DataFrame) -> DataFrame:
    """Unbroken runs of days: within a run, day minus row number is constant."""
    number = F.row_number().over(Window.partitionBy(*HABIT).orderBy("day"))
    return (
        days.withColumn("anchor", F.date_sub("day", number))
        .groupBy(*HABIT, "anchor")
        .agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count("*").alias("length"))
        .drop("anchor")
    )


def streaks(events: DataFrame) -> DataFrame:
    """Current and longest streak; the current one must reach the last day of the data."""
    days = completed_days(events)
    today = last_day(days)
    current = F.when(F.col("last_day") == today, F.col("length")).otherwise(0)
    return runs(days).groupBy(*HABIT).agg(
        F.max(current).alias("current_streak"), F.max("length").alias("longest_streak")
    )


def streak_milestone(events: DataFrame, milestones: tuple[int, ...] = (7, GOAL_DAYS)) -> DataFrame:
    """Whether the longest streak reaches each milestone."""
    return streaks(events).select(
        *HABIT,
        "longest_streak",
        F.explode(F.array(*[F.lit(m) for m in milestones])).alias("milestone_days"),
    ).withColumn("reached", F.col("longest_streak") >= F.col("milestone_days"))


def completion_rate(events: DataFrame) -> DataFrame:
    """Share of done days between the first done day and the last day of the data."""
    days = completed_days(events)
    span = (F.datediff(last_day(days), F.col("first_day")) + 1).cast("bigint")
    done = days.groupBy(*HABIT).agg(F.count("*").alias("days_done"), F.min("day").alias("first_day"))
    return done.select(*HABIT, "days_done", span.alias("days_in_span"), (F.col("days_done") / span).alias("completion_rate"))


def weekly_completion(events: DataFrame) -> DataFrame:
    """Done days per week (Monday first) and their share of seven."""
    week = F.date_trunc("week", F.col("day")).cast("date")
    done = completed_days(events).groupBy(*HABIT, week.alias("week_start")).agg(F.count("*").alias("days_done"))
    return done.withColumn("weekly_rate", F.col("days_done") / 7)


def weekly_calendar(events: DataFrame) -> DataFrame:
    """Done days of every week from a habit's first one to the last week of the data; a week without any is a row of zero.

    Weeks are spread over the span of each habit, so the rows are bounded by the calendar, and meet the done ones by key.
    """
    def week(day: Column) -> Column:
        return F.date_trunc("week", day).cast("date")

    days = completed_days(events)
    done = days.groupBy(*HABIT, week(F.col("day")).alias("week_start")).agg(F.count("*").alias("days_done"))
    weeks = F.sequence(F.min("week_start"), week(last_day(days)), F.expr("INTERVAL 7 DAY"))
    every = done.groupBy(*HABIT).agg(weeks.alias("weeks")).select(*HABIT, F.explode("weeks").alias("week_start"))
    found = every.join(done, [*HABIT, "week_start"], "left").withColumn("days_done", F.coalesce("days_done", F.lit(0).cast("bigint")))
    return found.withColumn("weekly_rate", F.col("days_done") / 7)


def growth_percent(events: DataFrame, goal: int = GOAL_DAYS) -> DataFrame:
    """Progress towards the goal in percent, at most 100."""
    done = completed_days(events).groupBy(*HABIT).agg(F.count("*").alias("days_done"))
    return done.withColumn("growth_percent", F.least(F.lit(100.0), F.lit(100.0) * F.col("days_done") / goal))
