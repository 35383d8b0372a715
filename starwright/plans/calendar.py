"""B-DATE: the day calendar (time spine) with ISO and Portuguese labels.

The span runs from 1 January of the earliest order/due/ship date to the later
of 31 December of the latest such date and 31 December of ``as_of`` +
``future_years``.  ``as_of`` replaces the warehouse's ``current_date`` so a run
is reproducible.  The limits are one global aggregate (partial per task, one
row out); the spine is generated with ``explode(sequence(...))`` and its size
is bounded by the calendar span, not by the data.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starwright.functions.columns import (
    date_key, iso_weekday, month_name, weekday_name,
)

DEFAULT_FUTURE_YEARS = 2


def source_dates(*frames_and_columns: tuple[DataFrame, str]) -> DataFrame:
    """``UNION ALL`` of date columns as one ``date_value`` column."""
    parts = [df.select(F.col(c).cast("date").alias("date_value")) for df, c in frames_and_columns]
    return reduce(DataFrame.unionAll, parts)


def calendar_limits(dates: DataFrame, as_of: dt.date, future_years: int = DEFAULT_FUTURE_YEARS
                    ) -> DataFrame:
    limits = dates.where(F.col("date_value").isNotNull()).agg(
        F.min("date_value").alias("min_date"), F.max("date_value").alias("max_date")
    )
    horizon_year = as_of.year + future_years
    return limits.select(
        F.trunc("min_date", "year").alias("start_date"),
        F.greatest(
            F.make_date(F.lit(horizon_year), F.lit(12), F.lit(31)),
            F.make_date(F.year("max_date"), F.lit(12), F.lit(31)),
        ).alias("end_date"),
    )


def calendar_columns(full_date: Column) -> list[Column]:
    d = full_date
    dow = iso_weekday(d)
    week = F.weekofyear(d)
    iso_year = F.expr("extract(YEAROFWEEK FROM full_date)").cast("int")
    return [
        date_key(d).alias("date_id"),
        d.alias("full_date"),
        F.year(d).alias("year_number"),
        F.when(F.month(d) <= 6, 1).otherwise(2).alias("semester_number"),
        F.quarter(d).alias("quarter_number"),
        F.concat(F.year(d).cast("string"), F.lit("-Q"), F.quarter(d).cast("string"))
        .alias("year_quarter"),
        F.month(d).alias("month_number"),
        month_name(F.month(d)).alias("month_name"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        week.alias("iso_week_number"),
        iso_year.alias("iso_week_year"),
        F.concat(iso_year.cast("string"), F.lit("-W"), F.lpad(week.cast("string"), 2, "0"))
        .alias("year_iso_week"),
        F.dayofmonth(d).alias("day_of_month"),
        dow.alias("day_of_week_number"),
        weekday_name(dow).alias("day_of_week_name"),
        dow.isin(6, 7).alias("is_weekend"),
    ]


def dim_date(dates: DataFrame, as_of: dt.date, future_years: int = DEFAULT_FUTURE_YEARS
             ) -> DataFrame:
    limits = calendar_limits(dates, as_of, future_years)
    spine = limits.select(
        F.explode(F.sequence("start_date", "end_date", F.expr("INTERVAL 1 DAY")))
        .alias("full_date")
    )
    return spine.select(*calendar_columns(F.col("full_date")))
