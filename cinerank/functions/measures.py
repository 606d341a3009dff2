"""Column expressions for dates, scores and errors."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def year_month(seconds: Column, time_zone: str = "UTC") -> Column:
    """Epoch seconds -> yyyyMM as INT in ``time_zone``, whatever zone the session runs in."""
    if time_zone == "UTC":
        day = F.date_from_unix_date(F.floor(seconds / F.lit(86400)).cast("int"))
    else:
        moment = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
        day = F.convert_timezone(F.lit("UTC"), F.lit(time_zone), moment)
    return F.year(day) * 100 + F.month(day)


def preference_shift(score: Column, like_above: float = 3.0) -> Column:
    """Aggregate: log10 of the likes less log10 of the dislikes; counts below one count as one."""
    likes = F.count_if(score > like_above)
    dislikes = F.count_if(score <= like_above)
    return F.log10(F.greatest(likes, F.lit(1))) - F.log10(F.greatest(dislikes, F.lit(1)))


def rmse(observed: Column, predicted: Column) -> Column:
    """Aggregate: root mean squared error; null (not 0) when there is nothing to compare."""
    return F.sqrt(F.avg(F.pow(observed - predicted, F.lit(2))))


def inverse_document_frequency(documents: Column, containing: Column) -> Column:
    return F.log((documents + F.lit(1.0)) / (containing + F.lit(1.0)))
