"""Raw site texts → typed fields.

``render_fields`` prints timestamps and numbers the way the site shows
them (used to build round-trip inputs from the driver tables);
``normalise_fields`` parses such texts back.  Both are row-wise native
projections: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blogweave.functions import fields as FD


def render_fields(events: DataFrame) -> DataFrame:
    """``events`` → texts as a fetched page would hold them.

    The fetch time is 0, 1 or 2 days after the event, so the three date
    forms (today, yesterday, full date) all occur.
    """
    fetched = F.timestamp_add("DAY", F.col("event_id") % 3, F.col("ts"))
    votes = F.regexp_extract("props", r"(-?[0-9]+)", 1).cast("int") - 50
    return events.select(
        "event_id",
        fetched.alias("fetched_at"),
        FD.render_site_datetime(F.col("ts"), fetched).alias("time_text"),
        FD.render_number(votes).alias("votes_text"),
        FD.render_number(F.col("value")).alias("value_text"),
        F.when(F.col("event_id") % 2 == 0, FD.render_number(F.col("value")))
         .otherwise(F.concat(F.lit(FD.EN_DASH), FD.render_number(F.col("value")))).alias("karma_text"),
    )


def normalise_fields(raw: DataFrame) -> DataFrame:
    """Texts → ``TIMESTAMP_NTZ``, ``INT`` and ``DOUBLE``; bad values → null."""
    return raw.select(
        "event_id",
        FD.parse_site_datetime(F.col("time_text"), F.col("fetched_at")).alias("time"),
        FD.parse_int("votes_text").alias("votes"),
        FD.parse_number("value_text").alias("value"),
        FD.parse_karma("karma_text").alias("karma"),
    )
