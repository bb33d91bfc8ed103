"""Outgoing messages of a lake: what to send, at most once per date and channel. Sending itself is not done here."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from leaguelake import schemas
from leaguelake.functions import localtime
from leaguelake.operators import delivery, merge, partitions
from leaguelake.plans.medallion import Lake
from leaguelake.session import held
from leaguelake.sources.documents import read_table

LEDGER_KEYS = ["sent_date", "channel"]


def reserve(spark: SparkSession, lake: Lake, candidates: DataFrame) -> DataFrame:
    """Dates and channels reserved by this call: those not in the ledger before, appended to it now.

    Two calls at the same time are not kept apart; run one sender per channel.
    """
    ledger = read_table(spark, lake.gold("ledger"))
    if ledger is None:
        ledger = merge.empty_table(spark, schemas.GOLD_LEDGER)
    won = held(merge.reserve_once(candidates, ledger, LEDGER_KEYS), "reserved")
    won.write.mode("append").parquet(lake.gold("ledger"))
    return won


def _unsent(spark: SparkSession, lake: Lake, messages: DataFrame, channel: str) -> DataFrame:
    dates = messages.select(F.col("local_date").alias("sent_date"), F.lit(channel).alias("channel"))
    won = reserve(spark, lake, dates)
    return messages.join(won.select(F.col("sent_date").alias("local_date")), "local_date", "left_semi")


def results_to_send(
    spark: SparkSession, lake: Lake, title: str, day: dt.date, zone: str = localtime.LOCAL_ZONE
) -> DataFrame:
    """The digest of the run's local date if it was not sent before; the date is reserved."""
    schedule, boxes = read_table(spark, lake.gold("schedule")), read_table(spark, lake.gold("boxscores"))
    digest = held(delivery.results_message(schedule, boxes, title, day, zone), "digest")
    return _unsent(spark, lake, digest, "results")


def polls_to_send(spark: SparkSession, lake: Lake, day: dt.date, zone: str = localtime.LOCAL_ZONE) -> DataFrame:
    """Polls of the run's local date if they were not sent before; the date is reserved."""
    polls = held(delivery.due_polls(read_table(spark, lake.gold("schedule")), zone, day), "polls")
    return _unsent(spark, lake, polls, "polls").orderBy("game_datetime_utc", "game_id")


def record_polls(spark: SparkSession, lake: Lake, patches: DataFrame) -> None:
    """Store (game_id, poll_message_id) on the schedule; a NULL id clears it. Ids of unknown games are left out."""
    known = patches.join(read_table(spark, lake.gold("schedule")).select("game_id"), "game_id", "left_semi")
    latest = known.groupBy("game_id").agg(F.max("poll_message_id").alias("poll_message_id"))
    partitions.merge(spark, lake.gold("schedule"), latest, "game_id", None, ["poll_message_id"])


def close_polls(spark: SparkSession, lake: Lake, now: dt.datetime) -> DataFrame:
    """Polls that are due at ``now``; their ids are cleared from the schedule."""
    due = held(
        delivery.polls_to_close(read_table(spark, lake.gold("schedule")), now).filter("is_due"), "closing"
    )
    record_polls(spark, lake, delivery.closed_poll_patch(due))
    return due
