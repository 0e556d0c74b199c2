"""Marts over tables that arrive in deliveries: high-watermark import, and a mart kept up by signed changes.

The queries cut a source table into deliveries (early rows of some campaigns with stale clicks, later rows, then corrections and renamed
campaigns, and a replay), hand them over one by one, and return what the operator holds afterwards.
"""
from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..sources.catalog import Tables
from ..sources.increment import Import
from ..streaming.upkeep import MaintainedMart

_CUT = _dt.date(2024, 3, 31)
_MEASURES = ["impressions", "clicks", "spend"]


def _scratch(t: Tables, name: str) -> str:
    return f"{ensure_checkpoint_dir(t.spark).rstrip('/')}/{name}/{uuid.uuid4().hex}"


def _synced(rows: DataFrame, day: int) -> DataFrame:
    return rows.withColumn("_fivetran_synced", F.lit(_dt.datetime(2024, 5, day)).cast("timestamp_ntz"))


def _deliveries(t: Tables) -> list[DataFrame]:
    """Early rows, of which every third campaign's clicks are stale; later rows; and the corrections."""
    s = t["campaign_stats"].select("campaign_id", "date", *_MEASURES)
    early, stale = F.col("date") <= F.lit(_CUT), F.col("campaign_id") % 3 == 1
    first = s.where(early).withColumn("clicks", F.when(stale, F.col("clicks") - 1).otherwise(F.col("clicks")))
    return [_synced(first, 1), _synced(s.where(~early), 2), _synced(s.where(early & stale), 3)]


def q_imported_campaign_days(t: Tables) -> DataFrame:
    """The latest version of every campaign day, imported delivery by delivery from one growing folder."""
    landing = f"{_scratch(t, 'landing')}/campaign_stats"
    imported = Import(t.spark, _scratch(t, "imports"), ["campaign_id", "date"])
    for rows in _deliveries(t):
        rows.write.mode("append").parquet(landing)
        imported.pull(t.spark.read.parquet(landing))
    return imported.rows().select("campaign_id", "date", *_MEASURES)


def q_maintained_channel_days(t: Tables) -> DataFrame:
    """Daily sums by channel and campaign name, kept up over deliveries that correct rows and rename campaigns."""
    mart = MaintainedMart(t.spark, _scratch(t, "marts"), ["campaign_id", "date"], "campaign_id", ["date"], ["advertising_channel_type", "name"], _MEASURES)
    names = t["campaign_history"].select("campaign_id", "advertising_channel_type", "name", "_fivetran_synced")
    renamed = F.col("_fivetran_synced") >= F.lit(_dt.datetime(2024, 1, 3)).cast("timestamp_ntz")
    early, late, corrected = _deliveries(t)
    for batch, rows, dimension in [("1", early, names.where(~renamed)), ("2", late, None), ("1", early, names.where(~renamed)), ("3", corrected, names.where(renamed))]:
        mart.apply(batch, rows, dimension)
    return mart.mart()
