"""Mart-level edge rows (FIXTURES section 3) on hand-built tables."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from marketlens.plans import crm
from marketlens.sources.catalog import Tables
from marketlens.sources.schemas import SCHEMAS

AS_OF = dt.date(2024, 1, 31)
SYNC = dt.datetime(2024, 2, 1)


def table(spark, name, rows):
    schema = SCHEMAS[name]
    cols = list(rows[0].keys()) if rows else []
    full = [{f.name: r.get(f.name) for f in schema.fields} for r in rows]
    return spark.createDataFrame(full, schema) if rows else spark.createDataFrame([], schema)


def deal_tables(spark, deals):
    empty = {n: table(spark, n, []) for n in ["deal_pipeline", "deal_stage", "owner", "company", "contact",
                                              "engagement", "engagement_deal"]}
    return Tables(spark, frames={"deal": table(spark, "deal", deals), **empty})


def _deal(i, **kw):
    base = dict(deal_id=i, deal_name=f"d{i}", amount=Decimal("100.00"), create_date=dt.datetime(2023, 12, 1),
                _fivetran_deleted=False, _fivetran_synced=SYNC)
    base.update(kw)
    return base


def test_null_flag_deal_is_open_but_not_counted_open(spark):
    t = deal_tables(spark, [_deal(1, is_closed=None, is_closed_won=None, owner_id=1),
                            _deal(2, is_closed=False, is_closed_won=False, owner_id=1)])
    perf = {r.deal_id: r.deal_status for r in crm.deal_performance(t, AS_OF).collect()}
    assert perf == {1: "Open", 2: "Open"}
    owner = crm.deal_owner_performance(t, AS_OF).first()
    assert owner.open_deals == 1 and owner.total_deals == 2   # strict = 0 excludes the NULL flag


def test_close_date_buckets(spark):
    offsets = {1: 0, 2: 7, 3: 8, 4: 30, 5: 31, 6: 90, 7: 91, 8: -1, 9: None}
    deals = [_deal(i, is_closed=False, is_closed_won=False,
                   close_date=None if o is None else AS_OF + dt.timedelta(days=o)) for i, o in offsets.items()]
    out = {r.deal_id: r.close_date_status for r in crm.deal_performance(deal_tables(spark, deals), AS_OF).collect()}
    assert out == {1: "Closing This Week", 2: "Closing This Week", 3: "Closing This Month", 4: "Closing This Month",
                   5: "Closing This Quarter", 6: "Closing This Quarter", 7: "Future", 8: "Overdue", 9: "No Close Date"}


def test_forecast_periods(spark):
    days = {1: dt.date(2024, 1, 31), 2: dt.date(2024, 2, 1), 3: dt.date(2024, 3, 15), 4: dt.date(2024, 4, 1),
            5: dt.date(2024, 7, 1), 6: dt.date(2023, 12, 31)}
    df = spark.createDataFrame([(k, v) for k, v in days.items()], "id int, d date")
    out = {r.id: r.p for r in df.select("id", crm.forecast_period(F.col("d"), AS_OF).alias("p")).collect()}
    assert out == {1: "This Month", 2: "Next Month", 3: "This Quarter", 4: "Next Quarter", 5: "Future", 6: "Future"}


def test_empty_input_grouped_empty_totals_one_row(spark):
    t = deal_tables(spark, [])
    assert crm.deal_owner_performance(t, AS_OF).count() == 0
    from marketlens.plans.measures import m_deal_measures
    row = m_deal_measures(t, AS_OF).first()
    assert row.total_deals == 0 and row.deal_win_rate == 0.0
