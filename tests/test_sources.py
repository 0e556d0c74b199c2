"""Source layer: optional columns, date-bounded import, two-step distinct counts."""
import datetime as dt
import os
import random
import tempfile

from pyspark.sql import functions as F

from marketlens.plans.email import email_performance, email_recipient_engagement
from marketlens.sources.catalog import Tables, read_tables, recent
from marketlens.sources.roles import DriverTables
from marketlens.sources.schemas import SCHEMAS

SF = "/root/testdata/sf0.001"


def test_optional_breakdown_columns_added_as_null(spark):
    root = tempfile.mkdtemp(prefix="optional-")
    base = DriverTables(spark, SF)["fb_basic_ad"].drop("age", "gender", "publisher_platform", "platform_position",
                                                       "impression_device", "device_platform")
    base.write.parquet(os.path.join(root, "fb_basic_ad"))
    t = read_tables(spark, root)
    df = t["fb_basic_ad"]
    assert df.columns == [f.name for f in SCHEMAS["fb_basic_ad"].fields]
    assert df.filter(F.col("age").isNotNull() | F.col("publisher_platform").isNotNull()).count() == 0
    assert df.count() == base.count()


def test_recent_keeps_only_the_window(spark):
    df = spark.createDataFrame([(dt.date(2024, 4, 30) - dt.timedelta(days=i),) for i in range(60)], "date date")
    got = recent(df, "date", 30, dt.date(2024, 4, 30))
    assert got.count() == 31 and got.agg(F.min("date")).first()[0] == dt.date(2024, 3, 31)


def test_two_step_distinct_counts_equal_direct(spark):
    rnd = random.Random(5)
    types = ["SENT", "DELIVERED", "OPEN", "CLICK", "BOUNCE", "UNSUBSCRIBED"]
    rows = []
    for i in range(4000):
        camp = 1 if rnd.random() < 0.4 else rnd.randint(2, 6)          # campaign 1 is hot
        rows.append((str(i), camp, rnd.choice([None] + [f"r{j}" for j in range(40)]), rnd.choice(types),
                     dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), rnd.choice(["MOBILE", "DESKTOP", "TABLET"])))
    ev = spark.createDataFrame(rows, "event_id string, email_campaign_id long, recipient string, type string, "
                                     "created_at timestamp_ntz, device_type string")
    camps = spark.createDataFrame([(c, f"c{c}", False) for c in range(1, 7)],
                                  "campaign_id long, name string, _fivetran_deleted boolean")
    full_ev = ev.select(*[F.col(f.name) if f.name in ev.columns else F.lit(None).cast(f.dataType).alias(f.name)
                          for f in SCHEMAS["email_event"].fields])
    full_c = camps.select(*[F.col(f.name) if f.name in camps.columns else F.lit(None).cast(f.dataType).alias(f.name)
                            for f in SCHEMAS["email_campaign"].fields])
    t = Tables(spark, frames={"email_event": full_ev, "email_campaign": full_c})
    got = {r.campaign_id: (r.unique_opens, r.unique_recipients, r.total_opens, r.mobile_opens)
           for r in email_performance(t).collect()}
    want = {r.c: (r.uo, r.ur, r.o, r.mo) for r in ev.groupBy(F.col("email_campaign_id").alias("c")).agg(
        F.count_distinct(F.when(F.col("type") == "OPEN", F.col("recipient"))).alias("uo"),
        F.count_distinct(F.when(F.col("type") == "SENT", F.col("recipient"))).alias("ur"),
        F.count(F.when(F.col("type") == "OPEN", 1)).alias("o"),
        F.count(F.when((F.col("type") == "OPEN") & (F.col("device_type") == "MOBILE"), 1)).alias("mo")).collect()}
    assert got == want
    rec = {r.email_address: r.campaigns_opened for r in email_recipient_engagement(t).collect()}
    direct = {r.recipient: r.n for r in ev.filter(F.col("recipient").isNotNull()).groupBy("recipient").agg(
        F.count_distinct(F.when(F.col("type") == "OPEN", F.col("email_campaign_id"))).alias("n")).collect()}
    assert rec == direct


def test_jdbc_tables_are_lazy(spark):
    """Building the table map opens no connection; unknown logical names are ignored."""
    from marketlens.sources.catalog import read_jdbc_tables
    t = read_jdbc_tables(spark, "jdbc:unreachable://nowhere", {"user": "x"},
                         {"campaign_stats": "ads.campaign_stats", "not_a_table": "x.y"},
                         partitioning={"campaign_stats": ("campaign_id", 0, 1000, 8)})
    assert t.has("campaign_stats") and not t.has("not_a_table")


def test_missing_required_column_is_an_error(spark):
    import pytest
    root = tempfile.mkdtemp(prefix="required-")
    DriverTables(spark, SF)["campaign_stats"].drop("spend").write.parquet(os.path.join(root, "campaign_stats"))
    with pytest.raises(ValueError, match="campaign_stats: required columns are missing: spend"):
        read_tables(spark, root)["campaign_stats"]


def test_every_declared_table_has_a_schema():
    assert len(SCHEMAS) == 40


def test_slicers_filter_sources_and_results(spark):
    import pytest
    from marketlens.sources.catalog import Sliced, slice_rows
    base = DriverTables(spark, SF)
    days = [r[0] for r in base["campaign_stats"].select("date").distinct().orderBy("date").collect()]
    sliced = Sliced(base, {"date": (days[3], days[5]), "campaign_id": [r[0] for r in base["campaign_stats"].select("campaign_id").distinct().limit(2).collect()]})
    assert {r[0] for r in sliced["campaign_stats"].select("date").distinct().collect()} <= set(days[3:6])
    assert sliced["owner"].count() == base["owner"].count()  # has neither column
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "x int, y string")
    assert slice_rows(df, {"x": (2, None)}).count() == 2 and slice_rows(df, {"y": "a"}).count() == 1
    with pytest.raises(Exception):
        slice_rows(df, {"z": 1}).count()
