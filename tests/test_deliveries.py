"""Stores, high-watermark import, a mart kept up by signed changes, slicer sets, default summaries; each fact read once."""
import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from marketlens.plans import report, slicers
from marketlens.sources.increment import Import
from marketlens.sources.roles import DriverTables
from marketlens.sources.store import CommitConflict, Store
from marketlens.streaming.upkeep import MaintainedMart

SF = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 1, 1)


def test_a_store_shows_whole_commits_only(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"))
    assert store.manifest() == (0, {}) and store.read([]) is None
    name = store.write(spark.range(3).toDF("a"), "rows")
    store.commit(0, {"rows": [name]})
    other = Store(spark, str(tmp_path / "s"))
    with pytest.raises(CommitConflict):
        other.commit(0, {"rows": []})
    # a manifest whose writer died is passed over, and its number is not used again
    (tmp_path / "s/manifests/2").write_text('{"rows": [')
    assert other.manifest() == (2, {"rows": [name]})
    other.commit(2, {"rows": [name, other.write(spark.range(2).toDF("a"), "rows")]})
    assert store.read(store.manifest()[1]["rows"]).count() == 5


SYNC = "k long, v long, _fivetran_synced timestamp_ntz"


def synced(spark, rows, day):
    return spark.createDataFrame([(k, v, T0 + dt.timedelta(days=day)) for k, v in rows], SYNC)


def test_import_reads_each_row_once_and_keeps_the_latest(spark, tmp_path):
    landing, imported = str(tmp_path / "landing"), Import(spark, str(tmp_path / "store"), ["k"])
    read = lambda: spark.read.schema(SYNC).parquet(landing)
    synced(spark, [(1, 10), (2, 20)], 1).write.parquet(landing)
    assert imported.rows() is None and imported.cursor() is None
    assert imported.pull(read()) == 2
    assert imported.pull(read()) == 0
    synced(spark, [(2, 21), (3, 30)], 2).write.mode("append").parquet(landing)
    assert imported.pull(read()) == 2 and imported.cursor().startswith("2024-01-03")
    want = {1: 10, 2: 21, 3: 30}
    assert {r.k: r.v for r in imported.rows().collect()} == want
    plan = read().where(F.col("_fivetran_synced") > F.lit(imported.cursor()).cast("timestamp_ntz"))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(_fivetran_synced), GreaterThan(_fivetran_synced" in plan
    imported.compact()
    synced(spark, [(1, 11)], 3).write.mode("append").parquet(landing)
    assert imported.pull(read()) == 1 and {r.k: r.v for r in imported.rows().collect()} == {**want, 1: 11}


def test_an_import_that_dies_is_repeated_whole(spark, tmp_path, monkeypatch):
    imported = Import(spark, str(tmp_path / "store"), ["k"])
    with monkeypatch.context() as m:
        m.setattr(Store, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            imported.pull(synced(spark, [(1, 1)], 1))
    assert imported.rows() is None and imported.pull(synced(spark, [(1, 1)], 1)) == 1


ROWS = "campaign_id long, date date, clicks long, spend decimal(18,2), _fivetran_synced timestamp_ntz"
DIM = "campaign_id long, name string, _fivetran_synced timestamp_ntz"


def rebuild(rows, names):
    latest, label = {}, {}
    for c, d, k, s, t in rows:
        if (c, d) not in latest or t > latest[c, d][2]:
            latest[c, d] = (k, s, t)
    for c, n, t in names:
        if c not in label or t > label[c][1]:
            label[c] = (n, t)
    out = {}
    for (c, d), (k, s, _) in latest.items():
        key = (d, label.get(c, (None,))[0])
        n, a, b = out.get(key, (0, 0, 0))
        out[key] = (n + 1, a + k, b + s)
    return out


def test_maintained_mart_equals_a_rebuild_after_mixed_deliveries(spark, tmp_path, monkeypatch):
    rnd, day0 = random.Random(4), dt.date(2024, 1, 1)
    open_mart = lambda: MaintainedMart(spark, str(tmp_path / "m"), ["campaign_id", "date"], "campaign_id", ["date"], ["name"], ["clicks", "spend"])
    mart, rows, names = open_mart(), [], []
    found = lambda m: {(r["date"], r["name"]): (r["row_count"], r["clicks"], r["spend"]) for r in m.mart().collect()}
    for batch in range(5):
        t = T0 + dt.timedelta(days=batch)
        new = {(rnd.randrange(6), day0 + dt.timedelta(days=rnd.randrange(4))) for _ in range(8)}
        stats = [(c, d, rnd.randrange(50), rnd.randrange(9), t) for c, d in sorted(new)] if batch != 3 else []
        dims = [(c, f"n{rnd.randrange(3)}", t) for c in rnd.sample(range(6), 3)] if batch != 1 else []
        late = [(0, day0, 999, 1, T0 - dt.timedelta(days=9))] if batch == 4 else []  # an older version that arrives late changes nothing
        late = [] if (0, day0) in new else late
        rows, names = rows + stats + late, names + dims
        s = spark.createDataFrame(stats + late, "campaign_id long, date date, clicks long, spend int, _fivetran_synced timestamp_ntz").withColumn("spend", F.col("spend").cast("decimal(18,2)"))
        d = spark.createDataFrame(dims, DIM) if dims else None
        if batch == 2:
            with monkeypatch.context() as m:
                m.setattr(Store, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
                with pytest.raises(RuntimeError):
                    mart.apply(str(batch), s, d)
            mart = open_mart()
        assert mart.apply(str(batch), s if stats or late else None, d)
        assert not mart.apply(str(batch), s, d)
        assert found(mart) == rebuild(rows, names), batch
    mart.compact()
    assert found(open_mart()) == rebuild(rows, names)
    kinds = json.loads((tmp_path / "m/manifests" / max(os.listdir(tmp_path / "m/manifests"), key=lambda n: (not n.startswith("."), int(n.strip(".crc") or 0) if n.isdigit() else -1))).read_text())
    assert {k: len(kinds[k]) for k in ("rows", "dimension", "deltas")} == {"rows": 1, "dimension": 1, "deltas": 1}
    again = [(1, day0, 7, 7, T0 + dt.timedelta(days=30))]
    mart.apply("9", spark.createDataFrame(again, "campaign_id long, date date, clicks long, spend int, _fivetran_synced timestamp_ntz").withColumn("spend", F.col("spend").cast("decimal(18,2)")))
    assert found(mart) == rebuild(rows + again, names)


def test_every_slicer_set_slices_its_view(spark):
    t = DriverTables(spark, SF)
    with pytest.raises(ValueError, match="no slicer colour"):
        slicers.sliced_rows(t, "ads", {"colour": 1})
    for name, values, check in [
            ("drill_down", {"campaign": 7, "date": (dt.date(2024, 2, 1), dt.date(2024, 2, 9))}, lambda r: r.campaign_id == 7 and r.date.month == 2 and r.date.day < 10),
            ("ads", {"campaign": [7, 10]}, lambda r: r.campaign_id in (7, 10))]:
        got = slicers.sliced_rows(t, name, values).collect()
        assert got and all(map(check, got))
    plan = slicers.sliced_rows(t, "executive", {"account": 0}, None)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") > plan.index("Aggregate")  # below the daily aggregation, on its input
    for name, chosen in slicers.SLICER_SETS.items():
        columns = chosen.rows(t).columns
        assert set(chosen.slicers.values()) | set(chosen.sums) <= set(columns), name


def test_default_summaries_name_columns_of_their_tables(spark):
    from marketlens.plans import crm, email, engagements
    t, at = DriverTables(spark, SF), dt.date(2024, 1, 31)
    plans = {"CompanyPerformance": crm.company_performance(t, at), "ContactLifecycleFunnel": crm.contact_lifecycle_funnel(t, at), "ContactPerformance": crm.contact_performance(t, at),
             "DealForecast": crm.deal_forecast(t, at), "DealOwnerPerformance": crm.deal_owner_performance(t, at), "DealPerformance": crm.deal_performance(t, at),
             "DealPipelineSummary": crm.deal_pipeline_summary(t, at), "EmailPerformance": email.email_performance(t),
             "EngagementDailySummary": engagements.engagement_daily_summary(t), "EngagementOwnerSummary": engagements.engagement_owner_summary(t, at)}
    assert set(plans) == set(report.DEFAULT_SUMMARY)
    for name, rules in report.DEFAULT_SUMMARY.items():
        assert set(rules) <= set(plans[name].columns), name


def final_plan(df):
    """The lines of the executed adaptive plans of ``df`` and its subqueries, without the plans they started from."""
    out, skipped = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        column = len(line) - len(line.lstrip(" :+-|"))
        if skipped is not None and column >= skipped:
            continue
        skipped = column if "== Initial Plan ==" in line else None
        if skipped is None:
            out.append(line)
    return out


@pytest.mark.parametrize("key,fact", [("ad_strength_analysis", "l_extendedprice"), ("fb_placement_summary", "l_extendedprice"), ("q_campaign_matrix", "l_extendedprice"),
                                      ("keyword_top_performers", "l_extendedprice"), ("p_global_ranks", "o_totalprice")])
def test_each_fact_is_scanned_once(spark, key, fact):
    """Totals and ranks share the rows' exchange: the final plan, subqueries included, scans the fact once."""
    import __spark_entry__ as E
    df = E.queries()[key](spark, SF)
    df.collect()
    assert len([line for line in final_plan(df) if "FileScan" in line and fact in line]) == 1
