"""CRM engagement marts.

The source SQL joins all three association bridges (contacts, companies, deals) to the
engagement rows before aggregating, so non-distinct SUM/AVG/COUNT see every engagement
repeated ``max(#contacts,1) x max(#companies,1) x max(#deals,1)`` times.  That result is
reproduced exactly without materialising the cartesian product: per-engagement bridge counts
are pre-aggregated (map-side combined), the multiplier is attached with one join on
engagement_id, and weighted sums / weighted averages replace the fanned-out aggregates.
Distinct counts over bridge members are computed separately on (group, member) pairs.
``*_dedup`` variants aggregate each engagement once.
"""
from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import date_key, dec, ratio, share_pct
from ..functions.dates import days_between, minutes_between_boundary, sunday_week_of_year
from ..operators.shares import with_group_aggs
from ..sources.catalog import Tables
from .crm import live, since, with_owner

BRIDGES = {"contact": ("engagement_contact", "contact_id"), "company": ("engagement_company", "company_id"),
           "deal": ("engagement_deal", "deal_id")}


def _tagged_bridges(t: Tables, which: Sequence[str]) -> DataFrame:
    """All requested bridges stacked as (engagement_id, _member, _w)."""
    parts = [t[BRIDGES[w][0]].select("engagement_id", F.col(BRIDGES[w][1]).cast("long").alias("_member"),
                                     F.lit(w).alias("_w")) for w in which]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def association_counts(t: Tables, which: Sequence[str] = ("contact", "company", "deal")) -> DataFrame:
    """engagement_id -> n_contact / n_company / n_deal: the bridges are stacked and counted in one
    aggregation (one shuffle, map-side combined) instead of one aggregation per bridge plus
    outer joins."""
    u = _tagged_bridges(t, which)
    return u.groupBy("engagement_id").agg(*[F.count(F.when(F.col("_w") == w, 1)).alias(f"n_{w}") for w in which])


def with_fanout(e: DataFrame, t: Tables, which: Sequence[str]) -> DataFrame:
    """Attach bridge counts and ``_m`` = product of max(count, 1) (rows the SQL join produces)."""
    e = e.join(association_counts(t, which), "engagement_id", "left")
    m = F.lit(1).cast("long")
    for w in which:
        e = e.withColumn(f"n_{w}", F.coalesce(F.col(f"n_{w}"), F.lit(0).cast("long")))
        m = m * F.greatest(F.col(f"n_{w}"), F.lit(1).cast("long"))
    return e.withColumn("_m", m)


def merge_by_keys(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Combine per-group results that each hold at most one row per group: stack them and take
    the single non-null value per column.  One aggregation replaces a chain of joins, and NULL
    group keys need no null-safe join (GROUP BY treats NULL as a group)."""
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f, allowMissingColumns=True)
    cols = [c for c in u.columns if c not in keys]
    return u.groupBy(*keys).agg(*[F.max(c).alias(c) for c in cols])


def distinct_members(e: DataFrame, t: Tables, keys: Sequence[str], which: Sequence[str], names: dict) -> DataFrame:
    """COUNT(DISTINCT bridge member) per group for several bridges in one pass: stacked bridge
    rows are joined to the group keys once, deduplicated to (group, bridge, member) and counted."""
    pairs = _tagged_bridges(t, which).join(e.select("engagement_id", *keys), "engagement_id")
    d = pairs.select(*keys, "_w", "_member").distinct()
    return d.groupBy(*keys).agg(*[F.count(F.when(F.col("_w") == w, 1)).alias(names[w]) for w in which])


def _details(e: DataFrame, t: Tables, which: Sequence[str]) -> DataFrame:
    """LEFT JOIN subtype details with the type guard in the join condition."""
    specs = {
        "CALL": ("engagement_call", {"disposition": "call_disposition", "duration_milliseconds": "_dur",
                                     "status": "call_status", "from_number": "call_from_number",
                                     "to_number": "call_to_number", "recording_url": "_rec"}),
        "MEETING": ("engagement_meeting", {"title": "meeting_title", "start_time": "meeting_start_time",
                                           "end_time": "meeting_end_time", "meeting_outcome": "meeting_outcome"}),
        "EMAIL": ("engagement_email", {"subject": "email_subject", "from_email": "from_email",
                                       "sender_email": "sender_email"}),
        "TASK": ("engagement_task", {"subject": "task_subject", "status": "task_status", "task_type": "task_type",
                                     "priority": "task_priority", "completion_date": "task_completion_date"}),
    }
    for typ in which:
        table, cols = specs[typ]
        d = t[table].select(F.col("engagement_id").alias(f"_{typ}_id"), *[F.col(k).alias(v) for k, v in cols.items()])
        e = e.join(d, (e["engagement_id"] == d[f"_{typ}_id"]) & (e["type"] == typ), "left").drop(f"_{typ}_id")
    return e


def _minutes(col: Column) -> Column:
    """``ms / 60000.0`` (exact decimal, as the SQL divides by a decimal literal)."""
    return col / dec("60000.0")


def engagement_performance(t: Tables) -> DataFrame:
    e = live(t, "engagement")
    e = with_owner(e, t)
    e = _details(e, t, ["CALL", "MEETING", "EMAIL", "TASK"])
    e = with_fanout(e, t, ["contact", "company", "deal"])
    ts = F.col("timestamp")
    dur = F.coalesce(F.col("_dur"), F.lit(0).cast("long"))
    start, end = F.col("meeting_start_time"), F.col("meeting_end_time")
    return e.select(
        "engagement_id", F.col("type").alias("engagement_type"), "created_at", "last_updated",
        ts.alias("engagement_timestamp"), F.to_date(ts).alias("engagement_date"),
        date_key(ts).alias("engagement_date_id"), F.hour(ts).alias("hour_of_day"),
        F.date_format(ts, "EEEE").alias("day_of_week"), F.dayofweek(ts).alias("day_of_week_num"),
        sunday_week_of_year(ts).alias("week_of_year"), F.month(ts).alias("month_number"), F.year(ts).alias("year_number"),
        "owner_id", "owner_name", "owner_email", F.coalesce("active", F.lit(True)).alias("is_active"),
        "call_disposition", dur.alias("call_duration_ms"),
        ratio(dur, F.lit(1000), None, (10, 2), guard=F.lit(True)).alias("call_duration_seconds"),
        ratio(dur, F.lit(60000), None, (10, 2), guard=F.lit(True)).alias("call_duration_minutes"),
        "call_status", "call_from_number", "call_to_number",
        F.when(F.col("_rec").isNotNull(), F.lit(1)).otherwise(F.lit(0)).alias("has_recording"),
        "meeting_title", "meeting_start_time", "meeting_end_time",
        F.when(start.isNotNull() & end.isNotNull(), minutes_between_boundary(start, end)).alias("meeting_duration_minutes"),
        "meeting_outcome", "email_subject", "from_email", "sender_email", "task_subject", "task_status", "task_type",
        "task_priority", "task_completion_date",
        F.when(F.col("task_status") == "COMPLETED", F.lit(1)).otherwise(F.lit(0)).alias("is_task_completed"),
        F.col("n_contact").alias("associated_contact_count"), F.col("n_company").alias("associated_company_count"),
        F.col("n_deal").alias("associated_deal_count"), F.col("_fivetran_synced").alias("last_synced_at"))


def _type_counts(prefix: str = "total_") -> list:
    names = {"CALL": "calls", "MEETING": "meetings", "EMAIL": "emails", "NOTE": "notes", "TASK": "tasks"}
    return [F.count(F.when(F.col("type") == k, 1)).alias(f"{prefix}{v}") for k, v in names.items()]


def _call_minute_aggs(weighted: bool) -> list:
    """Fan-out-faithful call minutes: SUM and AVG over the cartesian rows, as weighted aggregates."""
    m = F.col("_m") if weighted else F.lit(1).cast("long")
    call = F.col("type") == "CALL"
    dur = F.coalesce(F.col("_dur"), F.lit(0).cast("long"))
    connected = call & (F.col("_dur") > 0)
    x = ratio(F.col("_dur"), F.lit(60000), None, (10, 2), guard=F.lit(True))
    return [F.sum(F.when(call, dur * m).otherwise(F.lit(0).cast("long"))).alias("_call_ms"),
            F.sum(F.when(connected, x * m)).alias("_x_sum"), F.sum(F.when(connected, m)).alias("_x_n")]


def _call_minute_cols() -> list:
    return [_minutes(F.col("_call_ms")).alias("total_call_minutes"),
            ratio("_x_sum", "_x_n", None, (14, 6), default=None).alias("avg_call_minutes")]


def _engagement_daily(t: Tables, weighted: bool) -> DataFrame:
    base = live(t, "engagement").filter(F.col("timestamp").isNotNull()) \
        .withColumn("engagement_date", F.to_date("timestamp"))
    e = _details(base, t, ["CALL", "MEETING", "TASK"])
    if weighted:
        e = with_fanout(e, t, ["contact", "company", "deal"])
    ty, oc, ts_ = F.col("type"), F.col("meeting_outcome"), F.col("task_status")
    g = e.groupBy("engagement_date").agg(
        F.count(F.lit(1)).alias("total_engagements"), *_type_counts(),
        F.count_distinct("owner_id").alias("active_owners"), *_call_minute_aggs(weighted),
        *[F.count(F.when((ty == "MEETING") & (oc == o), 1)).alias(n) for o, n in
          [("SCHEDULED", "meetings_scheduled"), ("COMPLETED", "meetings_completed"),
           ("CANCELED", "meetings_canceled"), ("NO_SHOW", "meetings_no_show")]],
        F.count(F.when((ty == "TASK") & (ts_ == "COMPLETED"), 1)).alias("tasks_completed"),
        F.count(F.when((ty == "TASK") & ts_.isin("NOT_STARTED", "IN_PROGRESS"), 1)).alias("tasks_pending"))
    # distinct members need only the group key of each engagement, not the detail joins
    members = distinct_members(base, t, ["engagement_date"], ["contact", "company", "deal"],
                               {"contact": "unique_contacts_engaged", "company": "unique_companies_engaged",
                                "deal": "unique_deals_engaged"})
    g = merge_by_keys([g, members], ["engagement_date"])
    d = F.col("engagement_date")
    return g.select(
        "engagement_date", date_key(d).alias("date_id"), F.date_format(d, "EEEE").alias("day_of_week"),
        F.dayofweek(d).alias("day_of_week_num"), "total_engagements", "total_calls", "total_meetings",
        "total_emails", "total_notes", "total_tasks", "active_owners", *_call_minute_cols(),
        "meetings_scheduled", "meetings_completed", "meetings_canceled", "meetings_no_show", "tasks_completed",
        "tasks_pending", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in
                           ["unique_contacts_engaged", "unique_companies_engaged", "unique_deals_engaged"]])


def engagement_daily_summary(t: Tables) -> DataFrame:
    """Per day; call minutes follow the source's bridge fan-out (see module docstring)."""
    return _engagement_daily(t, weighted=True)


def engagement_daily_summary_dedup(t: Tables) -> DataFrame:
    """Per day with every engagement counted once in the call-minute aggregates."""
    return _engagement_daily(t, weighted=False)


def _engagement_owner(t: Tables, as_of, weighted: bool) -> DataFrame:
    base = live(t, "engagement").filter(F.col("owner_id").isNotNull())
    e = _details(base, t, ["CALL", "MEETING", "TASK"])
    if weighted:
        e = with_fanout(e, t, ["contact", "company", "deal"])
    ty = F.col("type")
    s7, s30 = since("timestamp", as_of, 7), since("timestamp", as_of, 30)
    meet_done = (ty == "MEETING") & (F.col("meeting_outcome") == "COMPLETED")
    task_done = (ty == "TASK") & (F.col("task_status") == "COMPLETED")
    g = e.groupBy("owner_id").agg(
        F.count(F.lit(1)).alias("total_engagements"), *_type_counts(),
        F.count(F.when(s7, 1)).alias("engagements_7d"), F.count(F.when((ty == "CALL") & s7, 1)).alias("calls_7d"),
        F.count(F.when((ty == "MEETING") & s7, 1)).alias("meetings_7d"),
        F.count(F.when(s30, 1)).alias("engagements_30d"), F.count(F.when((ty == "CALL") & s30, 1)).alias("calls_30d"),
        F.count(F.when((ty == "MEETING") & s30, 1)).alias("meetings_30d"),
        F.count(F.when((ty == "EMAIL") & s30, 1)).alias("emails_30d"),
        *_call_minute_aggs(weighted),
        F.count(F.when(meet_done, 1)).alias("completed_meetings"), F.count(F.when(task_done, 1)).alias("completed_tasks"),
        F.min("timestamp").alias("first_engagement_date"), F.max("timestamp").alias("last_engagement_date"))
    members = distinct_members(base, t, ["owner_id"], ["contact", "company", "deal"],
                               {"contact": "unique_contacts_engaged", "company": "unique_companies_engaged",
                                "deal": "unique_deals_engaged"})
    g = merge_by_keys([g, members], ["owner_id"])
    g = with_owner(g, t)
    span = days_between("first_engagement_date", "last_engagement_date")
    tot = F.col("total_engagements")
    return g.select(
        "owner_id", "owner_name", "owner_email", "total_engagements", "total_calls", "total_meetings", "total_emails",
        "total_notes", "total_tasks", "engagements_7d", "calls_7d", "meetings_7d", "engagements_30d", "calls_30d",
        "meetings_30d", "emails_30d", *_call_minute_cols(), "completed_meetings",
        ratio("completed_meetings", "total_meetings", "100.0", (10, 2)).alias("meeting_completion_rate"),
        "completed_tasks", ratio("completed_tasks", "total_tasks", "100.0", (10, 2)).alias("task_completion_rate"),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in
          ["unique_contacts_engaged", "unique_companies_engaged", "unique_deals_engaged"]],
        "first_engagement_date", "last_engagement_date", (span + 1).alias("days_active"),
        F.when(span > 0, ratio(tot, span + 1, "7.0", (10, 2), guard=F.lit(True))).otherwise(tot)
        .cast("decimal(10,2)").alias("engagements_per_week"))


def engagement_owner_summary(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Per owner; call minutes follow the source's bridge fan-out."""
    return _engagement_owner(t, as_of, weighted=True)


def engagement_owner_summary_dedup(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Per owner with every engagement counted once in the call-minute aggregates."""
    return _engagement_owner(t, as_of, weighted=False)


def _engagement_type(t: Tables, as_of, weighted: bool) -> DataFrame:
    base = live(t, "engagement")
    e = with_fanout(base, t, ["contact", "company", "deal"])
    m = F.col("_m")
    if weighted:
        # COUNT(bridge member) over the cartesian rows = n_member x product of the other max(n, 1)
        rows_c = F.col("n_contact") * F.greatest("n_company", F.lit(1)) * F.greatest("n_deal", F.lit(1))
        rows_co = F.col("n_company") * F.greatest("n_contact", F.lit(1)) * F.greatest("n_deal", F.lit(1))
    else:
        rows_c, rows_co = F.col("n_contact"), F.col("n_company")
    g = e.groupBy("type").agg(
        F.count(F.lit(1)).alias("total_count"), F.count_distinct("owner_id").alias("unique_owners"),
        F.count(F.when(since("timestamp", as_of, 7), 1)).alias("count_7d"),
        F.count(F.when(since("timestamp", as_of, 30), 1)).alias("count_30d"),
        F.count(F.when(since("timestamp", as_of, 90), 1)).alias("count_90d"),
        F.sum(rows_c).alias("_contact_rows"), F.sum(rows_co).alias("_company_rows"),
        F.min("timestamp").alias("first_occurrence"), F.max("timestamp").alias("last_occurrence"),
        F.sum(m).alias("_rows"))
    members = distinct_members(base, t, ["type"], ["contact", "company", "deal"],
                               {"contact": "unique_contacts", "company": "unique_companies", "deal": "unique_deals"})
    g = merge_by_keys([g, members], ["type"])
    g = with_group_aggs(g, [], {"_all": F.sum("total_count")})
    n = F.col("total_count")
    return g.select(
        F.col("type").alias("engagement_type"), "total_count", "unique_owners",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ["unique_contacts", "unique_companies", "unique_deals"]],
        "count_7d", "count_30d", "count_90d",
        ratio("_contact_rows", n, "1.0", (10, 2), default=None, guard=n != 0).alias("avg_contacts_per_engagement"),
        ratio("_company_rows", n, "1.0", (10, 2), default=None, guard=n != 0).alias("avg_companies_per_engagement"),
        share_pct("total_count", "_all").alias("pct_of_total"), "first_occurrence", "last_occurrence")


def engagement_type_analysis(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Per type; associations per engagement follow the source's fan-out (rows of the joins)."""
    return _engagement_type(t, as_of, weighted=True)


def engagement_type_analysis_dedup(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Per type with the plain number of associated contacts / companies per engagement."""
    return _engagement_type(t, as_of, weighted=False)


def _call_analysis(t: Tables, as_of, weighted: bool) -> DataFrame:
    """Calls by owner x disposition x status (raw values grouped, NULL shown as 'Unknown')."""
    e = live(t, "engagement").filter(F.col("type") == "CALL")
    c = t["engagement_call"].select("engagement_id", F.col("disposition").alias("_disp"), F.col("status").alias("_st"),
                                    F.col("duration_milliseconds").alias("_dur"), F.col("recording_url").alias("_rec"))
    base = e.join(c, "engagement_id", "inner")
    e = with_fanout(base, t, ["contact", "company"])
    if not weighted:
        e = e.withColumn("_m", F.lit(1).cast("long"))
    m, dur = F.col("_m"), F.col("_dur")
    mins = _minutes(dur)
    keys = ["owner_id", "_disp", "_st"]
    g = e.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_calls"),
        F.sum(F.coalesce(dur, F.lit(0).cast("long")) * m).alias("_ms"),
        # decimal(28,7) x long would exceed 38 digits and drop to scale 6: narrow both factors
        F.sum(F.when(dur > 0, mins.cast("decimal(20,7)") * m.cast("decimal(10,0)"))).alias("_x_sum"),
        F.sum(F.when(dur > 0, m)).alias("_x_n"),
        F.min(F.when(dur > 0, mins)).alias("min_minutes"), F.max(mins).alias("max_minutes"),
        F.count(F.when(dur > 0, 1)).alias("_connected"), F.count(F.when(F.col("_rec").isNotNull(), 1)).alias("calls_with_recording"),
        F.count(F.when(since("timestamp", as_of, 7), 1)).alias("calls_7d"),
        F.count(F.when(since("timestamp", as_of, 30), 1)).alias("calls_30d"))
    members = distinct_members(base, t, keys, ["contact", "company"],
                               {"contact": "unique_contacts_called", "company": "unique_companies_called"})
    g = merge_by_keys([g, members], keys)
    g = with_owner(g, t, cols=("owner_name",))
    return g.select(
        "owner_id", "owner_name", F.coalesce("_disp", F.lit("Unknown")).alias("call_disposition"),
        F.coalesce("_st", F.lit("Unknown")).alias("call_status"), "total_calls",
        _minutes(F.col("_ms")).alias("total_minutes"),
        ratio(F.col("_x_sum").cast("decimal(30,7)"), F.col("_x_n").cast("decimal(18,0)"), None, (32, 11), default=None,
              operand=None).alias("avg_minutes"), "min_minutes", "max_minutes",
        ratio("_connected", "total_calls", "100.0", (10, 2)).alias("connected_call_rate"), "calls_with_recording",
        "calls_7d", "calls_30d",
        *[F.coalesce(c_, F.lit(0).cast("long")).alias(c_) for c_ in ["unique_contacts_called", "unique_companies_called"]])


def call_analysis(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Call minutes follow the source's contact x company fan-out."""
    return _call_analysis(t, as_of, weighted=True)


def call_analysis_dedup(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Call minutes with each call counted once."""
    return _call_analysis(t, as_of, weighted=False)


def _meeting_analysis(t: Tables, as_of, weighted: bool) -> DataFrame:
    e = live(t, "engagement").filter(F.col("type") == "MEETING")
    mt = t["engagement_meeting"].select("engagement_id", F.col("start_time").alias("_start"),
                                        F.col("end_time").alias("_end"), F.col("meeting_outcome").alias("_outcome"))
    base = e.join(mt, "engagement_id", "inner")
    e = with_fanout(base, t, ["contact", "company", "deal"])
    if not weighted:
        e = e.withColumn("_m", F.lit(1).cast("long"))
    m = F.col("_m")
    both = F.col("_start").isNotNull() & F.col("_end").isNotNull()
    mins = minutes_between_boundary("_start", "_end")
    oc = F.col("_outcome")
    keys = ["owner_id", "_outcome"]
    g = e.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_meetings"),
        F.sum(F.when(both, mins * m).otherwise(F.lit(0).cast("long"))).alias("total_meeting_minutes"),
        F.sum(F.when(both, mins * m)).alias("_x_sum"), F.sum(F.when(both, m)).alias("_x_n"),
        *[F.count(F.when(oc == o, 1)).alias(n) for o, n in
          [("COMPLETED", "completed_meetings"), ("SCHEDULED", "scheduled_meetings"), ("CANCELED", "canceled_meetings"),
           ("NO_SHOW", "no_show_meetings"), ("RESCHEDULED", "rescheduled_meetings")]],
        F.count(F.when(since("timestamp", as_of, 7), 1)).alias("meetings_7d"),
        F.count(F.when(since("timestamp", as_of, 30), 1)).alias("meetings_30d"))
    members = distinct_members(base, t, keys, ["contact", "company", "deal"],
                               {"contact": "unique_contacts_met", "company": "unique_companies_met",
                                "deal": "deals_with_meetings"})
    g = merge_by_keys([g, members], keys)
    g = with_owner(g, t, cols=("owner_name",))
    n = F.col("total_meetings")
    return g.select(
        "owner_id", "owner_name", F.coalesce("_outcome", F.lit("Unknown")).alias("meeting_outcome"), "total_meetings",
        "total_meeting_minutes", (F.col("_x_sum").cast("double") / F.col("_x_n").cast("double")).alias("avg_meeting_minutes"),
        "completed_meetings", "scheduled_meetings", "canceled_meetings", "no_show_meetings", "rescheduled_meetings",
        ratio("completed_meetings", n, "100.0", (10, 2)).alias("completion_rate"),
        ratio("no_show_meetings", n, "100.0", (10, 2)).alias("no_show_rate"), "meetings_7d", "meetings_30d",
        *[F.coalesce(c_, F.lit(0).cast("long")).alias(c_) for c_ in
          ["unique_contacts_met", "unique_companies_met", "deals_with_meetings"]])


def meeting_analysis(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Meeting minutes follow the source's contact x company x deal fan-out."""
    return _meeting_analysis(t, as_of, weighted=True)


def meeting_analysis_dedup(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """Meeting minutes with each meeting counted once."""
    return _meeting_analysis(t, as_of, weighted=False)
