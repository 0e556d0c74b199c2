"""Semantic-model measures over the imported views, evaluated under a filter context (``operators.context``).

``DIVIDE(a, b, 0)`` is 0 on a zero/blank denominator.  ``evaluate(df, measures, by)`` applies the axis of a visual
(no ``by`` = the card/grand-total value); CALCULATE filters replace the axis on their columns.  Date-shifted measures (previous period) go through
``shift_compare``: the metric is aggregated per date once and joined to itself on
``date + n days`` - an equi-join of two per-day tables, never a scan per period.
"""
from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_date_lit
from ..operators.context import ALL, average_of, evaluate, is_, rows_of, sum_of
from ..sources.catalog import Tables


def divide(a: Column, b: Column) -> Column:
    """DAX ``DIVIDE(a, b, 0)`` as double."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def contact_measures(as_of) -> tuple[dict, dict]:
    cutoff = F.date_sub(as_date_lit(as_of), 30).cast("timestamp_ntz")
    base = {"total_contacts": rows_of(), "total_customers": rows_of(lifecycle_stage=is_("customer")),
            "total_contact_revenue": sum_of("total_revenue"), "new_contacts_30d": rows_of(created_at=lambda c: c >= cutoff)}
    derived = {"customer_conversion_rate": lambda: divide(F.col("total_customers"), F.col("total_contacts")) * 100}
    return base, derived


def deal_measures() -> tuple[dict, dict]:
    """Each measure with the columns that its CALCULATE filters set; ``_closed_deals`` is the win rate's inner CALCULATE."""
    open_, won, closed = {"deal_status": is_("Open")}, {"is_closed_won": is_(True)}, {"is_closed": is_(True)}
    base = {"total_deals": rows_of(), "open_deals": rows_of(**open_), "won_deals": rows_of(**won),
            "lost_deals": rows_of(**closed, is_closed_won=is_(False)), "_closed_deals": rows_of(**closed),
            "pipeline_value": sum_of("amount", **open_), "weighted_pipeline": sum_of("weighted_amount", **open_),
            "closed_won_revenue": sum_of("amount", **won), "avg_days_to_close": average_of("actual_days_to_close")}
    derived = {"deal_win_rate": lambda: divide(F.col("won_deals"), F.col("_closed_deals")) * 100,
               "avg_deal_size": lambda: divide(F.col("pipeline_value"), F.col("open_deals"))}
    return base, derived


EMAIL_MEASURES = {"avg_open_rate": average_of("unique_open_rate"), "avg_click_rate": average_of("unique_click_rate"),
                  "avg_delivery_rate": average_of("delivery_rate"), "total_emails_sent": sum_of("sent_count")}

# contacts/companies engaged are sums of per-day distinct counts (a contact active on two days counts twice)
ENGAGEMENT_MEASURES = {"total_engagements": sum_of("total_engagements"), "total_calls": sum_of("total_calls"),
                       "total_meetings": sum_of("total_meetings"), "total_crm_emails": sum_of("total_emails"),
                       "contacts_engaged": sum_of("unique_contacts_engaged"), "companies_engaged": sum_of("unique_companies_engaged")}


def m_contact_measures(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    from .crm import contact_performance
    base, derived = contact_measures(as_of)
    return evaluate(contact_performance(t, as_of), base, (), derived)


def m_deal_measures(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    from .crm import deal_performance
    base, derived = deal_measures()
    return evaluate(deal_performance(t, as_of), base, (), derived)


def m_contact_measures_by_stage(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """The contact measures on a lifecycle-stage axis: total customers repeats its total on every stage."""
    from .crm import contact_performance
    base, derived = contact_measures(as_of)
    return evaluate(contact_performance(t, as_of), base, ["lifecycle_stage"], derived)


def m_deal_measures_by_status(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """The deal measures on a (status, owner) axis: open deals and pipeline repeat per owner on every status."""
    from .crm import deal_performance
    base, derived = deal_measures()
    return evaluate(deal_performance(t, as_of), base, ["deal_status", "owner_id"], derived)


def m_deal_measures_by_closed(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """The deal measures on an (is closed, is won) axis, both of which several measures filter themselves: won deals keep the axis' is_closed, the win
    rate's closed deals its is_closed_won, lost deals neither. And each row's deals as a share of all (the axis removed)."""
    from .crm import deal_performance
    base, derived = deal_measures()
    base["_all_deals"] = base["total_deals"].within({"is_closed": ALL, "is_closed_won": ALL})
    base["_open_of_all"] = base["open_deals"].within({"is_closed": ALL, "deal_status": is_("Closed Won")})  # the inner filter on the status wins
    derived["pct_of_deals"] = lambda: divide(F.col("total_deals"), F.col("_all_deals")) * 100
    derived["open_deals_any_closed"] = lambda: F.col("_open_of_all")
    return evaluate(deal_performance(t, as_of), base, ["is_closed", "is_closed_won"], derived)


def m_email_measures(t: Tables) -> DataFrame:
    from .email import email_performance
    return evaluate(email_performance(t), EMAIL_MEASURES)


def m_engagement_measures(t: Tables) -> DataFrame:
    from .engagements import engagement_daily_summary
    return evaluate(engagement_daily_summary(t), ENGAGEMENT_MEASURES)


def shift_compare(daily: DataFrame, date_col: str, metric: str, n: int, name: str, unit: str = "day") -> DataFrame:
    """Attach ``name`` = ``metric`` on the date ``n`` units earlier (DAX
    ``CALCULATE(m, DATEADD(date, -n, unit))`` evaluated per date: the time-intelligence
    calculation group for WoW / MoM / YoY).  ``daily`` must be one row per date.  Each date gets
    exactly one lookup date (month/year shifts clamp to the month end like ``add_months``), so the
    equi-join on it never duplicates rows."""
    d = F.col(date_col)
    lookup = {"day": F.date_sub(d, n), "week": F.date_sub(d, 7 * n), "month": F.add_months(d, -n),
              "year": F.add_months(d, -12 * n)}[unit]
    prev = daily.select(F.col(date_col).alias("_src"), F.col(metric).alias(name))
    return daily.withColumn("_lk", lookup).join(prev, F.col("_lk") == prev["_src"], "left").drop("_lk", "_src")


def m_ads_daily_measures(t: Tables, as_of: _dt.date | None = None) -> DataFrame:
    """README ad measures on a date axis: spend, CTR %, ROAS, previous-period (-30 days) spend
    and spend change %.  Dates come from the calendar; days without facts are blank, as on a
    report axis over the date dimension."""
    from .search_ads import account_performance
    from .time_periods import date_dimension
    ap = account_performance(t).groupBy("date").agg(F.sum("spend").alias("total_spend"),
                                                    F.sum("clicks").alias("_clicks"),
                                                    F.sum("impressions").alias("_imp"),
                                                    F.sum("conversions_value").alias("_value"))
    cal = date_dimension(t, as_of).select("date")
    daily = cal.join(ap, "date", "left")
    daily = shift_compare(daily, "date", "total_spend", 30, "previous_period_spend")
    cur, prev = F.col("total_spend"), F.col("previous_period_spend")
    return daily.select(
        "date", "total_spend", (divide(F.col("_clicks"), F.col("_imp")) * 100).alias("ctr_pct"),
        divide(F.col("_value"), cur).alias("roas"), "previous_period_spend",
        (divide(F.coalesce(cur, F.lit(0)) - F.coalesce(prev, F.lit(0)), prev) * 100).alias("spend_change_pct"))


def m_spend_time_intelligence(t: Tables) -> DataFrame:
    """Total spend per date with week-, month- and year-ago values and change % (calculation
    group applied to one measure), over the long-range search-ads history."""
    from .search_ads import account_performance
    from .time_periods import _LongRange
    lt = _LongRange(t)
    daily = account_performance(lt).groupBy("date").agg(F.sum("spend").alias("total_spend"))
    for unit, col in [("week", "spend_wow"), ("month", "spend_mom"), ("year", "spend_yoy")]:
        daily = shift_compare(daily, "date", "total_spend", 1, col, unit)
    cur = F.col("total_spend")
    return daily.select("date", "total_spend", "spend_wow", "spend_mom", "spend_yoy",
                        *[(divide(cur - F.col(c), F.col(c)) * 100).alias(f"{c}_change_pct")
                          for c in ["spend_wow", "spend_mom", "spend_yoy"]])


#: Time shifts of a calculation group: suffix -> unit.
SHIFTS = {"wow": "week", "mom": "month", "yoy": "year"}


def time_intelligence(daily: DataFrame, date_col: str, base: Sequence[str], measures: Mapping[str, Callable[[Callable[[str], Column]], Column]],
                      shifts: Mapping[str, str] = SHIFTS) -> DataFrame:
    """Any measures on a date axis, as they are, shifted, and as a change in percent.

    ``daily`` has one row per date with the additive ``base`` columns. A measure is a function of a look-up of base columns, so that a ratio is
    taken of the shifted sums, not shifted itself; each shift is one join that brings all base columns."""
    out, d = daily.select(date_col, *base), F.col(date_col)
    look = {"day": lambda: F.date_sub(d, 1), "week": lambda: F.date_sub(d, 7), "month": lambda: F.add_months(d, -1), "year": lambda: F.add_months(d, -12)}
    for tag, unit in shifts.items():
        then = daily.select(F.col(date_col).alias("_src"), F.lit(True).alias(f"_has_{tag}"), *[F.col(b).alias(f"_{tag}_{b}") for b in base])
        out = out.withColumn("_lk", look[unit]()).join(then, F.col("_lk") == F.col("_src"), "left").drop("_lk", "_src")
    columns = [d]
    for name, measure in measures.items():
        now = measure(F.col)
        columns.append(now.alias(name))
        for tag in shifts:
            # a date without rows then has no value, not a ratio of nothing
            then = F.when(F.col(f"_has_{tag}"), measure(lambda b, tag=tag: F.col(f"_{tag}_{b}")))
            columns += [then.alias(f"{name}_{tag}"), (divide(now - then, then) * 100).alias(f"{name}_{tag}_change_pct")]
    return out.select(*columns)


def m_ads_time_intelligence(t: Tables) -> DataFrame:
    """Spend, clicks, CTR % and ROAS per date with their week-, month- and year-ago values, over the long-range search-ads history."""
    from .search_ads import account_performance
    from .time_periods import _LongRange
    base = ["spend", "clicks", "impressions", "conversions_value"]
    daily = account_performance(_LongRange(t)).groupBy("date").agg(*[F.sum(b).alias(b) for b in base])
    return time_intelligence(daily, "date", base, {
        "total_spend": lambda c: c("spend"), "total_clicks": lambda c: c("clicks"), "ctr_pct": lambda c: divide(c("clicks"), c("impressions")) * 100,
        "roas": lambda c: divide(c("conversions_value"), c("spend"))})
