"""All oracle SQL by query key."""
from __future__ import annotations

from . import crm, crm_dashboards, drilldown, email, engagements, insights, measures, primitives, search_ads, search_dashboards, social_ads, time_periods

ORACLE: dict[str, str] = {}
for _m in (search_ads, time_periods, search_dashboards, social_ads, crm, email, engagements, crm_dashboards, measures, insights, primitives, drilldown):
    ORACLE.update(_m.SQL)
