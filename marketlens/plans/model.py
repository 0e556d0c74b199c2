"""The tables' relationships as a graph: filters and attributes that travel along paths of several hops.

A relationship leads from a column of the many side to a key of the one side. A filter set on a table reaches every
table from which a path leads to it: ``filtered`` walks that path back from the filtered table as a chain of semi joins on the keys, so
no hop multiplies rows, not even where the key repeats on its one side. Where several paths lead to the same table the filter is
ambiguous, an error that names them, unless the caller says which relationships to use.
"""
from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.catalog import Tables, slice_rows


@dataclass(frozen=True)
class Relationship:
    name: str
    many: str
    column: str
    one: str
    key: str


class AmbiguousPath(ValueError):
    """More than one path of active relationships leads from a table to another."""


#: Fixed: the relationships of the semantic model and of the recommended star, by table.
RELATIONSHIPS = [
    Relationship("ContactToCompany", "ContactPerformance", "associated_company_id", "CompanyPerformance", "company_id"),
    Relationship("DealToOwnerPerformance", "DealPerformance", "owner_id", "DealOwnerPerformance", "owner_id"),
    Relationship("DealToForecast", "DealForecast", "owner_id", "DealOwnerPerformance", "owner_id"),
    Relationship("AccountToDate", "account_performance", "date_id", "date_dimension", "date_id"),
    Relationship("CampaignToDate", "campaign_performance", "date_id", "date_dimension", "date_id"),
    Relationship("CampaignToAccount", "campaign_performance", "account_id", "account_performance", "account_id"),
    Relationship("AdGroupToCampaign", "ad_group_performance", "campaign_id", "campaign_performance", "campaign_id"),
]


class Model:
    """Named tables (each a function that plans it) and the relationships between them."""

    def __init__(self, tables: Mapping[str, Callable[[], DataFrame]], relationships: Iterable[Relationship] = RELATIONSHIPS):
        self._plans, self._frames = dict(tables), {}
        self.relationships = [r for r in relationships if r.many in self._plans and r.one in self._plans]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._plans[name]()
        return self._frames[name]

    def paths(self, many: str, one: str, using: Sequence[str] | None = None) -> list[list[Relationship]]:
        """All paths without a repeated table from ``many`` to ``one``, of the relationships named in ``using`` (all if None)."""
        active = [r for r in self.relationships if using is None or r.name in using]
        found, open_ = [], [[r] for r in active if r.many == many]
        while open_:
            path = open_.pop()
            if path[-1].one == one:
                found.append(path)
                continue
            seen = {r.many for r in path} | {path[-1].one}
            open_ += [path + [r] for r in active if r.many == path[-1].one and r.one not in seen]
        return found

    def path(self, many: str, one: str, using: Sequence[str] | None = None) -> list[Relationship]:
        found = self.paths(many, one, using)
        if not found:
            raise ValueError(f"no relationship leads from {many} to {one}")
        if len(found) > 1:
            ways = "; ".join(" > ".join(r.name for r in p) for p in sorted(found, key=lambda p: [r.name for r in p]))
            raise AmbiguousPath(f"{many} reaches {one} on several paths: {ways}")
        return found[0]

    def filtered(self, table: str, filters: Mapping[str, Mapping[str, object]], using: Sequence[str] | None = None) -> DataFrame:
        """``table`` under slicers set on any tables: table -> {column: value | list | (low, high)}."""
        rows = slice_rows(self[table], filters.get(table, {}))
        for other, slicers in filters.items():
            if other == table:
                continue
            path = self.path(table, other, using)
            chosen = slice_rows(self[other], slicers)
            for hop in reversed(path):
                keys = chosen.select(F.col(hop.key).alias("_key")).distinct()
                side = rows if hop is path[0] else self[hop.many]
                chosen = side.join(keys, side[hop.column] == keys["_key"], "left_semi")
            rows = chosen
        return rows

    def related(self, table: str, one: str, columns: Mapping[str, str], using: Sequence[str] | None = None) -> DataFrame:
        """``table`` with columns of ``one`` (name there -> name here) brought along the path; rows without a partner keep NULLs.

        The keys on the way have to be unique, as many-to-one says; a key that repeats is an error of the model: every hop is reduced
        to one row a key, by the smallest values."""
        path = self.path(table, one, using)
        chosen, wanted = self[one], dict(columns)
        for hop in reversed(path):
            carried = chosen.groupBy(F.col(hop.key).alias("_key")).agg(F.min(F.struct(*wanted)).alias("_v"))
            carried = carried.where(F.col("_key").isNotNull()).select("_key", *[F.col(f"_v.{c}").alias(n) for c, n in wanted.items()])
            side = self[hop.many]
            chosen = side.join(carried, side[hop.column] == carried["_key"], "left").drop("_key")
            wanted = {n: n for n in wanted.values()}
        return chosen


def search_model(t: Tables, as_of=None) -> Model:
    """The search-ads star: ad groups to campaigns to accounts, campaigns and accounts to the calendar."""
    from . import search_ads, time_periods
    return Model({"date_dimension": lambda: time_periods.date_dimension(t, as_of), "account_performance": lambda: search_ads.account_performance(t),
                  "campaign_performance": lambda: search_ads.campaign_performance(t), "ad_group_performance": lambda: search_ads.ad_group_performance(t)})


def crm_model(t: Tables, as_of=None) -> Model:
    from . import crm
    return Model({"ContactPerformance": lambda: crm.contact_performance(t, as_of), "CompanyPerformance": lambda: crm.company_performance(t, as_of),
                  "DealPerformance": lambda: crm.deal_performance(t, as_of), "DealForecast": lambda: crm.deal_forecast(t, as_of),
                  "DealOwnerPerformance": lambda: crm.deal_owner_performance(t, as_of)})


def rq_ad_groups_of_accounts(t: Tables) -> DataFrame:
    """Ad group totals under a filter two hops away: accounts billed in EUR."""
    rows = search_model(t).filtered("ad_group_performance", {"account_performance": {"currency_code": "EUR"}})
    return rows.groupBy("ad_group_id", "ad_group_name", "campaign_name").agg(
        F.sum("spend").alias("total_spend"), F.sum("clicks").alias("total_clicks"), F.sum("conversions").alias("total_conversions"))


def rq_campaigns_of_quarter(t: Tables, as_of=None) -> DataFrame:
    """Campaign totals under two filters: dates of the first quarter and accounts billed in USD. The date filter takes the direct
    relationship; the way over the accounts' own dates would make it ambiguous."""
    rows = search_model(t, as_of).filtered(
        "campaign_performance", {"date_dimension": {"quarter_number": 1}, "account_performance": {"currency_code": "USD"}},
        using=["CampaignToDate", "CampaignToAccount"])
    return rows.groupBy("campaign_id", "campaign_name").agg(F.sum("spend").alias("total_spend"), F.sum("impressions").alias("total_impressions"))


def rq_forecast_of_winning_owners(t: Tables, as_of=None) -> DataFrame:
    """Forecast by period, filtered from the other side of DealToForecast: owners with a win rate of 40 or more."""
    rows = crm_model(t, as_of).filtered("DealForecast", {"DealOwnerPerformance": {"win_rate": (40, None)}})
    return rows.groupBy("forecast_period").agg(F.sum("deal_count").alias("deal_count"), F.sum("pipeline_value").alias("pipeline_value"),
                                               F.sum("weighted_pipeline").alias("weighted_pipeline"))
