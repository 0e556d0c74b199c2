"""Role adapters: shape the driver's TPC-H-like tables into the ad/CRM source schemas.

These are deterministic projections written with integer/decimal arithmetic only (prices
have two decimals and are cast to decimal before any arithmetic), so a SQL engine running
the same definitions gets bit-identical inputs.  The matching DuckDB text lives in
``sqloracle/adapters.py``; the two must change together.

Search ads (``ads_base`` = lineitem):
  ad_group_id = l_suppkey, campaign_id = 7 for every third ad group (a hot campaign with a third of all rows, alone in its hot
  account) and else 10 + ad_group_id / 2, account_id = campaign_id / 8, so campaigns and accounts grow with the suppliers;
  ad_id = l_suppkey*1000 + l_partkey%7, criterion_id = l_suppkey*1000 + l_partkey%11,
  date = 2024-01-01 + (days from 1995-01-01 to l_shipdate) % 120.
History tables: every key in two versions synced on 2024-01-02 / 2024-01-03 with the name
suffixed ``-v1`` / ``-v2``; keys with key % 13 = 12 have no history (missing dimension);
the latest version of keys with key % 7 = 3 is soft-deleted, keys with key % 5 = 1 carry a
NULL delete flag.

Social ads: ``fb_basic_ad`` is the ad level of ``ads_base`` (ad set = ad group) with
reach = 15 x quantity, actions = conversions; histories mirror the search-ads ones (accounts,
campaigns, supplier, supplier x 7) and the creative of an ad is its own id except ids % 9 = 4.
"""
from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import Tables, conform
from .schemas import SCHEMAS

# fixed evaluation dates used by the driver fixtures
ADS_AS_OF = _dt.date(2024, 4, 30)
CRM_AS_OF = _dt.date(2024, 1, 31)
LONG_AS_OF = _dt.date(2001, 8, 1)

_EPOCH = _dt.date(1995, 1, 1)
_ADS_START = _dt.date(2024, 1, 1)


def pick(key: Column, labels: list) -> Column:
    """labels[key % len(labels)] (NULL entries allowed)."""
    arr = F.array(*[F.lit(x).cast("string") for x in labels])
    return F.element_at(arr, (key % F.lit(len(labels))).cast("int") + 1)


def d(x: str) -> Column:
    return F.lit(Decimal(x))


def campaign_of(ad_group: Column) -> Column:
    return F.when(ad_group % 3 == 0, F.lit(7)).otherwise(F.lit(10) + F.floor(ad_group / 2)).cast("long")


def account_of(campaign: Column) -> Column:
    return F.floor(campaign / 8).cast("long")


class DriverTables(Tables):
    """All source tables derived from ``{sf_dir}/*.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.sf_dir = sf_dir
        builders = {name: (lambda n=name: conform(getattr(self, f"_build_{n}")(), SCHEMAS[n]))
                    for name in SCHEMAS if hasattr(self, f"_build_{name}")}
        builders["ads_base"] = self._ads_base
        builders["account_stats_long"] = lambda: conform(self._level(["account_id"], long_range=True),
                                                         SCHEMAS["account_stats"])
        super().__init__(spark, builders)

    # ------------------------------------------------------------------ raw driver tables
    def raw(self, name: str) -> DataFrame:
        """Driver table (one read per table and instance: listing and footer reads are not repeated)."""
        cache = self.__dict__.setdefault("_raw", {})
        if name not in cache:
            cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return cache[name]

    # ------------------------------------------------------------------ search ads
    def _ads_base(self, long_range: bool = False) -> DataFrame:
        li = self.raw("lineitem").select("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                                         "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
        ship = F.to_date("l_shipdate")
        date = ship if long_range else F.date_add(F.lit(_ADS_START), (F.datediff(ship, F.lit(_EPOCH)) % 120))
        campaign = campaign_of(F.col("l_suppkey"))
        return li.select(
            account_of(campaign).alias("account_id"), campaign.alias("campaign_id"), F.col("l_suppkey").alias("ad_group_id"),
            (F.col("l_suppkey") * 1000 + F.col("l_partkey") % 7).alias("ad_id"),
            (F.col("l_suppkey") * 1000 + F.col("l_partkey") % 11).alias("criterion_id"),
            date.alias("date"),
            F.col("l_quantity").cast("long").alias("qty"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
            F.col("l_discount").cast("decimal(4,2)").alias("disc"),
            F.col("l_linenumber").alias("line"),
            F.col("l_returnflag").alias("rflag"),
            F.col("l_linestatus").alias("lstatus"),
        )

    def _level(self, ids: list[str], long_range: bool = False) -> DataFrame:
        base = self._ads_base(long_range) if long_range else self["ads_base"]
        is_r = F.col("rflag") == "R"
        n_r = F.count(F.when(is_r, 1))
        g = base.groupBy(*ids, "date").agg(
            F.sum(F.col("price") * F.col("disc")).cast("decimal(18,6)").alias("spend"),
            (F.sum("qty") * 40).alias("impressions"),
            F.sum(F.when(F.col("line") != 1, F.col("qty")).otherwise(F.lit(0))).alias("clicks"),
            n_r.alias("_n_r"),
            F.sum("qty").alias("_qty"),
            F.count(F.lit(1)).alias("_rows"),
            F.coalesce(F.sum(F.when(is_r, F.col("price"))), d("0.00")).cast("decimal(18,6)").alias("conversions_value"),
            F.count(F.when(F.col("rflag") == "A", 1)).cast("decimal(18,6)").alias("view_through_conversions"),
            F.sum(F.when(F.col("lstatus") == "O", F.col("qty")).otherwise(F.lit(0))).alias("interactions"),
            F.sum(F.when(F.col("line") >= 5, F.col("qty")).otherwise(F.lit(0))).alias("video_views"),
        )
        q = F.col("_qty")
        rows = F.col("_rows")
        g = g.withColumns({
            # NULL conversions on some zero days, 0 on others
            "conversions": F.when((F.col("_n_r") == 0) & (q % 2 == 0), F.lit(None))
                             .otherwise(F.col("_n_r")).cast("decimal(18,6)"),
            "video_quartile_p25_rate": ((rows % 4) * d("0.25")).cast("decimal(10,6)"),
            "video_quartile_p50_rate": ((rows % 4) * d("0.20")).cast("decimal(10,6)"),
            "video_quartile_p75_rate": ((rows % 4) * d("0.15")).cast("decimal(10,6)"),
            "video_quartile_p100_rate": F.when(rows % 5 == 0, F.lit(None))
                                         .otherwise((rows % 4) * d("0.10")).cast("decimal(10,6)"),
            "interaction_event_types": F.when(F.col("clicks") > 0, F.lit("CLICK")),
            "search_impression_share": ((q % 100) * d("0.01")).cast("decimal(10,6)"),
            "search_top_impression_share": ((q % 50) * d("0.01")).cast("decimal(10,6)"),
            "search_absolute_top_impression_share": ((q % 25) * d("0.01")).cast("decimal(10,6)"),
            "search_rank_lost_impression_share": ((rows % 10) * d("0.05")).cast("decimal(10,6)"),
            "search_budget_lost_impression_share": ((rows % 20) * d("0.01")).cast("decimal(10,6)"),
            "_fivetran_synced": F.date_add(F.col("date"), 1).cast("timestamp_ntz"),
        })
        return g

    def _build_account_stats(self):
        return self._level(["account_id"])

    def _build_campaign_stats(self):
        return self._level(["campaign_id", "account_id"])

    def _build_ad_group_stats(self):
        return self._level(["ad_group_id", "campaign_id", "account_id"])

    def _build_ad_stats(self):
        return self._level(["ad_id", "ad_group_id", "campaign_id", "account_id"])

    def _build_keyword_stats(self):
        return self._level(["criterion_id", "ad_group_id", "campaign_id", "account_id"])

    def _campaigns(self) -> DataFrame:
        """campaign_id, account_id, c_name."""
        c = self.raw("supplier").select(campaign_of(F.col("s_suppkey")).alias("campaign_id")).distinct()
        return c.select("campaign_id", account_of(F.col("campaign_id")).alias("account_id"), F.concat(F.lit("Campaign "), F.col("campaign_id")).alias("c_name"))

    def _accounts(self) -> DataFrame:
        """account_id, a_name."""
        return self._campaigns().select("account_id").distinct().select("account_id", F.concat(F.lit("Account "), F.col("account_id")).alias("a_name"))

    # history helpers --------------------------------------------------------------
    @staticmethod
    def _versions(df: DataFrame, key: str) -> DataFrame:
        """Two versions per key, drop keys %13 = 12, delete latest version of keys %7 = 3."""
        k = F.col(key)
        v = df.filter(k % 13 != 12).withColumn("_v", F.explode(F.array(F.lit(1), F.lit(2))))
        return v.withColumns({
            "_fivetran_synced": F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(1) + F.col("_v"),
                                                     F.lit(0), F.lit(0), F.lit(0)),
            # latest version deleted for keys %7 = 3; flag unknown (NULL) for keys %5 = 1
            "_fivetran_deleted": F.when((F.col("_v") == 2) & (k % 7 == 3), F.lit(True))
                                  .when(k % 5 == 1, F.lit(None).cast("boolean")).otherwise(F.lit(False)),
        })

    @staticmethod
    def _vname(col: str) -> Column:
        return F.concat(F.col(col), F.lit("-v"), F.col("_v").cast("string"))

    def _build_account_history(self):
        v = self._versions(self._accounts(), "account_id")
        k = F.col("account_id")
        return v.withColumns({
            "descriptive_name": self._vname("a_name"),
            "currency_code": pick(k, ["USD", "EUR"]),
            "time_zone": F.lit("UTC"),
            "auto_tagging_enabled": k % 2 == 0,
            "manager": F.lit(False),
            "test_account": F.lit(False),
        })

    def _build_campaign_history(self):
        v = self._versions(self._campaigns(), "campaign_id")
        k = F.col("campaign_id")
        return v.withColumns({
            "name": self._vname("c_name"),
            "status": pick(k, ["ENABLED", "PAUSED", "REMOVED"]),
            "advertising_channel_type": pick(k, ["SEARCH", "DISPLAY", "VIDEO", "SHOPPING"]),
            "advertising_channel_sub_type": pick(k, [None, "STANDARD", "SMART"]),
            "bidding_strategy_type": pick(k, ["TARGET_CPA", "MAXIMIZE_CONVERSIONS", "MANUAL_CPC"]),
            "start_date": F.date_add(F.lit(_dt.date(2023, 12, 1)), (k % 365).cast("int")),
            "end_date": F.when(k % 5 == 0, F.lit(_dt.date(2024, 6, 30))),
            "budget_amount": F.when(k % 6 == 0, d("0")).otherwise((k % 6) * 250 + F.col("_v") * 10)
                              .cast("decimal(18,6)"),
            "budget_period": F.lit("DAILY"),
            "serving_status": F.lit("SERVING"),
            "ad_serving_optimization_status": F.lit("OPTIMIZE"),
        })

    def _build_ad_group_history(self):
        s = self.raw("supplier").select(F.col("s_suppkey").alias("ad_group_id"),
                                        campaign_of(F.col("s_suppkey")).alias("campaign_id"), "s_name")
        v = self._versions(s, "ad_group_id")
        k = F.col("ad_group_id")
        target = F.when(k % 4 != 0, (k % 4) * 5000000)
        return v.withColumns({
            "name": self._vname("s_name"),
            "status": pick(k, ["ENABLED", "PAUSED", "REMOVED"]),
            "type": pick(k, ["SEARCH_STANDARD", "DISPLAY_STANDARD"]),
            "cpc_bid_micros": (k % 50 + 1) * 100000,
            "cpm_bid_micros": (k % 20) * 500000,
            "target_cpa_micros": target,
            "effective_target_cpa_micros": F.coalesce(target, F.lit(0).cast("long")),
            "effective_target_roas": ((k % 5) * d("0.5")).cast("decimal(10,6)"),
        })

    def _supplier_fanout(self, key: str, n: int) -> DataFrame:
        s = self.raw("supplier").select("s_suppkey")
        return s.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).select(
            (F.col("s_suppkey") * 1000 + F.col("_k")).alias(key), F.col("s_suppkey").alias("ad_group_id"),
            F.col("_k").cast("long").alias("_k"))

    def _build_ad_history(self):
        a = self._versions(self._supplier_fanout("ad_id", 7), "ad_id")
        k, g = F.col("_k"), F.col("ad_group_id")
        g_s = g.cast("string")
        return a.withColumns({
            "type": pick(k, ["RESPONSIVE_SEARCH_AD", "EXPANDED_TEXT_AD", "RESPONSIVE_DISPLAY_AD", "IMAGE_AD"]),
            "status": pick(k, ["ENABLED", "PAUSED"]),
            "device_preference": F.lit(None).cast("string"),
            "ad_strength": pick(k, ["EXCELLENT", "GOOD", "AVERAGE", "POOR", "UNSPECIFIED", None, "PENDING"]),
            "display_url": F.concat(F.lit("www.s"), g_s, F.lit(".example")),
            "final_urls": F.concat(F.lit('["https://s'), g_s, F.lit(".example/"), k.cast("string"), F.lit('"]')),
            "final_mobile_urls": F.lit(None).cast("string"),
            "responsive_search_ad_headlines": F.concat(F.lit("Headline "), k.cast("string"), F.lit(" "),
                                                       F.repeat(F.lit("great offers "), (k + 3).cast("int"))),
            "responsive_search_ad_descriptions": F.concat(F.lit("Description for group "), g_s,
                                                          F.lit(" "), F.repeat(F.lit("buy now "), 15)),
            "responsive_search_ad_path1": F.lit("deals"),
            "responsive_search_ad_path2": F.when(k % 2 == 0, F.lit("today")),
            "expanded_text_ad_headline_part1": F.concat(F.lit("Part one "), k.cast("string")),
            "expanded_text_ad_headline_part2": F.when(k % 3 != 0, F.lit("Part two")),
            "expanded_text_ad_headline_part3": F.lit(None).cast("string"),
            "expanded_text_ad_description": F.concat(F.lit("Expanded description "), g_s),
            "expanded_text_ad_description2": F.lit(None).cast("string"),
            "expanded_text_ad_path1": F.lit("shop"),
            "expanded_text_ad_path2": F.lit(None).cast("string"),
        })

    def _build_ad_group_criterion_history(self):
        c = self._versions(self._supplier_fanout("criterion_id", 11), "criterion_id")
        k, g = F.col("_k"), F.col("ad_group_id")
        qs = (g + k) % 11
        levels = ["ABOVE_AVERAGE", "AVERAGE", "BELOW_AVERAGE"]
        return c.withColumns({
            "type": F.when(k == 10, F.lit("AUDIENCE")).otherwise(F.lit("KEYWORD")),
            "status": pick(k, ["ENABLED", "PAUSED"]),
            "keyword_text": F.concat(F.lit("kw-"), g.cast("string"), F.lit("-"), k.cast("string")),
            "keyword_match_type": pick(k, ["EXACT", "PHRASE", "BROAD"]),
            "system_serving_status": F.lit("ELIGIBLE"),
            "approval_status": F.lit("APPROVED"),
            "quality_score": F.when(qs != 0, qs).cast("int"),
            "creative_quality_score": pick(g + k, levels),
            "post_click_quality_score": pick(g + 2 * k, levels),
            "search_predicted_ctr": pick(g + 5 * k, levels),
            "cpc_bid_micros": (k + 1) * 250000,
            "effective_cpc_bid_micros": (k + 1) * 250000,
            "final_url_suffix": F.lit(None).cast("string"),
        })

    # ------------------------------------------------------------------ social ads
    def _build_fb_basic_ad(self):
        a = self["ad_stats"]
        return a.select(
            "ad_id", F.col("ad_group_id").alias("adset_id"), "campaign_id", "account_id", "date", "spend",
            "impressions", "clicks", (F.expr("impressions div 40") * 15).alias("reach"),
            F.col("conversions").alias("actions"), F.col("conversions_value").alias("action_values"),
            pick(F.col("ad_id"), ["18-24", "25-34", "35-44", "45-54", "55-64", "65+"]).alias("age"),
            pick(F.col("campaign_id"), ["male", "female", "unknown"]).alias("gender"),
            pick(F.col("ad_group_id"), ["feed_network", "photo_network", "partner_network", "messaging"])
            .alias("publisher_platform"),
            pick(F.col("ad_id") + F.col("ad_group_id"), ["feed", "story", "reels", "right_hand_column"])
            .alias("platform_position"),
            pick(F.col("ad_id") + F.col("campaign_id"), ["iphone", "android_smartphone", "desktop", "ipad"])
            .alias("impression_device"),
            pick(F.col("ad_id"), ["mobile", "desktop"]).alias("device_platform"),
            "_fivetran_synced")

    def _build_fb_account_history(self):
        v = self._versions(self._accounts(), "account_id")
        k = F.col("account_id")
        return v.withColumns({
            "name": F.concat(F.col("a_name"), F.lit("-fb-v"), F.col("_v").cast("string")),
            "account_status": pick(k, ["ACTIVE", "DISABLED"]),
            "currency": pick(k, ["USD", "EUR"]),
            "timezone_name": F.lit("UTC"),
        })

    def _build_fb_campaign_history(self):
        v = self._versions(self._campaigns(), "campaign_id")
        k = F.col("campaign_id")
        return v.withColumns({
            "name": F.concat(F.col("c_name"), F.lit("-fb-v"), F.col("_v").cast("string")),
            "status": pick(k, ["ACTIVE", "PAUSED"]),
            "objective": pick(k, ["CONVERSIONS", "LINK_CLICKS", "REACH", "BRAND_AWARENESS", "LEAD_GENERATION"]),
            "daily_budget": F.when(k % 4 != 0, (k % 4) * 100 + F.col("_v") * 5).cast("decimal(18,6)"),
            "lifetime_budget": F.when(k % 4 == 0, F.lit(5000)).cast("decimal(18,6)"),
        })

    def _build_fb_adset_history(self):
        s = self.raw("supplier").select(F.col("s_suppkey").alias("adset_id"), "s_name")
        v = self._versions(s, "adset_id")
        k = F.col("adset_id")
        return v.withColumns({
            "name": F.concat(F.col("s_name"), F.lit("-fb-v"), F.col("_v").cast("string")),
            "status": pick(k, ["ACTIVE", "PAUSED"]),
            "targeting": pick(k, ['{"age_min": 18}', '{"geo": "US"}', None]),
            "optimization_goal": pick(k, ["OFFSITE_CONVERSIONS", "LINK_CLICKS", "REACH", "IMPRESSIONS"]),
            "bid_amount": F.when(k % 3 != 0, (k % 3) * d("1.5")).cast("decimal(18,6)"),
        })

    def _build_fb_ad_history(self):
        a = self._versions(self._supplier_fanout("ad_id", 7), "ad_id")
        k = F.col("ad_id")
        return a.withColumns({
            "name": F.concat(F.lit("ad-"), k.cast("string"), F.lit("-v"), F.col("_v").cast("string")),
            "status": pick(F.col("_k"), ["ACTIVE", "PAUSED"]),
            "creative_id": F.when(k % 9 != 4, k),
        })

    def _build_fb_creative_history(self):
        c = self._supplier_fanout("creative_id", 7)
        v = self._versions(c, "creative_id")
        k, j = F.col("creative_id"), F.col("_k")
        return v.withColumns({
            "name": F.concat(F.lit("creative-"), k.cast("string"), F.lit("-v"), F.col("_v").cast("string")),
            "title": F.concat(F.lit("Title "), k.cast("string"), F.lit(" "), F.repeat(F.lit("save big "), (j * 3 + 1).cast("int"))),
            "body": F.concat(F.lit("Body "), F.repeat(F.lit("limited time offer "), (j + 5).cast("int"))),
            "call_to_action_type": pick(j, ["SHOP_NOW", "LEARN_MORE", "SIGN_UP", None, "BOOK_TRAVEL"]),
            "object_type": pick(k, ["PHOTO", "LINK", "VIDEO", "STATUS", "OFFER", "EVENT", None]),
        })

    # ------------------------------------------------------------------ CRM
    # owner <- nation, company <- supplier, contact <- customer, deal <- orders x customer,
    # email and engagement events <- events (see FIXTURES-style notes in each builder)
    @staticmethod
    def _ts(text: str) -> Column:
        return F.expr(f"TIMESTAMP_NTZ '{text}'")

    @staticmethod
    def _plus(ts: Column, days: Column | None = None, hours: Column | None = None,
              minutes: Column | None = None) -> Column:
        z = F.lit(0)
        return ts + F.make_dt_interval(days if days is not None else z, hours if hours is not None else z,
                                       minutes if minutes is not None else z, F.lit(0))

    def _synced(self) -> Column:
        return self._ts("2024-02-01 00:00:00")

    def _build_owner(self):
        n = self.raw("nation")
        k = F.col("n_nationkey").cast("long")
        return n.select(
            k.alias("owner_id"), F.concat(F.lower("n_name"), F.lit("@example.com")).alias("email"),
            F.col("n_name").alias("first_name"),
            F.when(k % 5 != 0, F.concat(F.lit("Owner"), k.cast("string"))).alias("last_name"),
            F.lit("PERSON").alias("type"), self._ts("2023-01-01 00:00:00").alias("created_at"),
            self._ts("2023-06-01 00:00:00").alias("updated_at"), (k == 24).alias("_fivetran_deleted"),
            self._synced().alias("_fivetran_synced"))

    def _build_company(self):
        s = self.raw("supplier").join(self.raw("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        k = F.col("s_suppkey")
        created = self._plus(self._ts("2023-01-01 09:00:00"), days=(k * 3 % 365).cast("int"))
        return s.select(
            k.alias("company_id"), F.col("s_name").alias("name"),
            F.concat(F.lit("s"), k.cast("string"), F.lit(".example")).alias("domain"),
            F.when(k % 9 != 0, F.col("n_name")).alias("industry"),
            pick(k, ["PROSPECT", "CUSTOMER", "PARTNER"]).alias("type"),
            F.concat(F.lit("+1-555-"), k.cast("string")).alias("phone"),
            F.when(k % 7 != 0, F.concat(F.lit("City"), (k % 10).cast("string"))).alias("city"),
            F.when(k % 5 != 0, F.concat(F.lit("ST"), (k % 4).cast("string"))).alias("state"),
            F.when(k % 11 != 0, pick(F.col("n_regionkey").cast("long"), ["US", "DE", "FR", "BR", "JP"])).alias("country"),
            F.concat(F.lit("Z"), (k % 1000).cast("string")).alias("postal_code"),
            F.col("s_nationkey").cast("long").alias("owner_id"),
            pick(k, ["customer", "opportunity", "salesqualifiedlead", "marketingqualifiedlead", "lead", None])
            .alias("lifecycle_stage"),
            pick(k, ["NEW", "OPEN", "IN_PROGRESS", None]).alias("lead_status"),
            pick(k, ["1-10", "11-50", "51-200", "201-1000"]).alias("num_employees"),
            F.col("s_acctbal").cast("decimal(18,2)").alias("annual_revenue"),
            F.when(k % 3 != 0, (k % 10) * 1000).cast("decimal(18,2)").alias("total_revenue"),
            F.when(k % 8 != 0, k % 15).cast("int").alias("num_associated_contacts"),
            F.when(k % 6 != 0, k % 6).cast("int").alias("num_associated_deals"),
            created.alias("created_at"), self._plus(created, days=F.lit(30)).alias("updated_at"),
            F.when(k % 11 != 0, F.date_sub(F.lit(CRM_AS_OF), (k % 60).cast("int"))).alias("last_activity_date"),
            F.when(k % 4 != 0, self._plus(created, days=(k % 200).cast("int"))).alias("last_contacted"),
            pick(k, ["ORGANIC_SEARCH", "PAID_SEARCH", "REFERRALS", "DIRECT_TRAFFIC"]).alias("hs_analytics_source"),
            F.when(k % 10 != 0, k % 40).cast("int").alias("hs_analytics_num_page_views"),
            F.when(k % 12 != 0, k % 8).cast("int").alias("hs_analytics_num_visits"),
            (k % 50 == 7).alias("_fivetran_deleted"), self._synced().alias("_fivetran_synced"))

    _SEGMENT_STAGE = {"AUTOMOBILE": "customer", "BUILDING": "opportunity", "FURNITURE": "salesqualifiedlead",
                      "HOUSEHOLD": "marketingqualifiedlead", "MACHINERY": "lead"}

    def _build_contact(self):
        c = self.raw("customer")
        k = F.col("c_custkey")
        seg = F.col("c_mktsegment")
        stage = F.when(k % 23 == 0, F.lit(None).cast("string")).when(k % 19 == 0, F.lit("evangelist")) \
            .when(k % 11 == 0, F.lit("subscriber"))
        for s_, st in self._SEGMENT_STAGE.items():
            stage = stage.when(seg == s_, F.lit(st))
        created = self._plus(self._ts("2023-01-01 08:00:00"), days=(k * 7 % 400).cast("int"),
                             hours=(k % 24).cast("int"))
        flag = lambda m, r: F.when(k % m == r, F.lit(None).cast("boolean")).otherwise(k % 2 == 0)
        return c.select(
            k.alias("contact_id"),
            F.when(k % 13 != 0, F.concat(F.lit("c"), k.cast("string"), F.lit("@mail.example"))).alias("email"),
            F.when(k % 17 != 0, F.concat(F.lit("First"), (k % 100).cast("string"))).alias("first_name"),
            F.col("c_name").alias("last_name"), F.concat(F.lit("+1-444-"), k.cast("string")).alias("phone"),
            F.concat(F.lit("Company "), (k % 100).cast("string")).alias("company"),
            pick(k, ["Manager", "Director", "Engineer", None]).alias("job_title"),
            stage.alias("lifecycle_stage"), pick(k, ["NEW", "OPEN", "CONNECTED", None]).alias("lead_status"),
            F.when(k % 29 != 0, F.col("c_nationkey").cast("long")).alias("owner_id"),
            F.when(k % 31 != 0, k % 100).alias("associated_company_id"),
            created.alias("created_at"), self._plus(created, days=F.lit(10)).alias("updated_at"),
            F.when(k % 9 != 0, F.date_sub(F.lit(CRM_AS_OF), (k % 120).cast("int"))).alias("last_activity_date"),
            F.when(k % 8 != 0, self._plus(created, days=(k * 3 % 90).cast("int"))).alias("last_contacted"),
            F.when(k % 10 != 0, k % 4).cast("int").alias("num_associated_deals"),
            F.when(k % 12 != 0, F.col("c_acctbal").cast("decimal(18,2)")).alias("total_revenue"),
            pick(k, ["ORGANIC_SEARCH", "PAID_SEARCH", "EMAIL_MARKETING", "SOCIAL_MEDIA", "REFERRALS",
                     "DIRECT_TRAFFIC", None]).alias("hs_analytics_source"),
            pick(k, ["search_engine_a", "search_engine_b", None]).alias("hs_analytics_source_data_1"),
            pick(k, [None, "campaign-a", "campaign-b", None, None]).alias("hs_analytics_source_data_2"),
            F.concat(F.lit("https://site.example/p"), (k % 9).cast("string")).alias("hs_analytics_first_url"),
            F.when(k % 14 != 0, k % 50).cast("int").alias("hs_analytics_num_page_views"),
            F.when(k % 15 != 0, k % 10).cast("int").alias("hs_analytics_num_visits"),
            (k % 6).cast("int").alias("hs_analytics_num_event_completions"),
            flag(16, 1).alias("hs_email_optout"), flag(18, 2).alias("hs_email_bounce"),
            flag(20, 3).alias("hs_email_quarantined"),
            (k % 97 == 0).alias("_fivetran_deleted"), self._synced().alias("_fivetran_synced"))

    def _orders_x_customer(self) -> DataFrame:
        o = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                                      "o_orderpriority")
        c = self.raw("customer").select("c_custkey", "c_mktsegment", "c_nationkey")
        return o.join(c, o.o_custkey == c.c_custkey, "left")

    def _deal_created(self) -> Column:
        k = F.col("o_orderkey")
        days = F.datediff(F.to_date("o_orderdate"), F.lit(_EPOCH)) % 210
        return self._plus(self._ts("2023-07-01 00:00:00"), days=days.cast("int"), hours=(k % 24).cast("int"))

    def _build_deal(self):
        oc = self._orders_x_customer()
        k = F.col("o_orderkey")
        created = self._deal_created()
        st = F.col("o_orderstatus")
        null_flags = k % 23 == 0
        is_closed = F.when(null_flags, F.lit(None).cast("boolean")).otherwise(st.isin("F", "P"))
        is_won = F.when(null_flags, F.lit(None).cast("boolean")).otherwise(st == "F")
        amount = F.when(k % 19 != 0, F.col("o_totalprice").cast("decimal(18,2)"))
        return oc.select(
            k.alias("deal_id"), F.concat(F.lit("Deal "), k.cast("string")).alias("deal_name"),
            F.col("c_mktsegment").alias("pipeline_id"), F.col("o_orderpriority").alias("pipeline_stage_id"),
            F.lower("o_orderpriority").alias("deal_stage"),
            pick(k, ["newbusiness", "existingbusiness", None]).alias("deal_type"),
            amount.alias("amount"), F.lit("USD").alias("deal_currency_code"),
            F.when(k % 17 != 0, F.date_add(F.to_date(created), (k % 90).cast("int"))).alias("close_date"),
            created.alias("create_date"),
            F.when(k % 37 != 0, F.col("c_nationkey").cast("long")).alias("owner_id"),
            (F.col("o_custkey") % 100).alias("associated_company_id"), F.col("o_custkey").alias("associated_contact_id"),
            is_closed.alias("is_closed"), is_won.alias("is_closed_won"),
            F.when(st.isin("F", "P"), k % 90).cast("int").alias("days_to_close"),
            pick(k, ["ORGANIC_SEARCH", "PAID_SEARCH", "REFERRALS", None]).alias("hs_analytics_source"),
            F.when(k % 3 != 0, (k % 10) * 10).cast("decimal(5,2)").alias("hs_deal_stage_probability"),
            F.when(k % 11 == 0, amount * d("0.5")).cast("decimal(18,2)").alias("hs_projected_amount"),
            F.when(k % 4 != 0, amount).cast("decimal(18,2)").alias("hs_acv"),
            F.when(k % 5 != 0, amount).cast("decimal(18,2)").alias("hs_arr"),
            F.when(k % 6 != 0, (k % 500) * d("1.25")).cast("decimal(18,2)").alias("hs_mrr"),
            F.when(k % 7 != 0, amount).cast("decimal(18,2)").alias("hs_tcv"),
            F.when(k % 9 != 0, k % 5).cast("int").alias("num_contacted_notes"), (k % 7).cast("int").alias("num_notes"),
            (k % 101 == 0).alias("_fivetran_deleted"), self._synced().alias("_fivetran_synced"))

    def _stage_pairs(self) -> DataFrame:
        return self._orders_x_customer().select(F.col("o_orderpriority").alias("stage_id"),
                                                F.col("c_mktsegment").alias("pipeline_id")).distinct()

    def _build_deal_stage(self):
        p = self._stage_pairs()
        order = F.substring("stage_id", 1, 1).cast("int")
        return p.select(
            "stage_id", "pipeline_id", F.substring_index("stage_id", "-", -1).alias("label"),
            order.alias("display_order"), (order * 15).cast("decimal(5,2)").alias("probability"),
            (order >= 4).alias("is_closed"), (order == 4).alias("is_closed_won"),
            self._ts("2023-01-01 00:00:00").alias("created_at"), self._ts("2023-01-02 00:00:00").alias("updated_at"),
            ((F.col("pipeline_id") == "HOUSEHOLD") & (F.col("stage_id") == "2-HIGH")).alias("_fivetran_deleted"),
            self._synced().alias("_fivetran_synced"))

    def _build_deal_pipeline(self):
        p = self.raw("customer").select(F.col("c_mktsegment").alias("pipeline_id")).distinct()
        return p.select(
            "pipeline_id", F.concat(F.initcap("pipeline_id"), F.lit(" Pipeline")).alias("label"),
            F.length("pipeline_id").alias("display_order"),
            self._ts("2023-01-01 00:00:00").alias("created_at"), self._ts("2023-01-02 00:00:00").alias("updated_at"),
            F.lit(False).alias("_fivetran_deleted"), self._synced().alias("_fivetran_synced"))

    _PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

    def _build_deal_stage_history(self):
        oc = self._orders_x_customer()
        k = F.col("o_orderkey")
        h = oc.select("o_orderkey", "c_mktsegment", self._deal_created().alias("_created"),
                      F.explode(F.sequence(F.lit(1), (F.lit(1) + k % 4).cast("int"))).alias("_i"))
        i = F.col("_i")
        return h.select(
            F.col("o_orderkey").alias("deal_id"), pick(k + i, self._PRIORITIES).alias("stage_id"),
            self._plus(F.col("_created"), hours=(i * 36).cast("int")).alias("timestamp"),
            F.col("c_mktsegment").alias("pipeline_id"), F.lit("CRM_UI").alias("source"),
            F.lit(None).cast("string").alias("source_id"), self._synced().alias("_fivetran_synced"))

    # email ----------------------------------------------------------------------
    def _events(self) -> DataFrame:
        return self.raw("events").select("event_id", "ts", "user_id", "event_type", "value")

    @staticmethod
    def _email_type(e: Column) -> Column:
        r, blk = e % 20, (e - e % 20) / 20
        return (F.when(r <= 5, "SENT").when(r <= 10, "DELIVERED").when(r <= 13, "OPEN").when(r <= 15, "CLICK")
                .when(r == 16, "BOUNCE").when(r == 17, "UNSUBSCRIBED")
                .when(r == 18, pick(blk.cast("long"), ["SPAMREPORT", "DROPPED"]))
                .otherwise(pick(blk.cast("long"), ["DEFERRED", "FORWARD", "PRINT"])))

    def _build_email_campaign(self):
        ids = self._events().select(((F.col("event_id") - F.col("event_id") % 10) / 10 % 20).cast("long")
                                    .alias("campaign_id")).distinct()
        k = F.col("campaign_id")
        return ids.select(
            k, F.lit(42).cast("long").alias("app_id"), pick(k, ["Marketing Hub", "Sales Hub"]).alias("app_name"),
            (k * 100).alias("content_id"), F.concat(F.lit("Subject "), k.cast("string")).alias("subject"),
            F.when(k != 7, F.concat(F.lit("Email Campaign "), k.cast("string"))).alias("name"),
            pick(k, ["BATCH_EMAIL", "AB_EMAIL", "AUTOMATED_EMAIL"]).alias("type"),
            F.when(k % 6 != 0, k * 100).cast("int").alias("num_included"), (k % 3).cast("int").alias("num_queued"),
            (k == 13).alias("_fivetran_deleted"), self._synced().alias("_fivetran_synced"))

    def _build_email_event(self):
        ev = self._events()
        e = F.col("event_id")
        typ = self._email_type(e)
        return ev.select(
            e.cast("string").alias("event_id"),
            F.when(e % 47 != 0, ((e - e % 10) / 10 % 20).cast("long")).alias("email_campaign_id"),
            F.when(e % 53 != 0, F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("recipient"),
            typ.alias("type"), F.col("ts").alias("created_at"), F.col("ts").alias("sent_by_created_at"),
            F.lit(42).cast("long").alias("app_id"), F.lit(7).cast("long").alias("portal_id"),
            pick(e, ["Chrome", "Safari", "Firefox"]).alias("browser_name"), F.lit("1.0").alias("browser_version"),
            pick(e, ["MOBILE", "DESKTOP", "TABLET"]).alias("device_type"),
            F.lit(None).cast("string").alias("location_city"), F.lit(None).cast("string").alias("location_state"),
            pick(F.col("user_id"), ["US", "DE", "FR", None]).alias("location_country"),
            F.when(typ == "CLICK", F.concat(F.lit("https://x.example/"), (e % 7).cast("string"))).alias("url"),
            F.lit(None).cast("long").alias("link_id"), F.lit(None).cast("string").alias("user_agent"),
            F.lit(None).cast("string").alias("ip_address"), F.lit(None).cast("int").alias("duration"),
            F.lit(None).cast("string").alias("response"),
            F.when((typ == "BOUNCE") & (e % 3 == 0), F.lit("HARD")).alias("bounce_category"),
            F.lit(None).cast("string").alias("drop_reason"), F.lit(None).cast("string").alias("drop_message"),
            F.lit(None).cast("long").alias("subscription_id"), F.lit(None).cast("string").alias("caused_by_event_id"),
            self._synced().alias("_fivetran_synced"))

    def _build_email_event_bounce(self):
        ev = self._events()
        e = F.col("event_id")
        b = ev.filter((self._email_type(e) == "BOUNCE") & (e % 2 == 0))
        return b.select(e.cast("string").alias("event_id"), pick(e, ["HARD_BOUNCE", "SOFT_BOUNCE"]).alias("category"),
                        F.concat(F.lit("smtp "), (e % 500).cast("string")).alias("response"),
                        pick(e, ["BOUNCED", "BLOCKED", None]).alias("status"), self._synced().alias("_fivetran_synced"))

    def _build_email_event_click(self):
        ev = self._events()
        e = F.col("event_id")
        c = ev.filter((self._email_type(e) == "CLICK") & (e % 4 != 0))
        return c.select(e.cast("string").alias("event_id"),
                        F.concat(F.lit("https://click.example/"), (e % 5).cast("string")).alias("url"),
                        F.lit("Chrome").alias("browser"), F.lit(None).cast("string").alias("ip_address"),
                        F.lit(None).cast("string").alias("location"), F.lit(None).cast("string").alias("user_agent"),
                        self._synced().alias("_fivetran_synced"))

    # engagements ----------------------------------------------------------------
    _ENGAGEMENT_TYPES = {"view": "CALL", "click": "EMAIL", "signup": "MEETING", "purchase": "TASK", "error": "NOTE"}

    def _eng_type(self) -> Column:
        t = F.col("event_type")
        out = None
        for src, dst in self._ENGAGEMENT_TYPES.items():
            out = F.when(t == src, F.lit(dst)) if out is None else out.when(t == src, F.lit(dst))
        return out

    def _build_engagement(self):
        ev = self._events()
        e = F.col("event_id")
        return ev.select(
            e.alias("engagement_id"), self._eng_type().alias("type"),
            (F.col("ts") - F.expr("INTERVAL 1 HOUR")).alias("created_at"), F.col("ts").alias("last_updated"),
            F.when(e % 89 != 0, F.col("ts")).alias("timestamp"),
            F.when(e % 41 != 0, F.col("user_id") % 25).alias("owner_id"), F.lit(7).cast("long").alias("portal_id"),
            F.when(e % 13 == 0, F.lit(None).cast("boolean")).otherwise(e % 17 != 0).alias("active"),
            (e % 97 == 0).alias("_fivetran_deleted"), self._synced().alias("_fivetran_synced"))

    def _build_engagement_contact(self):
        ev = self._events()
        e, u = F.col("event_id"), F.col("user_id")
        pairs = F.when(e % 3 == 0, F.array(u, u + 1)).otherwise(F.array(u))
        return ev.select(e.alias("engagement_id"), F.explode(pairs).alias("contact_id"),
                         self._synced().alias("_fivetran_synced"))

    def _build_engagement_company(self):
        ev = self._events()
        e, u = F.col("event_id"), F.col("user_id")
        pairs = F.when(e % 5 == 0, F.array(u % 10, u % 10 + 10)).otherwise(F.array(u % 10))
        return ev.select(e.alias("engagement_id"), F.explode(pairs).alias("company_id"),
                         self._synced().alias("_fivetran_synced"))

    def _build_engagement_deal(self):
        ev = self._events().filter(F.col("event_id") % 2 == 0)
        return ev.select(F.col("event_id").alias("engagement_id"), F.col("event_id").alias("deal_id"),
                         self._synced().alias("_fivetran_synced"))

    def _build_engagement_call(self):
        ev = self._events()
        e = F.col("event_id")
        c = ev.filter((F.col("event_type") == "view") | (e % 10 == 1))
        return c.select(
            e.alias("engagement_id"), F.lit("call notes").alias("body"),
            pick(e, ["connected", "no answer", "busy", None, "Unknown"]).alias("disposition"),
            F.when(e % 6 != 0, (F.col("value").cast("decimal(18,2)") * 1000).cast("long"))
            .otherwise(F.lit(0).cast("long")).alias("duration_milliseconds"),
            F.lit(None).cast("string").alias("external_account_id"), F.lit(None).cast("string").alias("external_id"),
            F.lit("+1-000").alias("from_number"), F.concat(F.lit("+1-"), (e % 1000).cast("string")).alias("to_number"),
            F.when(e % 2 == 0, F.concat(F.lit("https://rec.example/"), e.cast("string"))).alias("recording_url"),
            pick(e, ["COMPLETED", "NO_ANSWER", "BUSY"]).alias("status"), self._synced().alias("_fivetran_synced"))

    def _build_engagement_meeting(self):
        ev = self._events().filter(F.col("event_type") == "signup")
        e = F.col("event_id")
        return ev.select(
            e.alias("engagement_id"), F.lit("meeting notes").alias("body"),
            F.concat(F.lit("Meeting "), e.cast("string")).alias("title"), F.col("ts").alias("start_time"),
            F.when(e % 7 != 0, self._plus(F.col("ts"), minutes=(e % 90).cast("int"))).alias("end_time"),
            F.lit(None).cast("string").alias("internal_meeting_notes"), F.lit(None).cast("string").alias("external_url"),
            pick(e, ["SCHEDULED", "COMPLETED", "CANCELED", "NO_SHOW", "RESCHEDULED", None]).alias("meeting_outcome"),
            self._synced().alias("_fivetran_synced"))

    def _build_engagement_email(self):
        ev = self._events().filter(F.col("event_type") == "click")
        e = F.col("event_id")
        return ev.select(
            e.alias("engagement_id"), F.lit("email body").alias("body"),
            F.concat(F.lit("Re: offer "), (e % 30).cast("string")).alias("subject"),
            F.lit("rep@example.com").alias("from_email"), F.lit("Rep").alias("from_first_name"),
            F.lit("One").alias("from_last_name"), F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("@mail.example")).alias("to_email"),
            F.lit(None).cast("string").alias("cc_email"), F.lit(None).cast("string").alias("bcc_email"),
            F.lit("rep@example.com").alias("sender_email"), F.lit(None).cast("string").alias("tracker_key"),
            self._synced().alias("_fivetran_synced"))

    def _build_engagement_task(self):
        ev = self._events().filter(F.col("event_type") == "purchase")
        e = F.col("event_id")
        st = pick(e, ["COMPLETED", "NOT_STARTED", "IN_PROGRESS", "WAITING"])
        return ev.select(
            e.alias("engagement_id"), F.lit("task body").alias("body"),
            F.concat(F.lit("Follow up "), e.cast("string")).alias("subject"), st.alias("status"),
            F.lit("CONTACT").alias("for_object_type"), pick(e, ["CALL", "EMAIL", "TODO"]).alias("task_type"),
            pick(e, ["HIGH", "MEDIUM", "LOW", None]).alias("priority"),
            F.when(st == "COMPLETED", self._plus(F.col("ts"), days=F.lit(1))).alias("completion_date"),
            self._synced().alias("_fivetran_synced"))
