"""Bridge fan-out: the weighted form equals aggregating over the literal cartesian join."""
import datetime as dt
from decimal import Decimal

from marketlens.plans.engagements import with_fanout
from marketlens.sources.catalog import Tables


def test_one_call_two_contacts_three_companies(spark):
    ts = dt.datetime(2024, 1, 10, 9, 0)
    eng = spark.createDataFrame([(1, "CALL", ts, 5, False)],
                                "engagement_id long, type string, timestamp timestamp_ntz, owner_id long, _fivetran_deleted boolean")
    ec = spark.createDataFrame([(1, 100), (1, 101)], "engagement_id long, contact_id long")
    eco = spark.createDataFrame([(1, 7), (1, 8), (1, 9)], "engagement_id long, company_id long")
    ed = spark.createDataFrame([], "engagement_id long, deal_id long")
    t = Tables(spark, frames={"engagement_contact": ec, "engagement_company": eco, "engagement_deal": ed})
    w = with_fanout(eng, t, ["contact", "company", "deal"]).first()
    assert (w.n_contact, w.n_company, w.n_deal, w._m) == (2, 3, 0, 6)
    # a 60 s call: faithful total = 6 rows x 1 minute, deduplicated = 1 minute
    dur_ms = 60000
    assert Decimal(dur_ms * w._m) / Decimal("60000.0") == 6
