"""Named marts, dashboard queries, measures and report queries.

Every plan is ``fn(t: Tables, as_of=...) -> DataFrame`` and only composes operators from
``marketlens.operators`` and expressions from ``marketlens.functions``.

Fixed values: the text labels of the rule ladders (tiers, health and status labels,
recommendations), the lifecycle-stage and event-type codes they test, and the documented KPI
thresholds must equal the dashboards' expected outputs.  They are written plainly, in the order
the ladders evaluate them, where each ladder is built.
"""
