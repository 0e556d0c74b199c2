"""DuckDB oracle SQL for every registered query (the correctness gate's reference side).

Kept outside the library: it is test infrastructure, written independently of the Spark
plans, over the same role adapters (``adapters.py``) as ``marketlens.sources.roles``.
"""
