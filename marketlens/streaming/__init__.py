"""Incremental refresh of the daily marts from append-only synced sources."""
from .refresh import OverlayTables, rebuild_daily_mart, refresh_daily_mart

__all__ = ["OverlayTables", "rebuild_daily_mart", "refresh_daily_mart"]
