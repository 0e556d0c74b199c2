"""Source tables: typed readers for real ad/CRM tables and role adapters over driver tables."""
from .catalog import Tables, read_jdbc_tables, read_tables, recent
from .roles import DriverTables, ADS_AS_OF, CRM_AS_OF, LONG_AS_OF

__all__ = ["Tables", "read_tables", "read_jdbc_tables", "recent", "DriverTables", "ADS_AS_OF", "CRM_AS_OF", "LONG_AS_OF"]
