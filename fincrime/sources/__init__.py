"""Reading and writing: warehouse catalogue, driver tables, derived views, sinks."""

from fincrime.sources.catalog import Warehouse
from fincrime.sources.driver import DriverTables

__all__ = ["Warehouse", "DriverTables"]
