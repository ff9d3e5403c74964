"""fincrime: Spark-native operators and reports for financial-crime and
collections work over a bank's star-schema warehouse.

Layout
------
sources/    reading tables (warehouse catalogue, driver tables, derived views), sinks
functions/  Column-level helpers: pinned null/cast semantics, labels
operators/  DataFrame -> DataFrame building blocks (snapshots, lookups, matching)
plans/      the ten parameterised reports and the keyed fixture queries
streaming/  intentionally empty: the reports are batch only
"""

__version__ = "0.1.0"
