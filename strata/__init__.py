"""strata: layered (bronze / silver / gold) batch analytics as Spark DataFrame operators.

Sub-packages
------------
functions  Column -> Column cleaning, typing and data-quality rules.
operators  DataFrame -> DataFrame building blocks: winner per key, upsert,
           profiles, statistics, lookups.
plans      The compositions a user runs: the three silver builds, the gold
           fact, the audit profile.
sources    Ingest and table I/O (CSV scan, lineage, table writes, schema
           bootstrap) and the raw views derived from the driver tables.
"""

__version__ = "0.1.0"
