"""cartwheel: a Spark-native recommendation analytics library.

Batch operators live in ``cartwheel.operators``, table loaders and file
connectors in ``cartwheel.sources``, reusable column expressions in
``cartwheel.functions``, the registered queries (with their DuckDB oracle
SQL) in ``cartwheel.plans`` and Structured Streaming jobs in
``cartwheel.streaming``.
"""

__version__ = "0.1.0"
