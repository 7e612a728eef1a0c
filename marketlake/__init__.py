"""marketlake: Spark-native marketing-attribution analytics.

Every operator is a pure function ``DataFrame(s), parameters -> DataFrame``;
nothing is collected on the data path. Sub-packages:

* ``functions``  column expressions (normalisation, lenient casts, calendars)
* ``sources``    table adapters, file scans (JSON, CSV, tool-response text), sinks
* ``operators``  silver rebuilds, source reconciliation, gold, marts, reports, checks
* ``plans``      ordered pipelines (warehouse build, incremental run, gold refresh)
* ``streaming``  Structured Streaming landing + incremental recompute
"""

__version__ = "0.1.0"
