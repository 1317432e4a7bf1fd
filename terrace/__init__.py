"""terrace: a property-sales medallion warehouse on Spark.

Layers: ``sources`` (files, landing zone, fixtures) -> ``plans.silver`` ->
``plans.gold`` (star schema) -> ``plans.marts`` (mart and reports), with
``operators`` (validity join, keyed upsert, incremental loads, reference
counts, quality checks, conformance), ``sinks`` (versioned tables),
``streaming`` (message publish and consume) and ``plans.pipeline`` (the
monthly run).  ``catalog`` registers the queries checked against SQL.
"""

__version__ = "0.1.0"
