"""gazette: media and audience analytics as Spark DataFrame jobs.

Layers: ``sources`` (loads, fixture mapping, export) -> ``operators``
(curate, aggregates, sessions, marts, masking, metrics, churn, change feed)
-> ``streaming`` (continuous refresh) ; ``plans`` wires named queries.
"""

__version__ = "0.1.0"
