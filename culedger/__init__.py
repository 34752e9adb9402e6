"""culedger: compute-consumption analytics as Spark DataFrame jobs.

Layers
------
- ``sources``   : readers for the driver tables, the fixture derivation of
                  silver inputs, staged-batch IO, the model-version adapter,
                  date spines / work lists and the per-unit fan-out.
- ``functions`` : column expressions (synthetic ids, window bounds,
                  half-minute predicates, exact CU sums).
- ``operators`` : DataFrame -> DataFrame operators (filters, dedupe, keyed
                  upsert, aggregates, running totals, joins, unions).
- ``plans``     : compositions: gold build, analysis patterns, table
                  snapshots, checks and the end-to-end pipeline.
- ``streaming`` : Structured Streaming form of the stage-then-merge ingest.
"""

from culedger.schemas import K7  # noqa: F401

__version__ = "0.1.0"
