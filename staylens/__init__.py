"""staylens — rental-market analytics as composable Spark DataFrame operators.

Layers (each a pure ``DataFrame -> DataFrame`` function, lazily composed so
Catalyst sees one plan per query):

* ``sources``   — bronze schemas, CSV ingest, test-table bindings, sinks
* ``functions`` — column expressions (flags, keys, measures, safe ratios)
* ``operators`` — generic building blocks: upsert, SCD2, temporal join,
                  ranking / latest-per-key, data-quality checks, aggregates
* ``plans``     — the named models: silver, gold, marts, ad-hoc questions,
                  and the month-by-month pipeline
* ``streaming`` — the month ingest as a file-source stream (foreachBatch upsert)
"""

__version__ = "0.1.0"
