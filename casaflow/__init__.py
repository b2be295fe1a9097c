"""casaflow: a Spark-native batch pipeline for property-investment time series.

Layers (each a sub-package):

* ``sources``   wide monthly CSV scan, relational tables, landing frames
* ``functions`` column expressions (dates, text, investment metrics)
* ``operators`` reshaping, gap filling, geography, facts, keyed merge, panel
* ``sinks``     CSV / Parquet lake / JDBC writers and versioned publication
* ``plans``     landing, cleaning, final load, dashboard and the whole pipeline
* ``streaming`` incremental landing of newly arriving wide files
"""

__version__ = "0.1.0"
