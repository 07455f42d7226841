"""tremor: a Spark-native engine for seismic event catalogues.

Raw event files land as strings, are cleaned into a typed catalogue, and every
catalogue question is a plain ``DataFrame -> DataFrame`` function that Catalyst
plans.  Sub-packages:

* ``sources``   readers, writers and the test-table fixture
* ``functions`` column-expression helpers (parsing, geometry, display values)
* ``operators`` catalogue operators (cleaning, statistics, trends, geo, ML)
* ``plans``     the named query catalogue, its DuckDB oracles, the batch job
* ``streaming`` the same cleaning step as an incremental Structured Streaming job
"""

__version__ = "0.1.0"
