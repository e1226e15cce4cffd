"""tidewater: data-pipeline operators on Spark DataFrames, SQL and Structured Streaming.

Every operator takes DataFrames (or paths) plus column names as parameters and
returns a DataFrame, so the same operator serves its own domain and the driver
tables.  Sub-packages:

* ``functions``  pure Column expressions (cleaning, typing, parsing)
* ``operators``  relational building blocks, star schemas, quality gates, CDC
* ``sources``    readers, writers and catalog helpers
* ``streaming``  file-source streams, windowed counts, monitors
* ``plans``      stand-in datasets, the four flows and the query registry
"""

from tidewater.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
