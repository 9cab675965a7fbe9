"""ledgerloom — backup-report and consent-analytics mart on PySpark.

Every public function takes and returns DataFrames; nothing is collected to the
driver. Layout:

* ``sources``   — readers for report CSVs, page-view JSON, backup logs, file listings
* ``functions`` — Column-level scalar rules (status, component, host, periods, sizes)
* ``operators`` — report normalisation, log sessions, reporting views, load checks
* ``sinks``     — catalog tables: create, append by name, insert by position, overwrite
* ``plans``     — end-to-end jobs and the query registry used by ``__spark_entry__``
* ``streaming`` — incremental (available-now) variant of the daily file loads
"""

__version__ = "0.1.0"
