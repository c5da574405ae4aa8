"""headway: transit-reliability analytics as plain Spark DataFrame operators.

Every public function takes DataFrames/Columns and returns DataFrames/Columns;
nothing is collected to the driver.  Sub-packages:

* ``functions``  column expressions (time, geo, JSON repair, typed compare)
* ``operators``  DataFrame -> DataFrame operators (dedup, bunching, SCD2,
  nearest-in-time join, radius join, top-k, data quality)
* ``sources``    readers and writers (tables, snapshots, JDBC, CSV, JSON, archive,
  message records)
* ``plans``      compositions: silver job, marts, reports, driver-table fixtures
* ``streaming``  Structured Streaming ingest, replay, stream dedup and bunching
"""

__version__ = "0.1.0"
