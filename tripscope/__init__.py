"""tripscope: trip analytics as PySpark DataFrame operators.

Every operator takes DataFrames plus parameters (columns, thresholds,
windows, k) and returns a lazy DataFrame; Catalyst and adaptive execution
pick the physical plan.  Sub-packages:

- ``sources``   - driver tables, the trip/zone shapes laid over them,
                  CSV scans, the prepared day-partitioned Parquet store
- ``functions`` - column expressions shared by operators (bands, buckets,
                  haversine, airport flag, surcharges) and the one UDF
- ``operators`` - the job operators, one module per question
- ``plans``     - size-checked broadcast and plan inspection helpers
- ``streaming`` - incremental preparation of raw trip files
"""

from tripscope.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
