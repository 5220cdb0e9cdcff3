"""layerflow: landing → bronze → silver → gold pipelines as Spark DataFrame jobs.

Subpackages: ``functions`` (schemas, lineage columns), ``operators`` (per-key
dedup, SCD from change feeds and snapshots, nested flatten), ``sources`` (file
ingest, landing preparation, table scans), ``streaming`` (incremental SCD) and
``plans`` (gold SQL files, the control-table runner, registered queries).
"""

__version__ = "0.1.0"
