"""feedline — registry-driven incremental file ingestion on Apache Spark.

Each feed is described by rows in control tables (where to read, which format,
which schema, how to react to drift, how to write).  One generic Structured
Streaming job lands new files exactly once, keeps off-schema values in
``_rescued_data``, stamps every row with its origin and logs every run.
"""

from feedline.workspace import Workspace, shared_root

__all__ = ["Workspace", "shared_root"]
