"""Incremental processing of per-entity files.

The reference has no stream sources, watermarks or stateful operators; its
only "arrival" pattern is new per-entity files landing in a folder.  This
module runs any batch operator over such files incrementally with
Structured Streaming (file source + ``foreachBatch``), so the same
``DataFrame -> DataFrame`` operators apply unchanged to each micro-batch.
"""

from stratum.streaming.entity_files import apply_to_new_entity_files  # noqa: F401
