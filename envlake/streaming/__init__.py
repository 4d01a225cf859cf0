"""Structured Streaming ingest: topic/file source -> validate -> dead letters ->
idempotent upsert in ``foreachBatch`` (2.A, 2.B, 2.N)."""
