"""Structured Streaming paths (see streaming/ingest.py): ingest, freshest-wins
upsert with rollup maintenance, tumbling counts."""
