"""The flows from sources to tables: ingest, bridge, gold, tiles."""
