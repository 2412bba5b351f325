"""Readers, table configuration, keyed tables and their incremental reader."""
