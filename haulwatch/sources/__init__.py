"""Readers: message streams, dimension tables, partitioned tables, raw frames."""
