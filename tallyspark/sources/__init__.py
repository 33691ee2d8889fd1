"""Inputs: declared schemas, testdata-derived raw tables, landing, shard scans."""
