"""Correctness oracles (DuckDB SQL) and a local comparison harness."""
