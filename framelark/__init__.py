"""Framelark: DataFrame operators that turn shards of nested media records into labelled training rows."""
