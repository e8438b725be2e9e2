"""Readers, sinks, dataset layout, the commit log and incremental landing."""
