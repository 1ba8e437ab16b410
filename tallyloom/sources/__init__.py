"""Readers, statistical-JSON flatteners and sinks."""
