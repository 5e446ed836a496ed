"""Readers and writers: manifests, payloads, sample shards and tar shards."""
