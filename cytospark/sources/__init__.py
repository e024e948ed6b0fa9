"""Readers, sinks, contracts and manifests."""
