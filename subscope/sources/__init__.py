"""Readers and writers: manifests, pageview files, layer tables, mapped input tables."""
