"""Readers, request manifests and stores."""
