"""Stages, manifests and registered queries."""
