"""Readers, writers and bindings to the domain tables."""
