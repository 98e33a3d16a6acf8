"""Readers, writers and the transaction view over the shared test tables."""
