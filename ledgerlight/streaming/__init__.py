"""Incremental counting of tables that arrive in files."""
