"""Readers: raw tables, landed payloads and the test-table adapter."""
