"""Readers and writers of tables and topics."""
