"""Readers and writers of message logs."""
