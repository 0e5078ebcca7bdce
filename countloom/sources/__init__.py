"""Readers and writers: every reader returns a lazy DataFrame."""
