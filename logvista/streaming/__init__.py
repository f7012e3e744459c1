"""Streams of landed audit records. The batch operators over whole sequences stay batch: their frames need closed files."""
