"""Readers and writers: landing folders, captures, list envelopes, Bronze appends, upserts, marts."""
