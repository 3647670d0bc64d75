"""Streams over landed messages; every batch runs the same operators as the batch jobs."""
