"""Landed files as a stream: the batch steps, fed by newly arriving files."""
