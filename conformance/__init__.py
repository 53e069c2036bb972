"""Checks of the library on the star-schema test tables: adapter, query registry, SQL oracle."""
