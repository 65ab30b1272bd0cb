"""Queries over the supplied test tables, with equivalent SQL."""
