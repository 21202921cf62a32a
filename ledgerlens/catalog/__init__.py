"""Registered queries over the test tables, with equivalent SQL."""
