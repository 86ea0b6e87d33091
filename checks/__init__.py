"""Operators applied to the driver tables, with equivalent SQL for each."""
