"""Every operator as a named query over the test tables, with its SQL counterpart."""

from fareloom.registry.entries import Entry, entries

__all__ = ["Entry", "entries"]
