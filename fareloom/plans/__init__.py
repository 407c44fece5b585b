"""Choices about how work runs at scale: shared pre-aggregates, checked broadcasts, SQL reports."""
