"""Composite plans: the public entry points of the engine."""

from gridmeter.plans.usage_tables import usage_from_tables

__all__ = ["usage_from_tables"]
