"""SQL-text forms of the detector and plan inspection helpers."""

from clickguard.plans.sql import find_incidents_sql

__all__ = ["find_incidents_sql"]
