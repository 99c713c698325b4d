"""Relational operators of the detector, written with DataFrame built-ins."""
