"""Operators for preparing training text at scale, each beside its registered query in ``queries``."""
