"""DataFrame -> DataFrame operators, meant for ``df.transform``."""
