"""``DataFrame -> DataFrame`` operators, each usable with ``df.transform``."""
