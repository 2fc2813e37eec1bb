"""Training-data operators for very large text tables.

Nothing else in the library imports this subpackage.
"""
