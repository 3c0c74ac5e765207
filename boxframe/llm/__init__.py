"""Operators for training-data pipelines over text tables (documents, pages, conversations).

Nothing else in ``boxframe`` imports this subpackage."""
