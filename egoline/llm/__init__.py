"""Training-data operators (token counts, joins on near copies, filters, writers).

Nothing else in the library imports this subpackage.
"""
