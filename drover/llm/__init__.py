"""Operators for training-data preparation: token counts, packing, quality rules, URL
filters, deduplication, language identification and decontamination.

Nothing outside this package imports it; ``queries.py`` lists the registered queries.
"""
