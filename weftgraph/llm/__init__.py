"""Operators of a training-data pipeline (chat, packing, quality, token files, mixing, counts, URLs, licences, dedup).

Nothing else in the library imports this subpackage.
"""
