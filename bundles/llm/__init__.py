"""Operators for preparing training data: tokens, packing, scans, near duplicates, search, archives.

Nothing outside this package imports it; ``__spark_entry__.py`` adds its
queries only when the package is there.
"""
