"""Training-data operators (dedup, scans, filters, packing, token output).

Nothing outside this package imports it; ``__spark_entry__`` adds its
queries when it is present.
"""
