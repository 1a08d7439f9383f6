"""Training-data operators: archives, mixing, search, packing, extraction,
near-duplicates, quality, toxicity, language and chat formatting.

Nothing else in the library imports this subpackage.  Every operator takes and
returns DataFrames; ``queries.py`` holds the registered queries.
"""
