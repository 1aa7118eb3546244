"""Training-data operators: classification, deduplication, extraction, mixing and packing.

Nothing outside this subpackage imports it; ``queries.py`` registers its queries.
"""
