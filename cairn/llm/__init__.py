"""Training-data operators: mixing, token files, PII, URL reputation, nearest
neighbours, language ID, BPE, language-model scoring, near duplicates, quality.

Nothing else in the library imports this subpackage.
"""
