"""Training-data operators: search, language, secrets, duplicates, tokens, urls, leaks, toxicity.

Nothing else in the library imports this subpackage.
"""
