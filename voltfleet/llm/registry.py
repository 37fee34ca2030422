"""The subpackage's queries and their SQL."""

from __future__ import annotations

from . import bpe_codec, conversation_trie, decontaminate, exact_dedup, language, lexical_search, neighbours, secrets, simhash, substrings, token_counts, toxicity, urls

MODULES = [neighbours, language, secrets, simhash, substrings, token_counts, urls, decontaminate, toxicity, bpe_codec, exact_dedup, lexical_search, conversation_trie]

QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLE = {name: sql for m in MODULES for name, sql in m.ORACLE.items()}
