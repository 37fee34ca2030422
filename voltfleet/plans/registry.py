"""All queries of the fleet library and their SQL."""

from __future__ import annotations

from . import behaviour, cleaning, decisions, events, feeds, incremental, joins, models, monthly, quality, series, soh

BOOKS = [cleaning.book, events.book, monthly.book, series.book, soh.book, joins.book, quality.book, decisions.book, behaviour.book, models.book, incremental.book, feeds.book]

QUERIES = {name: query for b in BOOKS for name, query in b.queries.items()}
ORACLE = {name: text for b in BOOKS for name, text in b.oracle.items()}
