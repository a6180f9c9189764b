"""Registered queries with the SQL each is checked against."""

from vecquery.registry import answers, metrics, results, search, streams

ENTRIES = {**search.ENTRIES, **answers.ENTRIES, **results.ENTRIES, **metrics.ENTRIES, **streams.ENTRIES}
