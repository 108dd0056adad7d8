"""Mapping of detailed genre texts to broad genres."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Broad genre and the texts that lead to it. The first match wins.
GENRE_RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("News", ("Current Affairs", "News", "Politic", "Prime Ministerial")),
    ("Children's", ("Children",)),
    ("Drama", ("Drama",)),
    ("Entertainment", ("Light Ent", "Outside Broadcast", "Opt Outs")),
    ("Factual", ("Features / Factual", "General Programmes")),
    ("Learning", ("Education", "Schools", "Language")),
    ("Music", ("Music", "Dance")),
    ("Religion & Ethics", ("Religio",)),
    ("Sport", ("Sport",)),
    ("Comedy", ("Comedy", "Sitcom", "Sit Com")),
)


def map_genre(
    genre: Column, rules: Sequence[tuple[str, Sequence[str]]] = GENRE_RULES
) -> Column:
    """Broad genre of a text by the first rule with a contained text, else NULL."""
    mapped = F.lit(None).cast("string")
    for broad, texts in reversed(rules):
        found = reduce(Column.__or__, [genre.contains(text) for text in texts])
        mapped = F.when(found, F.lit(broad)).otherwise(mapped)
    return mapped
