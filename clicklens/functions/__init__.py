"""Column expressions: text repair, clock arithmetic, genre mapping."""

from clicklens.functions.clock import wrap_duration
from clicklens.functions.genre import GENRE_RULES, map_genre
from clicklens.functions.text import (
    expand_sci_text,
    merged_page_url,
    merged_previous_page,
    strip_marks,
)

__all__ = [
    "GENRE_RULES",
    "expand_sci_text",
    "map_genre",
    "merged_page_url",
    "merged_previous_page",
    "strip_marks",
    "wrap_duration",
]
