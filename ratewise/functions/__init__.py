"""Column expressions; all of them are native Catalyst expressions (no UDF)."""

from ratewise.functions.text import (GENRES, genre_slug, multi_hot, release_year,
                                     split_field, tokens)
from ratewise.functions.time import epoch_seconds, year_of_epoch
from ratewise.functions.vectors import clip, dot
from ratewise.functions.json import event_json, well_formed

__all__ = ["GENRES", "genre_slug", "multi_hot", "release_year", "split_field", "tokens",
           "epoch_seconds", "year_of_epoch", "clip", "dot", "event_json", "parse_event"]
