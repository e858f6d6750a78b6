"""Category vocabularies of the feature tables (fixed values)."""

from __future__ import annotations

from dataclasses import dataclass

# The order gives the order of the feature columns.
GENRES = (
    "Action", "Adventure", "Comedy", "Drama", "Fantasy", "Romance",
    "Sci-Fi", "Slice of Life", "Sports", "Supernatural", "Mystery",
    "Horror", "Psychological", "Thriller", "Mecha", "Music", "School",
    "Shounen", "Shoujo", "Seinen", "Josei", "Ecchi", "Harem",
    "Isekai", "Military", "Historical", "Demons", "Magic", "Super Power",
    "Vampire",
)
TYPES = ("TV", "Movie", "OVA", "ONA", "Special", "Music")
SOURCES = (
    "Manga", "Original", "Light novel", "Visual novel", "Game",
    "Novel", "Web manga", "4-koma manga", "Other",
)
AGE_RATINGS = (
    "G - All Ages", "PG - Children", "PG-13 - Teens 13 or older",
    "R - 17+ (violence & profanity)", "R+ - Mild Nudity", "Rx - Hentai",
)
STUDIOS = (
    "Toei Animation", "Madhouse", "Sunrise", "J.C.Staff", "A-1 Pictures",
    "Bones", "Production I.G", "Studio Pierrot", "MAPPA", "Kyoto Animation",
    "ufotable", "Wit Studio", "CloverWorks", "Studio Ghibli", "Shaft",
    "TMS Entertainment", "OLM", "Brain's Base", "Doga Kobo", "P.A. Works",
)


@dataclass(frozen=True)
class BehaviourVocabulary:
    """Genres and types counted per user, and how a genre is looked up in the list text."""

    genres: tuple[str, ...]
    types: tuple[str, ...]
    ignore_case: bool = False


FULL_VOCABULARY = BehaviourVocabulary(GENRES, TYPES)
COMPACT_VOCABULARY = BehaviourVocabulary(GENRES[: GENRES.index("Harem") + 1], TYPES[:5], ignore_case=True)
