"""The engine's own small lexicon: word classes, and the maps between kinds of items."""

from __future__ import annotations

#: Ordered classes of words; the order decides where a word belongs to several.
CLASSES: dict[str, tuple[str, ...]] = {
    "category": ("film", "series", "music", "audio", "game", "software", "book", "comic", "image", "dataset", "course", "font"),
    "genre_video": ("western", "heist", "slapstick", "detective", "documentary", "travel"),
    "genre_audio": ("polka", "flamenco", "ambient", "bluegrass", "chamber"),
    "genre_text": ("poetry", "cookery", "gardening", "mathematics"),
    "quality_video": ("1080p", "720p", "dvd", "hdtv", "xvid", "x264"),
    "quality_audio": ("flac", "aac", "mp3"),
    "language": ("english", "spanish", "german", "french", "portuguese", "multi"),
}
#: What an item of a category is filed under.
SCHEMA_OF_CATEGORY = {"film": "video", "series": "video", "music": "audio", "audio": "audio", "game": "software", "software": "software", "book": "document", "comic": "document", "image": "image", "dataset": "data", "course": "document", "font": "software"}
SCHEMA_OF_GENRE = {"genre_video": "video", "genre_audio": "audio", "genre_text": "document"}
SCHEMA_OF_QUALITY = {"quality_video": "video", "quality_audio": "audio"}
DEFAULT_SCHEMA = "file"
#: Category that a finer one belongs to.
CATEGORY_OF_SUBCATEGORY = {"feature film": "film", "television series": "series", "animated series": "series", "documentary film": "film", "recorded music": "music", "spoken audio": "audio", "computer game": "game", "application software": "software", "operating system": "software", "electronic book": "book", "comic strip": "comic", "image collection": "image", "research dataset": "dataset", "course material": "course", "font package": "font"}
CATEGORY_OF_GENRE = {"genre_video": "film", "genre_audio": "music", "genre_text": "book"}
#: Words that mean the same; either direction counts.
SYNONYMS = {"film": ("movie", "feature film"), "series": ("television series", "animated series"), "audio": ("spoken audio",), "music": ("recorded music",), "software": ("application software", "operating system")}
#: Ordered rules: a tag is given if the category contains the word.
TAG_RULES = (("film", "moving"), ("series", "moving"), ("series", "episodic"), ("music", "sound"), ("audio", "sound"), ("software", "program"), ("game", "program"), ("book", "reading"), ("comic", "reading"))


def words(*classes: str) -> tuple[str, ...]:
    """All words of classes whose name starts with one of ``classes``, in order."""
    return tuple(w for c, ws in CLASSES.items() if any(c.startswith(x) for x in classes) for w in ws)
