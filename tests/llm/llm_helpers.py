"""What the tests of the text operators share besides fixtures."""

from __future__ import annotations

FOLDER = "/root/testdata/sf0.001"

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that the operators use themselves.
CLASHING = ("id", "key", "row", "root", "rest", "group", "position", "slot", "placed_id", "gone_id", "_id", "_n", "_low", "own_sha",
            "text_sha256", "signature", "shingles", "rank", "size", "kept", "score")

PROSE = {
    "en": "the river rose in the night and by morning the lower road was gone so people came out to look at the water",
    "de": "der fluss stieg in der nacht und am morgen war die untere strasse weg also kamen die leute heraus um zu schauen",
}


def long_text(words: int, seed: int = 0) -> str:
    return " ".join(f"w{(i * 7919 + seed) % 100_003}" for i in range(words))


AWKWARD = [
    (1, PROSE["en"], "en", "a", 5),
    (2, PROSE["en"].replace(" ", "  \n"), "en", "a", 5),
    (3, PROSE["de"], "de", "b", 5),
    (4, None, None, None, None),
    (5, "", "en", "b", 0),
    (6, " \t\n ", None, "b", 3),
    (7, long_text(30_000), "en", "a", 1),
    (8, long_text(30_000), "en", None, 1),
    (9, "one", "en", "a", 1),
    (9, "one", "en", "a", 1),
    (10, "x" * 3000, "en", "a", 1),
    (None, "a text without an id", "en", "a", 1),
    (None, "one", "en", "a", 1),
    (11, "日本語 𝒳 ▁ é ß İ", "xx", "c", 1),
]


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
