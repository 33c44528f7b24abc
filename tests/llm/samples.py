"""Small documents with every odd case: nulls, empty and long texts, ties, repeated rows, columns of clashing names."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside.
CLASHES = ("size", "shard", "slot", "id", "key", "n", "node", "root", "rank", "copies", "row", "words", "kept", "score", "text_hash", "_kept", "item_id", "u")


def prose(words: int, seed: int) -> str:
    """Words of two to four syllables, no two texts alike."""
    rng = random.Random(seed)
    parts = "ba ce di fo gu ka le mi no pu ra se ti vo zu".split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(2, 4))) for _ in range(words))


def odd_documents(spark):
    """Odd rows, with an extra column for each clashing name."""
    one, two = prose(120, 1), prose(90, 2)
    near = one.split()
    near[60] = "changed"
    rows = [
        (1, one, "en", "a", 1), (2, " ".join(near), "en", "a", 1), (3, one, "de", "b", 1), (3, one, "de", "b", 1), (3, two, "de", None, 1),
        (4, two, None, "b", None), (5, None, "en", "a", 0), (6, "", "en", None, 0), (7, " \t\n ", None, None, 3), (8, "12 34 !!", "en", "c", 8),
        (None, prose(40, 3), "fr", "c", 1), (None, None, None, None, None), (9, "ba", "fr", "c", 2), (10, prose(60_000, 4), "fr", "c", 1),
        (11, "ba " * 30_000, "en", "a", 1), (12, "a" * 20_000, "en", "a", 1), (13, "naïve ünïcode 漢字 " * 9, "fr", "a", 1),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in CLASHES:
        docs = docs.selectExpr("*", f"'x' AS `{name}`")
    return docs


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)
