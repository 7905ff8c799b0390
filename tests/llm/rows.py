"""Small document tables with every awkward case."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYLLABLES = ["an", "be", "co", "di", "el", "fu", "go", "hi", "jo", "ka"]
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "score string, held_out string, bucket string, size string, kept string, set_key string"
)


def prose(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(words))


def awkward(seed: int = 1) -> list[tuple]:
    """(doc_id, text): nulls, empties, repeats, ties, a very long text, odd characters."""
    rng = random.Random(seed)
    long = prose(rng, 9000)
    plain = [(100 + i, prose(rng, rng.randint(1, 90))) for i in range(25)]
    return [
        (None, "without an id"),
        (None, None),
        (1, None),
        (2, ""),
        (3, " \t\n\x0b  "),
        (4, "word"),
        (5, "Word"),
        (6, "two words"),
        (7, long),
        (8, long + " more"),
        (9, long),
        (10, "twice"),
        (10, "twice"),
        (11, "é" * 300 + " ﬁ 日本語　テスト 🎉 x y \x1c \x85"),
        (12, "x" * 5000),
        (13, "a\n\na\nb\n a\nb"),
        (14, "<|endoftext|> ▁ <s> <0x0A> a  b   c"),
        (15, "1234 !! $$$ 5"),
        *plain,
        (200, plain[0][1]),
        (201, plain[1][1] + " tail"),
    ]


def frame(spark, rows, parts: int = 3):
    """The rows with further columns, some named like results."""
    full = [
        (i, t, "en", f"s{(i or 0) % 3}" if i != 4 else None, len(t or ""), *["?"] * 6)
        for i, t in rows
    ]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
