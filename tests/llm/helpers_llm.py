"""Odd documents and frames with clashing columns for the corpus operators."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `row` string, `base` string, tokens string, topic string, weight string, c0 string, `has.dot` string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(seed: int, n: int, vocabulary: int = 3000) -> str:
    rnd = random.Random(seed)
    return " ".join(f"{rnd.choice('abcdefgh')}{rnd.randrange(vocabulary):x}{rnd.choice(['', ',', '.', 'é'])}" for _ in range(n))


def odd_texts() -> list[tuple[int | None, str | None]]:
    """Nulls, empty, blank, very long, repeated, tied and near-equal texts."""
    long, line = prose(1, 40_000), "The very same line that many of the documents hold, again and again."
    base = prose(2, 300).split(" ")
    near = []
    for k in range(40):
        words = list(base)
        words[(k * 7) % 300] = f"edit{k}"
        near.append(" ".join(words))
    rows = [(1, None), (2, ""), (3, "  \n\t "), (None, prose(3, 80)), (None, None), (4, long), (5, "one"), (6, "one"), (7, "Two words"), (8, "two WORDS"),
            (9, "a\x00b \x00\x00 c"), (10, "x" * 30_000), (11, "é ü 漢字 \U0001f600 " * 60), (12, prose(4, 200)), (12, prose(4, 200)), (13, prose(4, 200)),
            (14, (line + "\n") * 12), (15, line + " " + prose(5, 90)), (16, line + " " + prose(6, 90)), (17, prose(7, 60) + " " + " ".join(base[:80])),
            (18, "call +1 (614) 555-8001 or mail a.b@c.example.com, card 4111 1111 1111 1111 from 10.0.0.1 not 300.1.1.1")]
    return rows + [(100 + k, t) for k, t in enumerate(near)]


def frame(spark, rows):
    full = [(i, t, None if k % 5 == 0 else "en", None if k % 7 == 0 else f"s{k % 3 if k % 2 else 0}", None, "x", "y", None, "z", "w", None, "d") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)
