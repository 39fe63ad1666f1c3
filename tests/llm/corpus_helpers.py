"""Small document tables for the corpus operators' tests."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows, schema=SCHEMA):
    """rows: (doc_id, text[, lang[, source]])"""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None if r[1] is None else len(r[1]))
            for r in rows]
    return spark.createDataFrame(full, schema)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    words = [f"w{rng.randrange(vocabulary)}x{rng.randrange(9)}" for _ in range(n)]
    out = []
    for i, w in enumerate(words):
        out.append(w + (". " if i % 11 == 10 else " "))
    return "".join(out).strip()


def odd_rows():
    """Nulls in every column, empty and blank texts, repeated rows, a very long text."""
    long_text = prose(99, 60_000)
    return [(1, prose(1, 60)), (1, prose(1, 60)), (None, prose(2, 60)), (None, None), (2, None), (3, ""), (4, " \n\t "),
            (5, long_text), (6, "ÄÖ ß日本語 x"), (7, prose(1, 60), None, None), (8, "a" * 50_000)]
