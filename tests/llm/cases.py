"""Small tables for the edge cases every operator must handle."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use for their own columns.
CLASH = ("score", "key", "size", "slot", "turn", "block", "spans", "ids", "rep", "row", "sketch", "_key", "label")

LONG = " ".join(f"w{k % 997}" for k in range(20_000))

ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "a"),
    (5, "one two three"),
    (5, "one two three"),
    (6, "one two three"),
    (7, LONG),
    (8, LONG),
    (None, "no id at all"),
    (None, None),
    (9, "  double  blanks <|endoftext|> éß中 \U0001f642 \x00"),
    (-10, "negative id"),
]


def docs(spark, rows, partitions=3):
    """Documents of (id, text) or (id, text, source) with columns of clashing names beside them."""
    full = [
        (r[0], r[1], "en" if k % 3 else None, r[2] if len(r) > 2 else f"src{k % 3}", None if r[1] is None else len(r[1]))
        for k, r in enumerate(rows)
    ]
    frame = spark.createDataFrame(full, DOCS)
    from pyspark.sql import functions as F

    for name in CLASH:
        frame = frame.withColumn(name, F.lit("clash"))
    return frame.repartition(partitions) if rows else frame


def texts(seed: int, count: int, words: int = 60, vocabulary: int = 400) -> list[str]:
    rng = random.Random(seed)
    known = ["".join(rng.choices("abcdefghijé", k=rng.randint(2, 8))) for _ in range(vocabulary)]
    return [" ".join(rng.choices(known, k=rng.randint(words // 2, words * 2))) for _ in range(count)]
