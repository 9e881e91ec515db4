"""Small tables with the awkward rows every operator must take."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, size long, component_id string"


def documents(spark, rows):
    """documents with extra columns whose names clash with operators' own."""
    data = [(i, t, "en", s, None if t is None else len(t), "x", -1, "y") for i, t, s in rows]
    return spark.createDataFrame(data, SCHEMA)


def awkward(seed=5, n=60):
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    rng = random.Random(seed)
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa Straße café 日本 it's we'll".split()
    rows = [(None, None, None), (None, "no id here at all", "s1"), (1, "", "s1"), (2, None, "s2"), (3, " \n\t ", None), (4, "one", "s2"), (4, "one", "s2")]
    for i in range(10, 10 + n):
        rows.append((i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 60))), f"s{rng.randint(1, 4)}"))
    rows += [(5000 + i, rows[12][1], "s1") for i in range(5)]
    rows.append((5300, "word " * 30000, "s3"))
    rows.append((5301, "x" * 120000, "s3"))
    return rows
