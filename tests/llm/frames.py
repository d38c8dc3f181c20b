"""Small inputs for the operators, among them the cases every one of them must take."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size string, node int, doc string, "
    "shard string, `a.b` int, kept string, bucket string, line int"
)
EXTRA = ("big", 1, "d", "s", 2, "k", "b", 3)


def words(seed: int, n: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    return " ".join(f"{'abcdefghij'[r.randrange(10)]}w{'klmnopqrst'[r.randrange(10)]}{'uvyz'[r.randrange(vocabulary) // 100]}x" for _ in range(n))


def messy_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows and clashing columns."""
    long = "\n".join(words(900 + i, 12) for i in range(3000))
    rows = [(i, words(i, 30 + i), "en", f"s{i % 3}", 1, *EXTRA) for i in range(12)]
    rows += [
        (100, None, "en", "s0", None, *EXTRA),
        (101, "", None, None, 0, *EXTRA),
        (102, "   \n\t ", "en", "s1", 5, *EXTRA),
        (103, "!!! ???", "de", "s1", 7, *EXTRA),
        (None, words(50, 20), "en", "s2", 3, *EXTRA),
        (None, words(51, 20), None, None, None, *([None] * len(EXTRA))),
        (None, None, None, None, None, *([None] * len(EXTRA))),
        (104, long, "en", "s2", len(long), *EXTRA),
        (105, words(3, 33), "en", "s0", 1, *EXTRA),  # the text of row 3
        (1, words(1, 31), "en", "s1", 1, *EXTRA),  # row 1 again
        (1, words(1, 31), "en", "s1", 1, *EXTRA),
        (106, "ünï 😀 wörd 😀😀 ёлка", "ru", "sé", 9, *EXTRA),
    ]
    return rows


def messy(spark):
    return spark.createDataFrame(messy_rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
