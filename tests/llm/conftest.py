import random

import pytest
from paths import FOLDER
from pyspark.sql import types as T

# Extra columns named like those that operators add or use inside.
CLASHING = ["IDS", "n_tokens", "Packed", "spans", "Shard", "slot", "leaks", "failures", "n_words", "_text", "key", "labels"]


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def nasty_texts():
    """Null, empty, blank, repeated, very long and odd texts."""
    rnd = random.Random(5)
    odd = ["a", "The", "'s", "'LL", " ", "  ", "\n", "\t", "é", "É", "İ", "Σ", "ß", "<|endoftext|>", "<|", "123", "中文", "!!", " ", "é", "😀", "\x1c", "\x85", "'re", "'v"]
    mixed = ["".join(rnd.choice(odd) for _ in range(rnd.randint(0, 60))) for _ in range(60)]
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 9))) for _ in range(500)]
    long = " ".join(rnd.choice(words) for _ in range(40_000))
    same = "one two three four five six seven eight nine ten"
    return [None, "", "  \n\t ", same, same, same.upper(), long, long[:200_000].replace(" ", ""), "a" * 5_000, *mixed]


@pytest.fixture
def nasty(spark, nasty_texts):
    """A table of these texts with a null id, a repeated row, and clashing columns."""
    rows = [(None if i == 2 else i, text, *["x"] * len(CLASHING)) for i, text in enumerate(nasty_texts)]
    rows.append(rows[3])
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
        + [T.StructField(c, T.StringType()) for c in CLASHING]
    )
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string")
