import random

import pytest

LONG = "Lorem ipsum dolor sit amet consectetur " * 4000


def words(seed, n, size=400):
    """n words of a small invented vocabulary."""
    r = random.Random(seed)
    vocabulary = ["".join(r.choice(["er", "th", "on", "in", "és", "an", "ti", "ü"]) for _ in range(r.randint(1, 4)))
                  for _ in range(size)]
    return [r.choice(vocabulary) for _ in range(n)]


@pytest.fixture(scope="session")
def docs_of(spark):
    """DataFrame (doc_id, text, and columns with odd names) of a list of texts or (doc_id, text)."""
    def build(texts, partitions=3):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(i, t, "x", i, "k", 1.0) for i, t in rows]
        df = spark.createDataFrame(
            rows, "doc_id long, text string, lang string, n_chars long, `key` string, `score` double")
        return df.repartition(partitions)

    return build


# null, empty, blanks, short, ties, copies, marks of the tokenizers, a very long text
ODD = [None, "", " ", "  a  b\n\tc ", "one", "one", "a b c d e", "日本語 テスト🎉 é", "\u2581x\u2581 y", "\u0001.\u0001", LONG, LONG,
       "x" * 30_000, "1 " * 3000, "the cat\nsat\r\non the mat"]


@pytest.fixture(scope="session")
def odd_texts():
    return list(ODD)
