import random

import pytest

DOCS = "doc_id long, text string, n long, h string, words int, id long, size string, shard int, tokens string, bucket long, row string, txt string, lang string"


def _sentence(rng, n, stems=("ta", "ri", "no", "ke", "lu", "mo", "sa", "vi", "de", "po")):
    return " ".join("".join(rng.choice(stems) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def sentence():
    return _sentence


@pytest.fixture(scope="session")
def make_docs(spark):
    """(doc_id, text) rows as a table with further columns whose names the operators use themselves."""

    def make(rows, partitions=3):
        full = [(i, t, 7, "h", 1, 5, "s", 3, "t", 9, "r", "x", None) for i, t in rows]
        return spark.createDataFrame(full, DOCS).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def tricky():
    """Nulls, empty, blank, short and very long texts, ties, repeated rows, odd white space and letters."""
    rng = random.Random(5)
    base = _sentence(rng, 90)
    words = base.split(" ")
    near = " ".join(words[:40] + ["changed"] + words[41:])
    rows = [
        (0, None),
        (1, ""),
        (2, " \t\n\x0b\x0c\r "),
        (3, "one two three"),
        (4, "One  TWO\nthree"),
        (5, base),
        (6, base),
        (7, near),
        (8, base.upper()),
        (9, _sentence(rng, 20_000)),
        (10, "é\u00a0ö \u2028ß 漢字 " + _sentence(rng, 60) + " 'll it's <|endoftext|> <|startoftext|> x\x1fy"),
        (11, "one two three four five"),
        (12, "a b c d e f g h " * 10),
        (13, "line of words\n" * 6 + "another line"),
        (14, base),
        (14, base),
        (15, None),
        (16, ""),
        (17, "x" * 5000),
        (18, "!!! ### $$$ %%% " * 8),
        (19, "SHOUT " * 3 + _sentence(rng, 30).upper()),
        (20, "\x00 nul " + _sentence(rng, 30)),
    ]
    return rows
