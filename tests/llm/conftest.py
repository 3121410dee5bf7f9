import random

import pytest

WORDS = ("alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa quebec romeo "
         "sierra tango uniform victor whiskey xray yankee zulu").split()


def prose(rng, n, lines=8):
    out = []
    for i in range(n):
        out.append(rng.choice(WORDS) + rng.choice(["", "s", "ed", "ing", "er", "ly"]) + str(rng.randint(0, 60)))
    return "\n".join(" ".join(out[k:k + lines]) + "." for k in range(0, n, lines))


def odd_rows():
    """Nulls, empty and blank texts, ties, repeated rows, a very long text."""
    rng = random.Random(3)
    base = prose(rng, 120)
    words = base.split()
    rows = [(1, base, "a"), (2, base, "a"), (2, base, "a"), (3, None, "b"), (4, "", "b"), (5, " \t\n\x0b\x0c\r ", None),
            (None, base.upper(), None), (6, "one", "c"), (7, "ONE", "c"), (8, "one two", "c"),
            (9, " ".join(words[:60] + ["changed"] + words[61:]), "a"), (10, prose(rng, 40_000), "d"),
            (11, "naïve ñandú 日本語 x y 😀", "é"), (12, "x" * 200_000, "d"), (13, "a a a a a a a a a a a a", "a"),
            (14, "<|endoftext|> <s> don't\n\n\nstop", "b"), (15, base, None)]
    rows += [(100 + i, prose(rng, rng.randint(5, 200)), rng.choice("abcd")) for i in range(40)]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with clashing extra columns."""
    data = [(i, t, s, "k", 1, 2, 3, 4, "x") for i, t, s in odd_rows()]
    return spark.createDataFrame(data, "doc_id long, text string, source string, _key string, size int, n int, node int, row int, shard string")


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("doc_id = -1")
