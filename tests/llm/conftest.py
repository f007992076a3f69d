import random

import pytest

#: names that the operators use inside, and a column of no known type
CLASHES = ("digest", "class", "block", "score", "id", "label", "part", "size", "key", "a", "_id")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)


def _row(doc_id, text, source="s1"):
    return (doc_id, text, "en", source, len(text or ""), *["x"] * len(CLASHES))


@pytest.fixture(scope="session")
def words():
    rng = random.Random(5)
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(300)]


@pytest.fixture(scope="session")
def odd_rows(words):
    """Nulls, empty and blank texts, a very long text, ties, copies, near copies, repeated rows and ids."""
    rng = random.Random(7)
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows = [_row(1, None), _row(2, ""), _row(3, " \n\t "), _row(None, "no id here at all"), _row(None, None, None),
            _row(None, "no id here at all"), _row(4, "one"), _row(5, "One"), _row(6, "ünï cödé  — 日本 text"), _row(7, "a b c d"),
            _row(8, text(20000), "s2"), _row(9, "same same"), _row(9, "same same"), _row(9, "other text under one id")]
    base = text(120).split()
    for i in range(40):  # a group of near copies, some of them near only to each other
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = rng.choice(words) + str(i)
        rows.append(_row(100 + i, " ".join(w), f"s{i % 4}"))
    common = text(30)
    for i in range(60):  # a passage that many texts share
        rows.append(_row(200 + i, f"{text(10)} {common} {text(rng.randint(1, 12))}", "s3"))
    copies = text(15)
    rows += [_row(300 + i, copies, "s4") for i in range(50)]
    rows += [_row(400 + i, text(rng.randint(1, 60)), None if i % 5 == 0 else f"s{i % 7}") for i in range(60)]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
