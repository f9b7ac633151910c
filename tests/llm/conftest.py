import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Build a documents table from (doc_id, text) or (doc_id, text, lang)."""
    def make(rows):
        return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None) for r in rows], SCHEMA)

    return make


def sentence(seed, n):
    """n words that depend on the seed."""
    return " ".join(f"w{(seed * 7919 + k * 104729) % 9973}" for k in range(n))


LONG = sentence(5, 60_000)
#: Nulls, empty and blank texts, ties, repeated rows, a null id, a long text, one word without end.
EDGES = [(1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one  two"), (6, "one two"), (6, "one two"), (None, "one two"), (None, None),
         (7, sentence(1, 80)), (8, sentence(1, 80)), (9, sentence(1, 79) + " changed"), (10, LONG), (11, LONG + " tail"), (12, "x" * 200_000), (13, "ÄÖ ß 日本 ΣΑΣ <|endoftext|> 'll")]
