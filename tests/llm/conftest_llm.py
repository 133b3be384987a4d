import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards box many quiet jackals under bright morning skies".split()


def prose(seed: int, words: int, vocabulary=WORDS) -> str:
    """Words picked by a small generator of its own, in lines of twelve."""
    state, out = seed * 7919 + 13, []
    for i in range(words):
        state = (state * 1103515245 + 12345) % 2**31
        out.append(vocabulary[(state >> 8) % len(vocabulary)])
    return "\n".join(" ".join(out[i : i + 12]) for i in range(0, len(out), 12))


def hostile_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, repeated rows and ids, odd characters."""
    return [
        (1, None, "en", "a", 0),
        (2, "", None, "a", 0),
        (3, "\n\n \t", "en", None, None),
        (None, "a row without an id\nand two lines of text", "en", "a", 40),
        (None, None, None, None, None),
        (5, prose(1, 40), "en", "a", 1),
        (5, prose(1, 40), "en", "a", 1),
        (5, "another text under the same id", "en", "a", 1),
        (6, "x" * 200_000, "en", "a", 200_000),
        (7, prose(2, 30_000), "en", "b", 1),
        (8, "é́   tab\there\r\nline\r\n\r\nend 東京 🙂 <|endoftext|>", "xx", "b", 1),
        (9, "!!! ### $$$ 123 456", "en", "b", 1),
        (10, "one", "en", "b", 1),
    ]


@pytest.fixture(scope="session")
def hostile(spark):
    """Hostile documents, with more columns whose names the operators use themselves."""
    rows = spark.createDataFrame(hostile_rows(), DOC_SCHEMA)
    extra = "n_tokens score path node doc row body kept held_out line at digest type id label toxic quality segment matches".split()
    return rows.selectExpr("*", *[f"'x' AS `{name}`" for name in extra]).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
