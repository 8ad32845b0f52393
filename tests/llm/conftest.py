import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, kept int, row int"


def corpus(spark, texts):
    """Rows with the given (doc_id, text), and further columns whose names clash with results."""
    rows = [
        (i, t, "en" if k % 3 else None, f"s{k % 2}" if k % 5 else None, None if t is None else len(t), "x", k, k)
        for k, (i, t) in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def sentence(k, n=40):
    """``n`` words that depend on ``k``."""
    return " ".join(f"w{(k * 7919 + j * 104729) % 99991}" for j in range(n))


@pytest.fixture(scope="session")
def awkward():
    """NULL and empty texts, NULL and repeated identifiers, repeated rows, ties, a very long text."""
    long_text = "\n".join(sentence(k, 30) for k in range(600))
    return [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, sentence(1)), (4, sentence(1)), (4, sentence(2)),
        (None, sentence(1)), (None, None), (None, sentence(3)), (5, long_text), (6, long_text + " end"),
        (7, "Einä ▁ \U0001f600   A-Z <s> <|endoftext|>  two  spaces"), (8, "one"), (9, "one\none\none"),
        (10, "a b a b a b a b a b a b a b"), (11, sentence(1).upper()),
    ]
