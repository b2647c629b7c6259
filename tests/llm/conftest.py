import pytest


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) rows, with the further columns of the table."""

    def run(rows):
        full = [(i, t, "en", "src0", len(t) if t is not None else None) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)

    return run


@pytest.fixture(scope="session")
def odd():
    """Nulls, empties, ties, repeats, control characters and one long text."""
    return [
        (1, None), (2, ""), (3, " "), (4, "a"), (5, "Một hai ba. Bốn"), (5, "Một hai ba. Bốn"), (5, "khác"), (None, "không có số"), (None, None), (None, "không có số"),
        (6, "x " * 70_000), (7, "\x00\t\x0b tab"), (8, "😀" * 50), (9, "a" * 5000), (10, "  a  b  "), (11, "<|endoftext|> ▁ <s>"),
    ]


@pytest.fixture(scope="session")
def rows_of():
    def run(df, *cols):
        return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)

    return run
