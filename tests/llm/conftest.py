import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # names the operators use themselves
    "score double, n string, size string, shared string, a string, shingles string, root string, "
    "n_lines string, row string, _id string, ranges string")


@pytest.fixture
def table(spark):
    """rows of (doc_id, text[, lang, source]) -> documents with extra columns
    whose names clash with the operators' own."""
    def make(rows):
        full = []
        for r in rows:
            i, t, lang, source = (tuple(r) + ("en", "s"))[:4] if len(r) < 4 else r
            full.append((i, t, lang, source, None if t is None else len(t), -1.0, *["x"] * 10))
        return spark.createDataFrame(full, SCHEMA)
    return make


@pytest.fixture
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
