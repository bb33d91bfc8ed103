import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# names that the operators use inside
CLASHING = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, row string, place int, bucket int, fingerprint string, tokens string, template string"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang) pairs."""

    def make(rows, clashing=False):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src0", len(r[1] or "")) for r in rows]
        if clashing:
            return spark.createDataFrame([(*r, "k", "r", 1, 2, "f", "t", "m") for r in full], CLASHING)
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def sample(spark):
    """The documents of the small test tables."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").cache()
