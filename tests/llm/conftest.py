import pytest

#: Columns that also are names of working columns inside the operators.
CLASHING = "id bigint, row string, content string, class string, size int, place string, text_sha256 string, doc string, n int"


@pytest.fixture()
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, source), with extra columns of clashing names."""

    def make(rows):
        full = [
            (i, rest[0], "en", rest[1] if len(rest) > 1 else "s", 7, i, "x", None, "y", 1, "z", "w", "v", 2)
            for i, *rest in rows
        ]
        schema = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASHING}"
        return spark.createDataFrame(full, schema)

    return make
