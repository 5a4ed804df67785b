import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, texts, ids=None, langs=None, sources=None):
    """A table like documents, with extra columns whose names clash with the operators' own."""
    rows = [
        (ids[i] if ids else i, t, langs[i] if langs else "en", sources[i] if sources else "src1",
         None if t is None else len(t), "x", 7, -1)
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA + ", `text_sha256` string, `fp` int, `level0` int")


@pytest.fixture(scope="session")
def docs_of(spark):
    return lambda texts, **more: documents(spark, texts, **more)


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
