import pytest

from stayline.llm.registry import let_workers_import

#: Columns of ``documents`` and one more whose name clashes with what operators add.
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = DOCUMENTS + ", size long, copies int, keep string, row long, node long, piece_ids string, d string, target int"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    let_workers_import(spark)


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, source) tuples, with clashing extra columns."""

    def build(rows, parts=3):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), 7, 7, "k", 7, 7, "p", "d", 7) for r in rows
        ]
        return spark.createDataFrame(full, CLASHING).repartition(parts)

    return build


@pytest.fixture
def rows_of():
    def collect(df, *columns):
        return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)

    return collect
