import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    return (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )


TEXTS = [None, "", " ", "One word", "The the of " * 20, "x" * 50_000, "An idiot said 4111 1111 1111 1111.\nTwo lines", "The the of " * 20]


@pytest.fixture(scope="session")
def docs(spark, tmp_path_factory):
    """NULLs, empty and long texts, repeated rows, and columns whose names clash with the operators' own."""
    from eventweft.llm.common import table

    folder = str(tmp_path_factory.mktemp("docs"))
    rows = [(None if i == 2 else i % 7, t, "en", "s", len(t or ""), 1.0, "p", "r") for i, t in enumerate(TEXTS)]
    kind = "doc_id long, text string, lang string, source string, n_chars long, score double, print string, root string"
    spark.createDataFrame(rows, kind).write.parquet(f"{folder}/documents.parquet")
    return table(spark, folder, "documents")
