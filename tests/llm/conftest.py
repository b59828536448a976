import pyarrow.parquet as pq
import pytest

from fixture_rows import FOLDER, ODD


@pytest.fixture(scope="session")
def texts():
    table = pq.read_table(f"{FOLDER}/documents.parquet", columns=["doc_id", "text"])
    return list(zip(table.column(0).to_pylist(), table.column(1).to_pylist()))


@pytest.fixture(scope="session")
def odd(spark):
    """Rows with nulls, empty and long texts, ties and repeated rows, and extra columns with clashing names."""
    schema = "doc_id long, text string, key long, sha string, row string, part int, length string, rank int, n long"
    return spark.createDataFrame([(*r, 1, "x", "y", 2, "z", 3, None) for r in ODD], schema).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")
