import pytest

from orderline_kpi.llm.common import share_package


@pytest.fixture(autouse=True)
def package_for_workers(spark):
    share_package(spark)


@pytest.fixture
def documents(spark):
    """Documents out of (id, text) pairs, with extra columns whose names the operators use themselves."""
    def make(*rows, source="host"):
        return spark.createDataFrame(
            [(i, text, "en", source, None if text is None else len(text), "extra", -1) for i, text in rows],
            "doc_id long, text string, lang string, source string, n_chars long, id string, n_words int",
        ).repartition(3)

    return make
