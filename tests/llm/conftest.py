import pytest

from funnelspark.llm.common import prepare


@pytest.fixture(autouse=True)
def prepared(spark):
    prepare(spark)
