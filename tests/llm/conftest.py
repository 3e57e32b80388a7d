import pytest

import __spark_entry__ as entry_module


@pytest.fixture(autouse=True, scope="session")
def _code_on_workers(spark):
    entry_module._show_code_to_workers(spark)
