import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def awkward(spark, tmp_path_factory):
    import tables

    return tables.write(spark, tmp_path_factory.mktemp("awkward"))


@pytest.fixture(scope="session")
def hollow(spark, tmp_path_factory):
    import tables

    return tables.write(spark, tmp_path_factory.mktemp("hollow"), empty=True)
