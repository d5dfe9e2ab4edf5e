import pytest

from lexiloom.session import get_spark


@pytest.fixture(scope="session")
def spark():
    return get_spark("tests", cores="4", spark__sql__shuffle__partitions="4")
