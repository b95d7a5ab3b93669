import tempfile

import pytest

from sluice.session import local_session


@pytest.fixture(scope="session")
def spark():
    home = tempfile.mkdtemp(prefix="sluice-tests-")
    session = local_session(
        "sluice-tests",
        cpus=4,
        partitions=4,
        **{
            "spark.sql.warehouse.dir": f"{home}/warehouse",
            "spark.checkpoint.dir": f"{home}/shared",
            "spark.driver.memory": "4g",
        },
    )
    yield session
    session.stop()
