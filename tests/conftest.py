import tempfile

import pytest


@pytest.fixture(scope="session")
def spark():
    from tickframe.session import build_session
    s = build_session(master="local[4]", partitions=8,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tickframe-test-")})
    yield s
    s.stop()

