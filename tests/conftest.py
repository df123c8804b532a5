import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyguard.session import ROCKSDB_PROVIDER, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("checkpoints"))
    session = local_session(
        "tests",
        8,
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": folder,
            "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        },
    )
    yield session
    session.stop()
