import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from keyledger.session import build_session  # noqa: E402

UUID_EPOCH_OFFSET = 122192928000000000


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session(f"file://{tmp_path_factory.mktemp('scratch')}", app="keyledger-tests", extra={
        "spark.master": "local[4]", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "6g",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))})
    yield s
    s.stop()


def timeuuid(ms: int, node: int = 0, clock: int = 0) -> str:
    """Version-1 uuid text of an epoch-ms instant (test-side reference)."""
    t = ms * 10000 + UUID_EPOCH_OFFSET
    return "%08x-%04x-%04x-%04x-%012x" % (t & 0xFFFFFFFF, (t >> 32) & 0xFFFF, ((t >> 48) & 0x0FFF) | 0x1000,
                                          0x8000 | (clock & 0x3FFF), node)


def payload(id_, ms, set_=None, rem=None, **over):
    body = {"$rem": rem or [], "model": "", "id": id_, "time": ms, "source": "", "$set": set_ or {},
            "version": 1, "snapshot": False}
    body.update(over)
    return json.dumps(body)


def raw(id_, ms, set_=None, rem=None, node=0, **over):
    """One raw event row (id, time, payload)."""
    return (id_, timeuuid(ms, node), payload(id_, ms, set_, rem, **over))
