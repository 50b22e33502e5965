from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark.session import build_session

    ckpt = tmp_path_factory.mktemp("ckpt")
    s = build_session("local[4]", app="tidemark-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": str(ckpt)})
    yield s
    s.stop()


def rows(df, order=None):
    """Rows as sorted tuples (nulls first) for order-insensitive comparison."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is not None, str(x)) for x in t))
