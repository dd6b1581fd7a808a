import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from barframe.session import build_session
    s = build_session("local[4]", shuffle_partitions=8,
                      extra={"spark.sql.shuffle.partitions": "8"})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="barframe-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def bars(spark):
    from barframe.sources.ticks import daily_bars
    from barframe.session import cut_lineage
    return cut_lineage(daily_bars(spark, SF_SMALL))


@pytest.fixture(scope="session")
def bars_pd(bars):
    return bars.orderBy("symbol", "date").toPandas()
