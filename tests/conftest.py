import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("geotracks tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="geotracks-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def vertices(spark, tracks, src="a.gpx"):
    """Vertex table of (name, parts) pairs, or of (src, name, parts) triples."""
    rows = []
    for number, track in enumerate(tracks):
        file, name, parts = track if len(track) == 3 else (src, *track)
        for seg, part in enumerate(parts):
            for place, (x, y) in enumerate(part):
                rows.append((file, number + 1, name, seg, place + 1, float(x), float(y)))
    return spark.createDataFrame(
        rows,
        "src string, ogc_fid long, name string, seg_no int, pt_no long, x double, y double",
    )
