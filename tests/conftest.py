import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("RANKFOLD_CHECKPOINT_DIR", tempfile.mkdtemp(prefix="rankfold-test-ckpt-"))
    from rankfold.session import get_spark
    s = get_spark("local[4]", app="rankfold-tests", **{"spark.sql.shuffle.partitions": "4"})
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="rankfold-test-")


IMPRESSION_SCHEMA = ("rid string, pos int, score double, events array<string>, viewTimeSec bigint, "
                     "durationSeconds bigint, navScreen string, platform string, formulaPath string, typeId bigint, "
                     "userType string, recommenderId bigint, features array<array<double>>")


def make_impressions(spark, rows):
    """rows: dicts with any subset of the impression columns."""
    defaults = {"rid": "s", "pos": 0, "score": 0.0, "events": [], "viewTimeSec": 0, "durationSeconds": 100,
                "navScreen": "video_for_you", "platform": "vk_video_android",
                "formulaPath": "fstorage:vk_video_266_1769078359_f", "typeId": 1776, "userType": "vk",
                "recommenderId": 200, "features": []}
    cols = [c.split()[0] for c in IMPRESSION_SCHEMA.split(", ")]
    data = []
    for i, r in enumerate(rows):
        d = dict(defaults)
        d["pos"] = i
        d.update(r)
        data.append(tuple(d[c] for c in cols))
    return spark.createDataFrame(data, IMPRESSION_SCHEMA)
