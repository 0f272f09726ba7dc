"""Session defaults: only what nobody named; a shared folder on anything but a local master."""

import os
import subprocess
import sys

import pytest

from skyledger import session as S

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_submitted_settings_hold(tmp_path):
    script = tmp_path / "job.py"
    script.write_text(
        "from skyledger.session import build_session\n"
        "s = build_session('local[1]')\n"
        "print('GOT', s.conf.get('spark.sql.session.timeZone'), s.conf.get('spark.sql.adaptive.skewJoin.enabled'),\n"
        "      s.conf.get('spark.ui.enabled'))\n"
    )
    submitted = (
        "--conf spark.sql.session.timeZone=Europe/Berlin "
        "--conf spark.sql.adaptive.skewJoin.enabled=false pyspark-shell"
    )
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": submitted, "PYTHONPATH": ROOT}
    out = subprocess.run([sys.executable, str(script)], env=env, capture_output=True, text=True, timeout=120)
    assert "GOT Europe/Berlin false false" in out.stdout, out.stderr[-2000:]


def test_active_session_keeps_its_settings(spark):
    before = spark.conf.get("spark.sql.adaptive.skewJoin.enabled")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        S.build_session()
        assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "false"
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", before)


@pytest.mark.parametrize("master, local", [
    ("local", True), ("local[8]", True), ("local[*]", True),
    ("local-cluster[2,1,1024]", False), ("spark://h:7077", False), ("yarn", False),
])
def test_only_local_masters_may_lack_a_shared_folder(master, local):
    assert S.is_local(master) is local


def test_other_masters_without_a_shared_folder_fail(monkeypatch, spark):
    monkeypatch.setattr(S, "checkpoint_root", lambda s: None)
    monkeypatch.setattr(S, "is_local", lambda m: False)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.ensure_checkpoint_dir(spark)
