"""The shared scratch folder."""

import subprocess
import sys
from pathlib import Path

PROGRAM = """
from meterline.session import build_session, scratch_path
spark = build_session("own", "local[1]")
one, two = scratch_path(spark, "a"), scratch_path(spark, "a")
assert one != two and one.rsplit("/", 1)[0] == two.rsplit("/", 1)[0]
spark.range(3).write.parquet(one)
assert spark.read.parquet(one).count() == 3
print("good")
"""


def test_a_local_session_without_the_setting_gets_a_folder_of_its_own(tmp_path):
    """In a process of its own, as the setting cannot be taken back from a running session."""
    (tmp_path / "spark-defaults.conf").write_text("")
    root = Path(__file__).resolve().parent.parent
    env = {"PATH": "/usr/bin:/bin", "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": str(root)}
    import os

    env = {**os.environ, **env, "PATH": os.environ["PATH"]}
    ran = subprocess.run([sys.executable, "-c", PROGRAM], env=env, capture_output=True, text=True, timeout=120)
    assert ran.stdout.strip().endswith("good"), ran.stderr[-2000:]


def test_a_cluster_without_the_setting_is_refused(monkeypatch):
    import pytest

    from meterline import session

    class Context:
        master = "spark://host:7077"

    class Conf:
        def get(self, name, default):
            return None

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(ValueError):
        session.scratch_path(Session(), "a")
