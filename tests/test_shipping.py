"""The package reaches the workers and leaves nothing behind, started from a folder that knows nothing of it."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import os, sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as entry
from tallyloom.runtime import build_session, drop_stages
spark = build_session("elsewhere", "local[2]", **{{"spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false", "spark.checkpoint.dir": os.path.abspath("scratch")}})
assert entry.queries()["density_clusters"](spark, "/root/testdata/sf0.001").count() > 0
left = lambda: [f for top, _, names in os.walk("scratch") for f in names]
assert left()
drop_stages(spark)
assert not left(), left()
"""


def test_from_a_temporary_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_LOCAL_DIRS")}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=REPO)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]


def test_no_temporary_folders_in_the_package():
    for top, _, names in os.walk(os.path.join(REPO, "tallyloom")):
        for name in names:
            if name.endswith(".py"):
                assert "tempfile" not in open(os.path.join(top, name)).read(), name
