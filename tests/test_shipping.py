import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as entry
from spoolway.session import session
spark = session("local[2]", 2, **{{"spark.ui.enabled": "false", "spark.checkpoint.dir": {shared!r}}})
spark.sparkContext.setLogLevel("OFF")
for name in ("fold_udf", "fold_live"):
    assert entry.queries()[name](spark, {sf!r}).count() > 0, name
print("all ran")
"""


def test_workers_run_without_the_package_on_their_path(tmp_path, sf):
    """Python workers start in another folder and cannot import the repository."""
    repo = str(Path(__file__).resolve().parent.parent)
    script = SCRIPT.format(repo=repo, shared=str(tmp_path / "shared"), sf=sf)
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=600)
    assert "all ran" in done.stdout, done.stderr[-3000:]
