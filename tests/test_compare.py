"""The comparison can be imported where the other engine is not installed."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_import_without_the_other_engine():
    env = os.environ | {"PYTHONDONTWRITEBYTECODE": "1"}
    code = "import sys; sys.modules['duckdb'] = None; import compare; print(len(compare.TABLES))"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) == 14
