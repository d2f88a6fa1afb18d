"""The entry works without the operators for training text."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOWN = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), sorted(q for q in e.queries() if q[:2] == 'op' or q == 'pipeline'))"


@pytest.mark.parametrize("also", ["corpus_pipeline.py", ""])
def test_entry_imports_from_a_copy_without_the_subpackage(tmp_path, also):
    for top in ("formsift", "oracle", "__spark_entry__.py", "corpus_pipeline.py", "compare.py"):
        whole = os.path.join(ROOT, top)
        if os.path.isdir(whole):
            for folder, names, files in os.walk(whole):
                names[:] = [n for n in names if n not in ("llm", "__pycache__")]
                to = tmp_path / os.path.relpath(folder, ROOT)
                to.mkdir()
                for f in files:
                    (to / f).write_bytes(open(os.path.join(folder, f), "rb").read())
        elif os.path.isfile(whole) and (top != "corpus_pipeline.py" or also):
            (tmp_path / top).write_bytes(open(whole, "rb").read())
    env = os.environ | {"PYTHONPATH": "", "PYTHONDONTWRITEBYTECODE": "1"}
    done = subprocess.run([sys.executable, "-c", f"import compare; {SHOWN}"], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
    found, sql, others = done.stdout.split(maxsplit=2)
    assert int(found) >= int(sql) > 100 and others.strip() == "[]"
