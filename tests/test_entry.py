"""The library without its optional subpackage."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def test_queries_without_the_subpackage(tmp_path):
    for name in ("__spark_entry__.py", "tabwright", "registry"):
        if (ROOT / name).is_dir():
            shutil.copytree(ROOT / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(ROOT / name, tmp_path / name)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and set(e.oracle_sql()) <= set(q); assert not any(n.startswith('op') for n in q)"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]


RUN = """
import __spark_entry__ as e
from tabwright.session import get_session
q = e.queries()
assert len(q) > 100 and not any(n.startswith("op") for n in q), sorted(q)
assert q["a1_max_timestamp"](get_session("t", "local[2]"), e.SMOKE_DIR).count() == 1
"""


def run(code, cwd):
    done = subprocess.run([sys.executable, "-c", code], cwd=cwd, capture_output=True, text=True, timeout=180)
    assert done.returncode == 0, done.stderr[-2000:]


def test_a_query_runs_without_the_subpackage(tmp_path):
    for name in ("tabwright", "registry"):
        shutil.copytree(ROOT / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    run(RUN, tmp_path)


def test_queries_without_an_optional_library():
    """The subpackage is there, a library that it needs is not."""
    run("import sys; sys.modules['ahocorasick'] = None\n" + RUN, ROOT)


def test_nothing_else_imports_the_subpackage():
    files = [p for folder in ("tabwright", "registry") for p in (ROOT / folder).rglob("*.py") if "llm" not in p.parts]
    assert files and not [p for p in files if "tabwright.llm" in p.read_text()]
