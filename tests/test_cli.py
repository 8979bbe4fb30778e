"""The command line entry lists the registered queries and rejects unknown names."""
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(*args):
    env = dict(os.environ, PYTHONPATH=ROOT)
    return subprocess.run([sys.executable, "-m", "gridflow", *args], capture_output=True, text=True,
                          env=env, cwd="/", timeout=300)


def test_list_and_unknown_name():
    import __spark_entry__ as E
    out = _run("list")
    assert out.returncode == 0
    assert set(out.stdout.split()) == set(E.queries()) - set(E.LLM_QUERIES)
    bad = _run("run", "no_such_query")
    assert bad.returncode == 2 and "unknown query" in bad.stderr
