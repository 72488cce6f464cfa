import subprocess
import sys

import __spark_entry__ as entry

NAMES = [f"op{n}_" for n in range(1, 14)]


def test_every_operator_is_registered_once():
    names = list(entry.queries())
    assert all(sum(x.startswith(n) for x in names) == 1 for n in NAMES) and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


def test_the_rest_works_without_the_package():
    code = "import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; print(any(k.startswith('op1') for k in e.queries()), len(e.queries()))"
    said = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=entry.__file__.rpartition("/")[0], check=True)
    assert said.stdout.split()[0] == "False" and int(said.stdout.split()[1]) > 100
