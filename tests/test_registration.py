"""The library's queries are registered without the training-data operators
and without what those alone need."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
BLOCK = """
import sys
class Block:
    def find_spec(self, name, path=None, target=None):
        if name.split('.')[0] == {module!r} or name == {module!r}:
            raise ModuleNotFoundError('blocked', name=name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as E
from shoplens.plans import catalog, oracle
assert set(E.queries()) >= set(catalog.queries()) and set(E.oracle_sql()) >= set(oracle.oracle_sql())
print(len(E.queries()) - len(catalog.queries()), len(E.oracle_sql()) - len(oracle.oracle_sql()))
"""


@pytest.mark.parametrize("module", ["xxhash", "pyarrow", "shoplens.llm", "corpus_pipeline"])
def test_the_library_is_registered_without(module):
    done = subprocess.run([sys.executable, "-c", BLOCK.format(module=module)], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
    assert done.stdout.split() == ["0", "0"] and "left out" in done.stderr
