"""The loan book without the corpus operators or the libraries they need."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
BLOCK = """
import sys

class Block:
    def find_spec(self, name, path=None, target=None):
        if name == {module!r} or name.startswith({module!r} + "."):
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)

sys.meta_path.insert(0, Block())
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from loanbook.plans.catalog import QUERIES
found = entry.queries()
assert set(QUERIES) <= set(found), set(QUERIES) - set(found)
assert set(QUERIES) <= set(entry.oracle_sql())
print(len(QUERIES), sorted(set(found) - set(QUERIES)))
"""


def run(module):
    return subprocess.run([sys.executable, "-c", BLOCK.format(module=module, root=str(ROOT))], capture_output=True, text=True, timeout=120)


@pytest.mark.parametrize("module", ("public_tokenizers", "xxhash", "regex", "tiktoken", "numpy", "pandas", "loanbook.llm", "corpus_pipeline"))
def test_the_loan_book_stands_alone(module):
    done = run(module)
    assert done.returncode == 0, done.stderr
    if module in ("public_tokenizers", "xxhash", "loanbook.llm") and (ROOT / "loanbook" / "llm").is_dir():
        assert done.stdout.strip().endswith("[]") and "left out" in done.stderr


def test_faults_of_the_loan_book_are_seen():
    assert "loanbook.operators.cards" in run("loanbook.operators.cards").stderr
    assert run("loanbook.operators.cards").returncode != 0
