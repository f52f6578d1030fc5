"""The driver contract stands without the optional part."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _names(folder: str) -> tuple[set[str], set[str]]:
    code = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"
    done = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, check=True,
                          env={**os.environ, "PYTHONPATH": folder})
    queries, oracles = done.stdout.strip().splitlines()[-2:]
    return set(queries.split()), set(oracles.split())


def test_entry_without_the_optional_part(tmp_path):
    from dimflow.plans.queries import REGISTRY

    shutil.copytree(os.path.join(ROOT, "dimflow"), tmp_path / "dimflow",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    queries, oracles = _names(str(tmp_path))
    assert queries == set(REGISTRY) and oracles == set(REGISTRY)


def test_every_oracle_has_a_query():
    queries, oracles = _names(ROOT)
    assert oracles <= queries
