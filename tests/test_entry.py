"""The entry module without the corpus operators, or without a library that only they use."""

import subprocess
import sys
from pathlib import Path

ROOT = str(Path(__file__).resolve().parents[1])


def names(blocked):
    code = f"import sys; sys.modules[{blocked!r}] = None; sys.path.insert(0, {ROOT!r}); import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, check=True).stdout.splitlines()
    return [set(line.split()) for line in out]


def test_core_queries_stay_without_the_corpus_operators():
    for blocked in ("indexloom.llm", "corpus_pipeline", "zstandard", "public_tokenizers"):
        queries, oracles = names(blocked)
        assert "search" in queries and queries == oracles and not any(n.startswith("op") and n[2].isdigit() for n in queries)
