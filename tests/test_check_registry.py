"""The check registry mirrors the declared tests: 63 by kind, plus 2 added."""

from collections import Counter

from closebook.plans import checks


def test_declared_counts_by_kind():
    assert len(checks.declared()) == 63
    assert Counter(c.kind for c in checks.declared()) == {
        "not_null": 29, "expression": 14, "unique": 9,
        "relationships": 4, "accepted_values": 4, "unique_combination": 3}


def test_added_checks_and_unique_ids():
    assert [c.origin for c in checks.ADDED] == ["added", "added"]
    ids = [c.check_id for c in checks.all_checks()]
    assert len(ids) == len(set(ids)) == 65


def test_entry_tells_a_missing_library_from_a_missing_folder(tmp_path):
    """Without the removable folders the other queries register; with them a
    missing library fails the import instead of dropping their queries."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    bare = tmp_path / "bare"
    bare.mkdir()
    shutil.copytree(f"{root}/closebook", bare / "closebook",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", bare)
    say = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"

    def run(code, where):
        return subprocess.run([sys.executable, "-c", code], cwd=where, capture_output=True, text=True,
                              env={**os.environ, "PYTHONPATH": ""})

    from closebook.plans.catalog import QUERIES
    assert run(say, bare).stdout.split() == [str(len(QUERIES))] * 2
    if os.path.isdir(f"{root}/closebook/llm"):
        hidden = run(f"import sys; sys.modules['xxhash'] = None; {say}", root)
        assert hidden.returncode and "xxhash" in hidden.stderr
