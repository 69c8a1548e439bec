import __spark_entry__ as entry


def test_contract_keys():
    qs, sqls = entry.queries(), entry.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 25
    llm = [q for q in qs if q.startswith("op") or q == "pipeline"]
    assert set(qs) - set(sqls) <= set(llm)  # all others have SQL


def test_without_the_llm_folders(tmp_path):
    """A copy without them still imports and has all other queries."""
    import os
    import shutil
    import subprocess
    import sys
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    shutil.copytree(os.path.join(root, "deckforge"), tmp_path / "deckforge",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), set(q) == set(e.oracle_sql()))"
    env = os.environ | {"PYTHONPATH": str(tmp_path), "PYTHONDONTWRITEBYTECODE": "1"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    n, same = out.stdout.split()
    assert int(n) >= 25 and same == "True", out.stderr


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["deck_id", "line_no", "note_guid", "front_text", "back_text", "back_audio", "tags"]
    assert df.count() >= 0


def test_no_cartesian_products(spark):
    from helpers import SF001
    qs = entry.queries()
    for name in ["requests", "blacklist_hits", "output_names", "render_notes", "run_summary"]:
        plan = qs[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
