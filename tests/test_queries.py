import pytest

from kinloom.plans.queries import ORACLES, QUERIES
from oracle import same


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    same(spark, sf, QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.columns == ["k", "entity_id", "candidate_entity_ids", "n"]
    assert df.count() == 200


def test_entry_lives_without_the_text_operators(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    repo = Path(__file__).resolve().parent.parent
    shutil.copytree(repo / "kinloom", tmp_path / "kinloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(repo / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'candidates_full' in q and not any(k.startswith('op1_') for k in q); assert e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
