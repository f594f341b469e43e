"""The driver contract: entry, registered queries and their SQL on the smallest tables."""

import os
import subprocess
import sys

import duckdb
import pytest

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the data tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() == 100 and "event_id" in df.columns


def test_names_match():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


QUICK = ["normalize_events", "canonical_keys", "dedup_first_wins", "incremental_write_summary", "logical_batches", "slot_state_merge", "finalized_frontier", "frontier_fork", "open_gaps", "recent_events_by_type", "swap_inference", "instruction_flatten", "latency_histogram_counts", "cursor_upsert", "update_accounts", "update_instructions", "update_dispatch", "conversion_skip"]


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, duck, name):
    from tidemark.plans.driver_queries import ORACLES, QUERIES

    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    found = duck.execute(ORACLES[name])
    names = [c[0] for c in found.description]
    want = sorted(repr([row[names.index(c)] for c in columns]) for row in found.fetchall())
    assert sorted(repr([r[c] for c in columns]) for r in df.collect()) == want


def test_core_stands_without_the_llm_folders(tmp_path):
    """Nothing but the entry module's guard knows of the training-data subpackage."""
    import shutil

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/tidemark", tmp_path / "tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""}, check=True)
    queries, checked = map(int, out.stdout.split())
    assert queries == checked >= 55, out
