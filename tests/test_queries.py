"""Every query of the core against its SQL, over whole tables of the smallest data folder."""

import importlib
import json
import os
import shutil
import subprocess
import sys

import pytest

from tests.oracle import compare
from tidelane import catalog

FOLDER = "/root/testdata/sf0.001"
QUERIES = {n: q for m in catalog.MODULES for n, q in importlib.import_module(m).QUERIES.items()}
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data here")


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in QUERIES.items() if sql))
def test_equals_sql(spark, name):
    query, sql = QUERIES[name]
    compare(spark, FOLDER, query, sql)


#: Columns of the queries without SQL that tell a row from the others.
KEYS = {"approx_stats": None, "split_document": None, "novel_views": ["label", "vec_id"], "deadband": ["episode_idx", "joint", "t"], "complete_snapshots": None, "watchdog_rearm": None, "p5_rescued": ["feed"]}


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in QUERIES.items() if not sql))
def test_without_sql_gives_each_row_once(spark, name):
    rows = [r.asDict() for r in QUERIES[name][0](spark, FOLDER).collect()]
    assert rows
    keys = KEYS[name] or list(rows[0])
    assert len({tuple(str(r[k]) for k in keys) for r in rows}) == len(rows)


def test_rescued_records_equal_plain_reading(spark):
    def pairs(items):
        assert len(dict(items)) == len(items)
        return dict(items)

    expected = {}
    for r in spark.read.parquet(f"{FOLDER}/raw_reports.parquet").select("feed", "payload").collect():
        try:
            record = json.loads(r.payload, object_pairs_hook=pairs)
        except (TypeError, ValueError, AssertionError):
            continue
        if isinstance(record, dict):
            expected[r.feed] = expected.get(r.feed, 0) + 1
    assert {r.feed: r.records for r in QUERIES["p5_rescued"][0](spark, FOLDER).collect()} == expected


def test_only_the_subpackage_missing_is_no_error(tmp_path):
    """A copy without the subpackage, or with an empty folder of its name, keeps every other query."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/tidelane", tmp_path / "tidelane", ignore=shutil.ignore_patterns("__pycache__", "llm"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    for _ in range(2):
        done = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, capture_output=True, text=True, env=os.environ | {"PYTHONPATH": str(tmp_path)}, check=True)
        assert done.stdout.split() == [str(len(QUERIES)), str(sum(1 for _, sql in QUERIES.values() if sql))]
        (tmp_path / "tidelane/llm").mkdir(exist_ok=True)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["episode", "topic", "piece", "start_ms", "end_ms"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
