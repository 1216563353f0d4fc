"""Every registered query against its SQL counterpart, and what its plan may hold."""

import re

import pytest

import __spark_entry__ as entry_point
from oracle_check import connect, mismatch
from shelfmark.plans.curation import QUERIES as CURATION
from shelfmark.plans.queries import QUERIES as SCANS

CATALOG = SCANS | CURATION

QUERIES = entry_point.queries()
ORACLES = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    # an index is held against the exact search in test_retrieval
    assert set(CATALOG) - set(ORACLES) == {"retrieve_indexed"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, con, sf_dir, name):
    difference = mismatch(QUERIES[name](spark, sf_dir), con, ORACLES[name])
    assert difference is None, difference


@pytest.mark.parametrize("name", ["overlapping_roots", "overlapping_roots_counters"])
def test_pages_of_one_address(spark, con, sf_dir, tmp_path, name):
    for t in ("documents", "conversations", "benchmark", "labels"):
        (tmp_path / f"{t}.parquet").symlink_to(f"{sf_dir}/{t}.parquet")
    con.execute(f"""COPY (SELECT * FROM pages UNION ALL SELECT page_id + 1000000, url, html || 'x' FROM pages
        UNION ALL SELECT * FROM pages WHERE page_id % 3 = 0) TO '{tmp_path}/pages.parquet'""")
    copied = connect(sf_dir)
    copied.execute(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet'")
    difference = mismatch(QUERIES[name](spark, str(tmp_path)), copied, ORACLES[name])
    assert difference is None, difference


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["metric", "key", "value"] and df.count() > 5


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_plans(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


@pytest.mark.parametrize("name", ["path_parts", "file_ext", "classify_formats", "corpus_hint",
                                  "census_excluded", "census_limit"])
def test_questions_on_names_read_no_texts(spark, sf_dir, name):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan_of(QUERIES[name](spark, sf_dir)))
    assert len(schemas) == 3
    assert not any("text" in s or "html" in s for s in schemas)


def test_reports_read_only_their_columns(spark, sf_dir):
    plan = plan_of(QUERIES["files_by_category"](spark, sf_dir))
    assert re.findall(r"ReadSchema: struct<([^>]*)>", plan) == ["category:string"]
    plan = plan_of(QUERIES["rag_eligible_files"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(rag_eligible), EqualTo(rag_eligible,1)]" in plan
    plan = plan_of(QUERIES["duplicate_groups_top"](spark, sf_dir))
    assert "ReadSchema: struct<size_bytes:bigint,sha256:string>" in plan


def test_a_rescan_is_one_join(spark, sf_dir):
    plan = plan_of(QUERIES["change_report"](spark, sf_dir))
    assert plan.count("SortMergeJoin") == 1 and "FullOuter" in plan
    assert plan.count("Exchange hashpartitioning(path_hash") == 2


def test_documented_counts(spark, sf_dir):
    """Quantities FIXTURES.md states for the smallest scale factor."""
    if not sf_dir.endswith("sf0.001"):
        pytest.skip("stated for sf0.001")
    changes = {r["change"]: r["n"] for r in QUERIES["change_counts"](spark, sf_dir).collect()}
    actions = {}
    for r in QUERIES["hash_plan"](spark, sf_dir).collect():
        actions[r["action"]] = actions.get(r["action"], 0) + 1
    assert changes == {"carried": 87, "changed": 25, "missing": 51, "new": 98, "unchanged": 214}
    assert actions == {"hash": 128, "reuse": 175, "skip": 34}
