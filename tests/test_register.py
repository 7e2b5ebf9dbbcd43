"""The register as a whole: names, SQL side and plan shapes."""

import re

import __spark_entry__ as entry
import duckdb
import pytest

from varloom.plans.fixtures import BASE

SMALL = "/root/testdata/sf0.001"
SAMPLE = ["allele_frequencies", "interval_overlap", "assign_ids", "site_quality", "count_annotations", "phase_block_flips", "exact_match",
          "haplotype_overlaps", "hwe", "ploidy_scores", "sample_counts", "merge_cohort", "trio_transmission"]


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_the_rest_is_listed_without_the_training_data_operators(monkeypatch):
    """As where their folder was deleted: neither they nor the pipeline are listed, and nothing fails."""
    import sys

    for name in [m for m in sys.modules if m.startswith("varloom.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)

    class Absent:
        def find_spec(self, name, path=None, target=None):
            if name.startswith("varloom.llm"):
                raise ModuleNotFoundError(f"No module named {name!r}", name="varloom.llm")

    monkeypatch.setattr(sys, "meta_path", [Absent(), *sys.meta_path])
    assert set(entry.queries()) == set(entry.register.QUERIES) and set(entry.oracle_sql()) == set(entry.register.ORACLE)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", SAMPLE)
def test_plans_have_no_cartesian_product_and_no_python(spark, name):
    p = plan(entry.queries()[name](spark, SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert not re.search(r"ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas", p)


def test_scan_reads_only_the_needed_columns(spark):
    p = plan(entry.queries()["subset_by_length"](spark, SMALL))
    assert "p_retailprice" not in re.findall(r"ReadSchema: struct<([^>]*)>", p)[0]


@pytest.mark.parametrize("name", ["allele_frequencies", "interval_merge", "dedup_overlapping", "switch_flip_errors"])
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for b in BASE:
        con.execute(f"CREATE VIEW {b} AS SELECT * FROM read_parquet('{SMALL}/{b}.parquet')")
    cur = con.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in cur.description]

    def text(rows):
        return sorted(tuple(str(round(v, 5) + 0.0 if isinstance(v, float) else v) for v in r) for r in rows)

    got = entry.queries()[name](spark, SMALL).select(*[f"`{c}`" for c in cols]).collect()
    assert text(got) == text(cur.fetchall())


def test_entry_runs(spark):
    assert entry.entry(spark).limit(1).count() == 1
