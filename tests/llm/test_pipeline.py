import corpus_pipeline
import duckdb
import pytest

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"
NAMES = [f"op{n}_" for n in range(1, 14)]


def test_every_operator_is_registered_once():
    names = list(entry.queries())
    assert all(sum(n.startswith(x) for n in names) == 1 for x in NAMES) and "pipeline" in names


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n.startswith("op")])
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    cur = con.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    got = entry.queries()[name](spark, SMALL)
    assert sorted(cols) == sorted(got.columns)
    assert sorted(map(str, got.select(*cols).collect())) == sorted("Row(" + ", ".join(f"{c}={v!r}" for c, v in zip(cols, r)) + ")" for r in cur.fetchall())


def test_stages_keep_the_columns_and_only_drop(spark, docs, nothing):
    base = spark.read.parquet(f"{SMALL}/documents.parquet")
    ids, d = {r.doc_id for r in base.select("doc_id").collect()}, base
    for name, stage in corpus_pipeline.STAGES[:-1]:
        d = corpus_pipeline.written(stage(spark, d, SMALL), name)
        assert d.columns == base.columns
        left = {r.doc_id for r in d.select("doc_id").collect()}
        assert left <= ids and len(left) > 0.8 * len(ids)
        ids = left
    pieces = corpus_pipeline.STAGES[-1][1](spark, d, SMALL)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == ids


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_odd_and_empty_tables(spark, docs, nothing, name, stage):
    assert stage(spark, nothing, SMALL).count() == 0
    got = stage(spark, docs, SMALL)
    assert got.count() >= 0 and (name == "packing" or got.columns == docs.columns)


def test_one_row_of_each_group_of_near_copies_stays(spark):
    base = [" ".join(f"w{k}x{i}" for i in range(60)) for k in range(4)]
    near = base[1] + " more"
    rows = [(1, base[0])] * 3 + [(2, base[0])] + [(None, base[1])] * 2 + [(None, near)] + [(7, base[2]), (7, base[2] + " more"), (8, base[3]), (9, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = [tuple(r) for r in corpus_pipeline.near_copies(spark, docs, SMALL).collect()]
    ids = sorted(str(d) for d, _ in got)
    assert ids == sorted(["1", "None", "7", "8", "9", "None"])
    assert sum(t in (base[1], near) for _, t in got) == 1 and (9, None) in got and (None, "") in got and set(got) <= set(rows)
