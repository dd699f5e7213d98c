"""The registered queries and the pipeline on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from tests.conftest import SF_SMALL
from tradewatch.llm.queries import QUERIES, SQL

from .conftest import EDGE, prose, rows


def test_one_query_per_operator():
    names = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert names == list(range(1, 14))
    assert {"pipeline", *QUERIES} <= set(E.queries())
    assert [n for n, _ in P.STAGES] == ["quality rules", "exact dedup", "near dedup", "mix to target weights", "encode"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.execute(SQL[name]).df()
    got = QUERIES[name](spark, SF_SMALL).toPandas()[list(want.columns)]
    assert sorted(map(str, got.itertuples(index=False, name=None))) == sorted(map(str, want.itertuples(index=False, name=None)))


def test_stages(spark, tmp_path):
    """Each stage keeps what its operator says, on all that came before."""
    docs, columns, counts = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), None, []
    for k, (_, stage) in enumerate(P.STAGES):
        columns = docs.columns
        out = stage(spark, docs, SF_SMALL)
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        counts.append(docs.count())
        if k < len(P.STAGES) - 1:
            assert docs.columns == columns
    quality = QUERIES["op3_line_quality"](spark, SF_SMALL).filter("kept").count()
    assert counts[0] == quality and counts[0] >= counts[1] >= counts[2] > 0 and counts[3] == counts[4]
    assert sorted(r.n_tokens for r in docs.collect()) == sorted(r.n_tokens for r in P.run(spark, SF_SMALL).collect())


@pytest.mark.parametrize("stage", [P.exact_dedup, P.near_dedup, P.mix_sources])
def test_row_numbers_hold_when_splits_change(spark, stored, stage):
    """The files are dealt to other tasks once the operator has run, as when executors join."""
    docs = stored(rows(*[(i, prose(i // 2, 30), f"s{i % 3}") for i in range(60)]), parts=6)
    want = sorted(r.doc_id for r in stage(spark, docs, "").collect())
    out = stage(spark, docs, "")
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        assert sorted(r.doc_id for r in out.collect()) == want
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_stages_on_edge_rows(spark, stored):
    docs = stored(rows(*EDGE))
    assert P.exact_dedup(spark, docs, "").count() == 6
    assert P.near_dedup(spark, docs, "").count() == 8  # blank texts link with nothing
    for _, stage in P.STAGES:
        assert stage(spark, stored([], stage.__name__), "").count() == 0
