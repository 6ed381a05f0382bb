"""Registered text queries against their SQL, and the pipeline stage by stage."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import corpus_pipeline
import oracle
from kerbside.llm import decontam, rlz, setsketch
from kerbside.llm.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = oracle.spark_rows(df)
    if name not in ORACLES:
        assert got[1]
        return
    assert got == oracle.duck_rows(con, ORACLES[name])
    assert not oracle.type_gaps(df, con, ORACLES[name])


def test_stages_against_sql(spark, tmp_path):
    """Each stage over what the one before kept, against the SQL of its operator."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    con = oracle.connect(SF)
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        before = docs
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = docs
        if name in ("language", "mix"):
            continue
        source = kept[{"near_duplicates": "language", "substrings": "near_duplicates", "decontaminated": "substrings"}[name]]
        con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/"
                    f"{[n for n, d in kept.items() if d is source][0]}/*.parquet')")
        assert docs.columns == before.columns
        if name == "near_duplicates":
            want = {r[0] for r in con.execute(f"SELECT doc_id FROM ({setsketch.SQL}) WHERE kept").fetchall()}
            assert {r.doc_id for r in docs.collect()} == want
        if name == "substrings":
            want = dict(con.execute(f"SELECT doc_id, n_words - n_removed FROM ({rlz.SQL})").fetchall())
            assert {r.doc_id: len(r.text.split()) for r in docs.collect()} == want
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        if name == "decontaminated":
            want = {r[0] for r in con.execute(f"SELECT doc_id FROM ({decontam.SQL}) WHERE NOT contaminated").fetchall()}
            assert {r.doc_id for r in docs.collect()} == want
    assert kept["language"].count() == 200
    mix = kept["mix"].toPandas()
    assert len(mix) == kept["decontaminated"].count()
    assert abs(mix.taken.sum() - 1.5 * mix["size"].sum()) < 0.1 * mix["size"].sum()
    assert (mix.taken <= 2 * mix["size"]).all()
