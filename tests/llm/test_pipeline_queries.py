"""The pipeline against its stages' models, and every registered query against SQL where there is any."""

from __future__ import annotations

import pytest

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm import cases
from tests.oracle_check import rows_of_duck, rows_of_spark
from tierline.llm import bpe, mixing, quality_rules, queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, duck, name):
    con = duck(SF_SMALL)
    assert rows_of_spark(queries.QUERIES[name](spark, SF_SMALL)) == rows_of_duck(con, queries.ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLE)))
def test_query_runs_over_its_table(spark, name):
    table = {"op2": "pages", "op3": "embeddings"}.get(name[:3], "documents")
    n = spark.read.parquet(f"{SF_SMALL}/{table}.parquet").count()
    rows = queries.QUERIES[name](spark, SF_SMALL).count()
    assert rows == (10 * -(-n // 100) if name.startswith("op3") else n)


def test_pipeline_against_models(spark):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = sorted(tuple(r) for r in quality_rules.judge(docs).where("kept").select(*docs.columns).collect())
    groups = cases.components(rows)
    rows = [r for r in rows if groups[r[0]][1] == r[0]]
    left = cases.without_repeats(rows)
    rows = [(r[0], left[r[0]][3].decode("utf-8", "ignore"), *r[2:]) for r in rows]
    copies = {r.doc_id: r.copies for r in mixing.mix(cases.frame(spark, rows)).collect()}
    tok = Tokenizer.from_file(bpe.default_path())
    want = []
    for r in rows:
        ids = tok.encode(r[1], add_special_tokens=False).ids
        decoded = cases.digest(tok.decode(ids, skip_special_tokens=False).encode())
        want += [(r[0], r[3], len(ids), ids, decoded)] * copies[r[0]]
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, SF_SMALL).collect())
    assert got == sorted(want)


def test_stages_keep_columns_and_take_odd_tables(spark):
    docs = cases.with_clashes(cases.frame(spark, cases.make_documents(2, 12)))
    for df in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, df, SF_SMALL)
            assert out.columns == df.columns
            df = out
        assert corpus_pipeline.STAGES[-1][1](spark, df, SF_SMALL).count() == df.count()
