"""Registered queries: DuckDB SQL, pipeline against its parts, independence of the rest."""

import os
import subprocess
import sys

import duckdb

from tables import SF_SMALL  # isort: skip

import corpus_pipeline
from ontime.llm import registry
from ontime.llm.byte_bpe import byte_bpe


def test_oracles(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    for name, sql in registry.oracles().items():
        out = registry.registered()[name](spark, SF_SMALL)
        expected = con.sql(sql)
        columns = sorted(expected.columns)
        assert sorted(out.columns) == columns
        assert sorted(map(tuple, out.select(*columns).collect())) == sorted(expected.select(*columns).fetchall())


def test_pipeline(spark):
    out = corpus_pipeline.run(spark, SF_SMALL).collect()
    docs = corpus_pipeline.documents(spark, SF_SMALL)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF_SMALL)
        assert kept.columns == docs.columns
        docs = kept
    path = registry.public_tokenizers.path(registry.RANKS)
    expected = byte_bpe(docs, path, registry.public_tokenizers.PATTERN)
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in out) == sorted(
        (r.doc_id, r.n_tokens, r.ids_sha256) for r in expected.collect())
    assert all(r.n_tokens == len(r.ids) for r in out)


def test_nothing_else_imports_the_subpackage():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    script = ("import sys; sys.modules['ontime.llm'] = None\n"
              "import pkgutil, importlib, ontime\n"
              "for m in pkgutil.walk_packages(ontime.__path__, 'ontime.'):\n"
              "    m.name.startswith('ontime.llm') or importlib.import_module(m.name)\n")
    subprocess.run([sys.executable, "-c", script], cwd=root, check=True)
