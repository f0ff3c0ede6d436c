"""The registered queries and the pipeline on the smallest tables."""

import hashlib

import duckdb
import numpy as np
import public_tokenizers
import pytest

import __spark_entry__ as entry_module
import check
import corpus_pipeline
from tallybook.llm import byte_bpe, decontaminate
from tallybook.llm.oracles import ORACLES
from tallybook.llm.queries import QUERIES
from tests.llm import cases

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry_module.queries())
    assert len([q for q in QUERIES if q.startswith("op")]) == 13 and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    result = duck.execute(ORACLES[name])
    wanted = check.sorted_rows([c[0] for c in result.description], result.fetchall())
    df = QUERIES[name](spark, SF)
    assert check.sorted_rows(df.columns, [tuple(r) for r in df.collect()]) == wanted


def test_repeated_strings_of_the_small_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    wanted = [(*x[:4], hashlib.sha256(x[4]).hexdigest()) for x in cases.removed(rows, 100)]
    assert sorted(map(tuple, QUERIES["op10_suffix_dedup"](spark, SF).collect())) == sorted(wanted)


def test_pipeline_equals_its_stages_in_plain_python(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    told = {i: cases.line_verdicts(t) for i, t in texts.items()}
    verdicts = {r["doc_id"]: r["kept"] for r in QUERIES["op9_quality_rules"](spark, SF).collect()}
    assert verdicts == {i: kept for i, (kept, _) in told.items()}
    rows = cases.without_repeated_lines(sorted((i, told[i][1]) for i in texts if verdicts[i]))
    told = cases.near_duplicates(rows)
    rows = [row for row, (i, n, component, _) in zip(rows, told) if n == 0 or component == i]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    held = {r["doc_id"] for r in decontaminate.contaminated(table, bench).collect()}
    rows = [row for row in rows if row[0] not in held]
    words = byte_bpe.Words(byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    pattern = byte_bpe.word_pattern(public_tokenizers.PATTERN)
    wanted = []
    for i, text in rows:
        ids = np.asarray(words.encode([text or ""], pattern)[0], "<u4")
        digests = [hashlib.sha256(x).hexdigest() for x in (ids.tobytes(), (text or "").encode())]
        wanted.append((i, len(ids), *digests))
    found = [tuple(r) for r in corpus_pipeline.run(spark, SF).collect()]
    assert sorted(found) == sorted(wanted) and wanted


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
