"""The pipeline and the queries of this part, stage by stage."""

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
import corpus_pipeline
from tests.llm.test_decontaminate import brute
from tests.llm.test_packing import check
from tests.llm.test_simhash import brute_components, brute_fingerprint

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_every_operator_has_one_query():
    names = list(entry_points.queries())
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = [f for _, f in corpus_pipeline.STAGES]
    columns = docs.columns
    kept = docs.collect()

    good = stages[0](spark, docs, FOLDER)
    assert good.columns == columns and good.schema == docs.schema
    good_rows = good.collect()
    assert 0.7 * len(kept) < len(good_rows) <= len(kept)

    prints = [brute_fingerprint(r["text"]) for r in good_rows]
    group = brute_components(prints, 2)
    first = {}
    for r, g in zip(good_rows, group, strict=True):
        first[g] = min(first.get(g, r["doc_id"]), r["doc_id"])
    near = spark.createDataFrame(good_rows, docs.schema)
    single = stages[1](spark, near, FOLDER)
    assert single.columns == columns and sorted(r["doc_id"] for r in single.select("doc_id").collect()) == sorted(first.values())

    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    some = [tuple(r) for r in near.select("doc_id", "text").collect()][:60]
    bad = {d[0] for d in brute(some, items) if d[4]}
    left = stages[2](spark, near.filter(near.doc_id.isin([d[0] for d in some])), FOLDER)
    assert left.columns == columns and {r["doc_id"] for r in left.collect()} == {d[0] for d in some} - bad

    red = stages[3](spark, near, FOLDER)
    assert red.columns == columns and red.schema == docs.schema
    rows = red.collect()
    assert len(rows) == len(good_rows) and all(len(r["text"]) == r["n_chars"] and "@mail" not in r["text"] for r in rows)

    packed = stages[4](spark, near, FOLDER).collect()
    check(packed, 2_048)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {r["doc_id"]: [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 0] for r in good_rows}
    assert sum(r["length"] for r in packed) == sum(map(len, ids.values()))
    for r in packed:
        own = np.array(ids[r["doc_id"]][r["start"] : r["start"] + r["length"]], dtype="<u4")
        assert len(own) == r["length"] and r["ids_crc32"] == zlib.crc32(own.tobytes())

    made = corpus_pipeline.run(spark, FOLDER).collect()
    check(made, 2_048)
    assert {r["doc_id"] for r in made} <= {r["doc_id"] for r in good_rows}


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_edges_and_empty_tables(spark, edge_docs, no_docs, stage):
    f = corpus_pipeline.STAGES[stage][1]
    assert f(spark, no_docs, FOLDER).count() == 0
    made = f(spark, edge_docs, FOLDER)
    assert made.count() >= 1 and (stage == 4 or made.columns == edge_docs.columns)
