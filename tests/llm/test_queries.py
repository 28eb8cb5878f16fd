"""Registered queries against SQL or brute force over the smallest given tables, and the
pipeline stage by stage against plain definitions."""

from __future__ import annotations

import collections
import math
import os
import subprocess
import sys

import pytest

import corpus_pipeline
from maskwright.llm import language_model, line_dedup, quality_rules
from maskwright.llm.common import table, written
from maskwright.llm.queries import ORACLE, QUERIES
from tests.llm import plain

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not there")


@pytest.fixture(scope="module")
def documents(spark):
    return [tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text", "source").collect()]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    with duckdb.connect() as con:
        for t in ("documents", "benchmark", "embeddings"):
            con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
        result = con.execute(ORACLE[name])
        columns = [d[0] for d in result.description]
        want = sorted(result.fetchall(), key=repr)
    found = QUERIES[name](spark, SF)
    assert sorted(found.columns) == sorted(columns)
    assert sorted((tuple(r) for r in found.select(*columns).collect()), key=repr) == want


def test_op8(spark, documents):
    found = QUERIES["op8_suffix_dedup"](spark, SF).collect()
    assert {r["doc_id"]: tuple(r)[:5] for r in found} == {r[0]: r for r in plain.repeats([d[:2] for d in documents])}
    whole = dict(d[:2] for d in documents)
    for r in found:  # the text that stays, but for characters that a cut falls into
        size = len(r["text"].encode())
        assert 0 <= r["n_bytes"] - r["n_removed"] - size <= 6 * r["n_spans"]
        assert r["n_removed"] or r["text"] == (whole[r["doc_id"]] or "")


def test_op10(spark, documents):
    found = {r["doc_id"]: r for r in QUERIES["op10_lm_scoring"](spark, SF).collect()}
    want = plain.language_model([d[:2] for d in documents], language_model.discounts)
    assert len(found) == len(want)
    for key, held_out, n_tokens, n_known, n, base, score in want:
        r = found[key]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held_out, n_tokens, n_known, n)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and math.isclose(r["score"], score, rel_tol=1e-9)
    held = [r for r in found.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_op3(spark, documents):
    found = {r["doc_id"]: r for r in QUERIES["op3_mixing"](spark, SF).collect()}
    sizes = collections.Counter()
    for _, text, source in documents:
        sizes[source] += len(plain.WORD.findall(text or ""))
    targets = plain.mixing_targets(dict(sizes))
    for key, text, source in documents:
        r = found[key]
        assert r["size"] == len(plain.WORD.findall(text or "")) and r["taken"] <= 2 * r["size"]
        assert math.isclose(r["target"], targets[source], rel_tol=1e-9)


def test_op2(spark, documents):
    """Against the library itself."""
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    theirs = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    found = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op2_token_counts"](spark, SF).collect()}
    for key, text, _ in documents:
        n = len(theirs.encode(text or "", add_special_tokens=False).ids)
        assert found[key] == (len((text or "").encode()), n, n > 512)


WITH_PYTHON = ["op2", "op4", "op5", "op6", "op8", "op10", "op11", "op12", "op13"]


def test_workers_need_not_have_the_package(tmp_path):
    """Executors get the operators' functions with the job."""
    script = f"""
import sys
sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))!r})
from pyspark.sql import SparkSession
from maskwright.llm.queries import QUERIES
session = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
spark = session.config("spark.executorEnv.PYTHONPATH", "").getOrCreate()
for name, query in QUERIES.items():
    if name.split("_")[0] in {WITH_PYTHON}:
        assert query(spark, {SF!r}).count(), name
spark.stop()
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=1500)
    assert done.returncode == 0, done.stderr[-3000:]


def test_every_query_runs(spark):
    for name in set(QUERIES) - set(ORACLE) - {"op3_mixing", "op8_suffix_dedup", "op10_lm_scoring"}:
        kind = "pages" if name.startswith("op6") else "documents"
        assert QUERIES[name](spark, SF).count() == table(spark, SF, kind).count()


def test_pipeline(spark):
    """Each stage on what its predecessor kept, against the plain definition of its decision."""
    docs = table(spark, SF, "documents")
    columns = docs.columns
    benchmark = [tuple(r) for r in table(spark, SF, "benchmark").collect()]
    last = None
    for name, stage in corpus_pipeline.STAGES:
        before = [r.asDict() for r in docs.collect()]
        docs = written(stage(spark, docs, SF), "test")
        after = [r.asDict() for r in docs.collect()]
        got = {r["doc_id"]: r for r in after}
        if name == "quality_rules":
            failing = {r["doc_id"] for r in before if plain.quality(r["text"])[-1]}
            ledger = {r["doc_id"] for r in quality_rules.ledger(table(spark, SF, "documents")).where("kept").collect()}
            assert set(got) == ledger and not set(got) & failing and len(got) > 100
        elif name == "line_dedup":
            texts = plain.line_dedup([(r["doc_id"], r["source"], r["text"]) for r in before], line_dedup.MIN_SITES, line_dedup.MIN_CHARS)
            want = {r["doc_id"]: t for r, t in zip(before, texts) if t == r["text"] or plain.WORD.search(t)}
            assert {k: r["text"] for k, r in got.items()} == want
        elif name == "near_duplicates":
            want = plain.near_duplicates([(r["doc_id"], r["text"]) for r in before])
            assert set(got) == {key for key, _, component in want if key == component}
        elif name == "decontamination":
            found = plain.contamination([r["text"] for r in before], benchmark)
            assert set(got) == {r["doc_id"] for r, f in zip(before, found) if not f[-1]}
        else:
            assert set(docs.columns) == {*columns, "copy"}
            counts = collections.Counter(r["doc_id"] for r in after)
            assert set(counts) <= {r["doc_id"] for r in before} and max(counts.values()) <= 2
            last = counts
            continue
        assert docs.columns == columns
    whole = collections.Counter(r["doc_id"] for r in corpus_pipeline.run(spark, SF).select("doc_id").collect())
    assert whole == last
