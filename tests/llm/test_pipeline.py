"""The pipeline against a run of plain Python loops, and the entry module with and without this part."""

import importlib
import random
import sys

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from maktaba.llm import knn_quality, quality_rules

from .test_dedup import brute_join, brute_removed


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    make = lambda n: " ".join(rng.choice(["ther", "tion", "ang", "is", "of", "blen", "re"]) + rng.choice(["", "s", "ly", "ou"]) for _ in range(n))
    passage = make(40)
    clean = [make(rng.randint(30, 90)) for _ in range(70)]
    clean += [c + " end" for c in clean[:12]] + clean[12:20] + [make(20) + " " + passage + " " + make(25) for _ in range(8)]
    junk = [" ".join(["BUY!!", "NOW!!", "###", "W%d" % rng.randint(0, 999)][rng.randint(0, 3)] for _ in range(50)) for _ in range(30)]
    texts = clean + junk + ["", None, "too short", "same " * 80]
    rng.shuffle(texts)
    rows = [(i, t, "en", "src", len(t or "")) for i, t in enumerate(texts)]
    labels = [(i, int(t in clean), 0) for i, t in enumerate(texts) if t and i % 4]
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows


def brute(spark, path, rows):
    labels = spark.read.parquet(f"{path}/labels.parquet")
    table = lambda rs: spark.createDataFrame(rs, "doc_id long, text string")
    rows = [(i, t) for i, t, *_ in rows]
    trees = quality_rules.learn(table(rows), labels)
    kept = []
    for i, t in rows:
        counts, features = quality_rules.statistics(t)
        if counts[0] >= 10 and 100 * counts[4] <= 20 * counts[0] and trees.score(np.array([features]))[0] >= 0.5:
            kept.append((i, t))
    model = knn_quality.learn(table(kept), labels)
    kept = [(i, t) for i, t in kept if knn_quality.score(model, knn_quality.terms(t)[None])[0] >= 0.3]
    kept = [(i, t) for (i, t) in kept if i in {c for _, _, c in brute_join(kept)}]
    return [(i, b.decode("utf-8", "ignore")) for i, _, b in brute_removed(kept)]


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "quality classifier", "n-gram Jaccard join", "suffix-array dedup", "packing"]


def test_run_against_plain_loops(spark, folder):
    path, rows = folder
    want = brute(spark, path, rows)
    assert 40 < len(want) < 90 and any(len(t) < len(dict((i, x) for i, x, *_ in rows)[i]) for i, t in want)
    pieces = corpus_pipeline.run(spark, path).collect()
    ids = {}
    for p in sorted(pieces, key=lambda p: (p.doc_id, p.start)):
        assert p.start == len(ids.setdefault(p.doc_id, []))
        ids[p.doc_id] += np.frombuffer(bytes(p.ids), "<u4").tolist()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert ids == {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in want}


def test_stages_keep_columns_and_empty_tables(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, path)
        empty = stage(spark, docs.limit(0), path)
        assert empty.count() == 0
        if name != "packing":
            assert found.columns == docs.columns and empty.columns == docs.columns


def test_entry_without_this_part(monkeypatch):
    import __spark_entry__

    assert "pipeline" in __spark_entry__.queries() and all(any(n.startswith(f"op{k}_") for n in __spark_entry__.queries()) for k in range(1, 11))
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    bare = importlib.reload(__spark_entry__)
    try:
        assert "pipeline" not in bare.queries() and not any(n.startswith("op") and n[2].isdigit() for n in bare.queries()) and len(bare.oracle_sql()) > 30
    finally:
        monkeypatch.undo()
        importlib.reload(__spark_entry__)
