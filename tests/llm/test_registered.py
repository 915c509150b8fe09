"""The registered queries, whole results, against SQL or plain loops over the smallest tables."""

import hashlib
import re
import zlib
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tiktoken.load import load_tiktoken_bpe
from tokenizers import Tokenizer

from maktaba.llm import knn_quality, quality_rules, queries, winnow
from maktaba.llm.common import BASE, mix

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def result(spark, name):
    return queries.QUERIES[name](spark, SF).collect()


@pytest.mark.parametrize("name", sorted(set(queries.ORACLES)))
def test_query_equals_sql(spark, name):
    tables = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        tables.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    got = queries.QUERIES[name](spark, SF)
    want = tables.sql(queries.ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr) == sorted(want.select(*[f'"{c}"' for c in columns]).fetchall(), key=repr)


def descend(trees, t, x, node=0):
    """The value that one tree gives to the features of one text."""
    inner = len(trees.feature[t])
    if node >= inner:
        return trees.value[t][node - inner]
    return descend(trees, t, x, 2 * node + (2 if x[trees.feature[t][node]] > trees.threshold[t][node] else 1))


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    inside = {i + k for i, r in enumerate(runs) if runs.count(r) > 1 for k in range(5)} if len(runs) < 400 else None
    if inside is None:
        times = {}
        for r in runs:
            times[r] = times.get(r, 0) + 1
        inside = {i + k for i, r in enumerate(runs) if times[r] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def test_quality_rules(spark, documents):
    read = lambda t: spark.read.parquet(f"{SF}/{t}.parquet")
    trees = quality_rules.learn(read("documents").select("doc_id", "text"), read("labels"))
    found = {r.doc_id: r for r in result(spark, "op2_quality_rules")}
    assert set(found) == set(documents) and len(trees.value)
    for i, text in documents.items():
        r, (n, *more) = found[i], plain_counts(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, *more)
        failed = n < 10 or 100 * more[3] > 20 * n
        x = quality_rules.statistics(text)[1]
        odds = trees.base + sum(descend(trees, t, x) for t in range(len(trees.value)))
        assert r.score == pytest.approx(1 / (1 + np.exp(-np.clip(odds, -40, 40)))) and r.base_failed == failed
        assert r.kept == (not failed and r.score >= 0.5)


def plain_fingerprint(text):
    codes = [ord(c) + 1 for c in text]
    if not codes:
        return []
    k, big = min(winnow.K, len(codes)), 1 << 64
    first, value, values = pow(BASE, k, big), 0, []
    for i, c in enumerate(codes):  # a rolling hash: one character comes, one goes
        value = (value * BASE + c - (codes[i - k] * first if i >= k else 0)) % big
        if i >= k - 1:
            values.append(value)
    hashes = mix(np.array(values, np.uint64)).tolist()
    window = min(winnow.WINDOW, len(hashes))
    chosen = set()
    for lo in range(len(hashes) - window + 1):
        part = hashes[lo : lo + window]
        chosen.add(lo + window - 1 - part[::-1].index(min(part)))
    return [hashes[i] for i in sorted(chosen)]


def test_winnowing(spark, documents):
    ids = sorted(documents)
    prints = {i: plain_fingerprint(documents[i]) for i in ids}
    like = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 1.0
    shown = lambda hashes: "".join(f"{h:016x}" for h in hashes)
    found = {r.doc_id: r for r in result(spark, "op4_winnowing")}
    assert sorted(found) == ids
    for i, nxt in zip(ids, ids[1:] + ids[:1]):
        text, cut = documents[i], len(documents[i]) // 4
        edited = text[: len(text) - cut] + documents[nxt][:cut]
        changed, r = plain_fingerprint(edited), found[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (shown(prints[i]), shown(changed))
        assert r.near_edited == pytest.approx(like(prints[i], changed)) and r.near_next == pytest.approx(like(prints[i], prints[nxt]))


def test_packing(spark, documents):
    tokenizer, rows = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), result(spark, "op5_packing")
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(documents)
    for i, text in documents.items():
        ids, at = [*tokenizer.encode(text, add_special_tokens=False).ids, 1], 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    full = 0
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        ends = np.cumsum([r.length for r in pieces])
        assert [r.offset for r in pieces] == [0, *ends[:-1]] and ends[-1] <= 2048
        full += ends[-1] == 2048
    assert full == len(by_sequence) - 1


def test_token_files(spark, documents):
    tokenizer, at = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    found = {r.doc_id: tuple(r) for r in result(spark, "op8_token_files")}
    assert set(found) == set(documents)
    for i in sorted(documents):
        ids = [*tokenizer.encode(documents[i], add_special_tokens=False).ids, 0]
        assert found[i] == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_byte_bpe(spark, documents):
    ranks = load_tiktoken_bpe(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    whole = tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = {r.doc_id: r for r in result(spark, "op9_byte_bpe")}
    assert set(found) == set(documents)
    for i, text in documents.items():
        ids = whole.encode_ordinary(text)
        assert (found[i].n_tokens, found[i].ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert found[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_classifier(spark, documents):
    read = lambda t: spark.read.parquet(f"{SF}/{t}.parquet")
    model = knn_quality.learn(read("documents").select("doc_id", "text"), read("labels"))
    found = {r.doc_id: r for r in result(spark, "op7_knn_quality")}
    assert set(found) == set(documents)
    for i, text in documents.items():
        x = knn_quality.terms(text).astype(np.float64) * model.idf
        y = (x / max(np.sqrt(sum(v * v for v in x)), 1e-9)) @ model.project.astype(np.float64)
        near = model.vectors.astype(np.float64) @ (y / max(np.sqrt(y @ y), 1e-9))
        best = np.argsort(-near, kind="stable")[:24]
        weight = np.maximum(near[best], 0) ** 4 + 1e-9
        want = (weight * model.labels[best]).sum() / weight.sum() if text else model.prior
        assert found[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and found[i].score == pytest.approx(want, abs=2e-3)
        assert found[i].predicted == int(found[i].score >= 0.3)


def test_classifier_on_held_out_rows(spark):
    folder = SF.replace("0.001", "0.01")
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [(r.score, quality[r.doc_id]) for r in queries.QUERIES["op7_knn_quality"](spark, folder).collect() if r.held_out and r.doc_id in quality]
    good, bad = ([s for s, y in rows if y == k] for k in (1, 0))
    assert len(rows) > 50 and sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad)) > 0.99
