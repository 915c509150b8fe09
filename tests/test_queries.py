"""Every query with SQL against DuckDB, on the smallest tables."""

import hashlib
import json
import math
from pathlib import Path

import duckdb
import pytest

from maktaba.plans import registry
from maktaba.plans.laws import laws

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the test tables")


def plain(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return None
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    return round(x, 9) if isinstance(x, float) else x


@pytest.fixture(scope="module")
def tables():
    found = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        found.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return found


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, tables, name):
    got = registry.QUERIES[name](spark, SF)
    want = tables.sql(registry.ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=repr)
    assert rows == sorted((tuple(map(plain, r)) for r in want.select(*[f'"{c}"' for c in columns]).fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_query_runs(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0


def test_word_changes_of_whole_texts(spark):
    texts = {r.doc_id: r.text for r in laws(spark, SF).collect()}
    got = {r.doc_id: r.changed for r in registry.QUERIES["word_changes"](spark, SF).collect()}
    words = lambda t: set(t.lower().split())
    assert got == {i: len(words(t) ^ words(t.replace("th", "ht"))) for i, t in texts.items()}


def whole_pages(spark):
    """The words of the texts of each law in order, with those of its added pages."""
    found = {}
    for r in sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda r: r.doc_id):
        found.setdefault(r.doc_id // 10, []).extend((r.text or "").split())
    return {i: w + (["page", "7", "du", "scan"] * 10 if i % 3 == 0 else []) for i, w in found.items()}


def test_pages_of_whole_texts(spark):
    want = whole_pages(spark)
    concat = {r.doc_id: r for r in registry.QUERIES["page_concat"](spark, SF).collect()}
    assert {i: r.full_text.split() for i, r in concat.items()} == want
    assert all(r.total_pages == (30 if i % 3 == 0 else 10) for i, r in concat.items())
    scanned = {r.doc_id: r.is_scanned for r in registry.QUERIES["scanned_docs"](spark, SF).collect()}
    assert set(scanned.values()) == {True, False} and all(scanned[i] for i in want if i % 3 == 0)
    choice = {r.doc_id: r for r in registry.QUERIES["ocr_choice"](spark, SF).collect()}
    assert {i: r.full_text.split() for i, r in choice.items()} == {i: w + (["OCR"] if choice[i].used_ocr else []) for i, w in want.items()}
    assert all(r.used_ocr == (scanned[i] and i % 2 == 0) for i, r in choice.items())


def test_envelopes_of_whole_texts(spark):
    got = {r.doc_id: json.loads(r.envelope)["extraction"] for r in registry.QUERIES["envelopes"](spark, SF).collect()}
    assert {i: x["full_text"].split() for i, x in got.items()} == whole_pages(spark)
    assert {x["is_scanned"] for x in got.values()} == {True, False}


def test_all_articles_are_assembled(spark):
    places = sorted((r.doc_id, r.ord) for r in registry.QUERIES["article_split"](spark, SF).collect())
    rows = {(r.doc_id, r.ord): r for r in registry.QUERIES["assemble"](spark, SF).collect()}
    assert sorted(rows) == places
    for one, two in zip(places, places[1:]):
        if one[0] == two[0]:
            assert rows[one].following_article_id == rows[two].article_id and rows[two].preceding_article_id == rows[one].article_id
    for r in rows.values():
        assert r.content_hash_sha256 == hashlib.sha256((r.content_french + r.content_arabic).encode()).hexdigest()
    for name in ("article_report", "article_log"):
        assert sorted((r.doc_id, r.ord) for r in registry.QUERIES[name](spark, SF).collect()) == places


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
