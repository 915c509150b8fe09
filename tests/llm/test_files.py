"""Packing, token files and WARC on small tables, against plain Python and exact round trips."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from maktaba.llm import packing, token_io, tokens, warc
from maktaba.llm.common import shared_dir

FILE = public_tokenizers.path("byte_bpe_50k.json")
EDGES = [(1, None), (2, ""), (3, " \n\t "), (5, "é日本 \u00a0x <|endoftext|> y"), (5, "é日本"), (5, "é日本"), (None, "a null id"), (7, "word and " * 3000), (8, "a" * 5000)]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(FILE)


def ids_of(tokenizer, text, end):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def test_pieces_give_the_library_s_ids(tokenizer):
    random.seed(1)
    parts = ["a", "b", "foo", " ", " ", "\n", "\n", " \n", "\t", "\r", "é", "\xa0", "123", "'s", "!", "<|endoftext|>", "\u3000", "日本", "\x1c", "\x85", "\x00", "x\n"]
    encoder = tokens.PieceEncoder(FILE)
    for _ in range(20):
        texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 40))) for _ in range(200)] + ["", " ", "\n", None]
        ids, counts = encoder.encode(pa.array(texts, pa.string()))
        assert [a.tolist() for a in np.split(ids, np.cumsum(counts)[:-1])] == [ids_of(tokenizer, t, 0)[:-1] for t in texts]


def test_cache_starts_anew(monkeypatch, tokenizer):
    monkeypatch.setattr(tokens, "CACHE_PIECES", 10)
    encoder = tokens.PieceEncoder(FILE)
    for i in range(5):
        text = " ".join(f"w{i}x{k}" for k in range(30))
        assert encoder.encode(pa.array([text]))[0].tolist() == ids_of(tokenizer, text, 0)[:-1]


@pytest.mark.parametrize("window", [16, 2048])
def test_packing(texts, tokenizer, window):
    found = sorted(packing.pack(texts(EDGES), FILE, window=window).collect(), key=lambda r: (r.sequence_id, r.offset))
    at = [(r.sequence_id, r.offset, r.length) for r in found]
    total = sum(len(ids_of(tokenizer, t, 1)) for _, t in EDGES)
    assert sum(n for *_, n in at) == total and [s * window + o for s, o, _ in at] == np.cumsum([0] + [n for *_, n in at])[:-1].tolist()
    assert max(s for s, *_ in at) == (total - 1) // window and all(o + n <= window for _, o, n in at)
    whole = {}
    for r in found:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert len(ids) == r.length
        if r.start == 0:
            whole.setdefault(r.doc_id, []).append([])
        whole[r.doc_id][-1] += ids
        assert len(whole[r.doc_id][-1]) == r.start + r.length <= r.doc_tokens
    want = {}
    for i, t in EDGES:
        want.setdefault(i, []).append(ids_of(tokenizer, t, 1))
    assert {k: sorted(v) for k, v in whole.items()} == {k: sorted(v) for k, v in want.items()}
    joined = packing.sequences(packing.pack(texts(EDGES), FILE, window=window)).collect()
    assert sum(len(r.ids) for r in joined) == 4 * total and max(len(r.ids) for r in joined) <= 4 * window
    assert packing.pack(texts([]), FILE).count() == 0


@pytest.mark.parametrize("at_once", [token_io.DECODE_IDS, 4, 64])
def test_values_round_trip(monkeypatch, at_once):
    monkeypatch.setattr(token_io, "DECODE_IDS", at_once)
    rng = np.random.default_rng(0)
    for n in (0, 1, 3, 4, 5, 1000):
        values = (rng.integers(0, 2**32, n, dtype=np.uint64) >> rng.integers(0, 32, n, dtype=np.uint64)).astype(np.uint32)
        control, data = token_io.encode_values(values)
        assert len(control) == (n + 3) // 4 and token_io.decode_values(control, data, n).tolist() == values.tolist()
    assert len(token_io.encode_values(np.arange(256))[1]) == 256


@pytest.mark.parametrize("block", [token_io.BLOCK_IDS, 4])
def test_token_files(texts, tokenizer, monkeypatch, block):
    monkeypatch.setattr(token_io, "BLOCK_IDS", block)
    found = token_io.store_and_read(texts(EDGES), FILE).collect()
    rows = sorted(EDGES, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, want = 0, []
    for i, t in rows:
        ids = ids_of(tokenizer, t, 0)
        want.append((i, start, len(ids), np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert sorted([(r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in found], key=lambda r: r[1]) == want
    assert token_io.store_and_read(texts([]), FILE).count() == 0


def test_ranks_follow_counts(spark, texts, tokenizer):
    docs = texts([(1, "the the the the of of and")])
    folder = shared_dir(spark, "t")
    token_io.write(docs, FILE, folder).collect()
    fs, path = token_io.filesystem(folder)
    with fs.open_input_stream(f"{path}/ranks.u32") as f:
        ranked = np.frombuffer(f.read(), "<u4").tolist()
    assert ranked[0] == tokenizer.encode(" the").ids[0] and len(ranked) == len(set(ids_of(tokenizer, "the the the the of of and", 0)))


PAGES = [(1, "http://A.com/x?y#z", "same"), (2, None, "same"), (3, "no scheme", None), (9, "http://b.org", ""), (4, "http://c.org/é", "é日本\r\n\r\nWARC/1.1\r\n"), (None, "http://d.org", "same"), (4, "http://c.org/é", "é日本\r\n\r\nWARC/1.1\r\n")]


def captures(spark, rows, **options):
    pages = spark.createDataFrame([(*r, 7) for r in rows], "page_id long, url string, html string, path int")
    return warc.write_and_read(pages, **options).collect()


def test_warc_round_trip(spark):
    found = captures(spark, PAGES)
    name = lambda c: c if c.count(":") == 3 else "again"  # noqa: E731  a repeated id's second capture has a name of its own
    got = sorted(((name(r.capture_id), r.response.record_type, r.response.payload_bytes, r.response.payload_digest, r.response.refers_to) for r in found), key=repr)
    assert len(found) == len(PAGES) and all(r.requests and r.metadata for r in found)
    same, none, last = (warc.base32_digest(x.encode()) for x in ("same", "", PAGES[4][2]))
    uri = warc.record_uri
    assert got == sorted(
        [
            (uri(1, "revisit"), "revisit", 4, same, uri(2, "response")), (uri(2, "response"), "response", 4, same, None), (uri(None, "revisit"), "revisit", 4, same, uri(2, "response")),
            (uri(3, "revisit"), "revisit", 0, none, uri(9, "response")), (uri(9, "response"), "response", 0, none, None),
            (uri(4, "response"), "response", len(PAGES[4][2].encode()), last, None), ("again", "response", len(PAGES[4][2].encode()), last, None),
        ],
        key=repr,
    )
    assert all(r.response.digest_ok for r in found if r.response.record_type == "response")
    for r in found:
        if r.response.record_type == "response":
            assert warc.base32_digest(warc.load_payload(r.response.path, r.response.offset, r.response.length)) == r.response.payload_digest
    assert captures(spark, []) == []


def test_warc_least_bytes(spark):
    kinds = [r.response.record_type for r in captures(spark, PAGES, least_bytes=5)]
    assert kinds == ["response"] * len(PAGES)


def test_records_carry_payloads(spark):
    pages = spark.createDataFrame([PAGES[4]], "page_id long, url string, html string")
    rows = warc.read(warc.write(pages, shared_dir(spark, "w")), payloads=True).collect()
    assert sorted(r.record_type for r in rows) == ["metadata", "request", "response"]
    assert [bytes(r.payload).decode() for r in rows if r.record_type == "response"] == [PAGES[4][2]]


def test_warc_of_repeated_ids_is_linear(spark):
    rows = [(None, f"http://a.org/{i}", "x" * (i % 3)) for i in range(40)] + [(7, "http://b.org", "same")] * 3
    found = captures(spark, rows)
    assert len(found) == 43 and all(len(r.requests) == len(r.metadata) == 1 for r in found)
    ids = [x.record_id for r in found for x in (r.response, *r.requests, *r.metadata)]
    assert len(set(ids)) == len(ids) == 3 * 43


def test_captures_of_other_archives(spark):
    blank = dict.fromkeys(warc.NAMES)
    kinds = [("response", "a", None), ("response", "a", None), ("request", "q", "a"), ("metadata", "m", "z"), ("warcinfo", "w", None)]
    rows = [blank | {"record_type": k, "record_id": i, "concurrent_to": c, "fields": {}} for k, i, c in kinds]
    found = warc.assemble(spark.createDataFrame([tuple(r[n] for n in warc.NAMES) for r in rows], warc.RECORD)).collect()
    assert sorted((r.capture_id, r.response is not None, len(r.requests), len(r.metadata)) for r in found) == [("a", True, 1, 0), ("a", True, 1, 0), ("z", False, 0, 1)]
