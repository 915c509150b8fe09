"""Quality rules, winnowing, classifier, byte BPE and URL rules on small tables, against plain Python."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from maktaba.llm import bpe, gbt, knn_quality, quality_rules, url_rules, winnow

EDGES = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "é日本 \u00a0x"), (5, "é日本 \u00a0x"), (None, "a null id"), (7, "word " * 30_000), (8, "a" * 50_000)]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def brute_counts(text):
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many = {w for w in windows if windows.count(w) > 1} if len(windows) < 500 else {w for w in set(windows) if windows.count(w) > 1}
    inside = {i + k for i, w in enumerate(windows) if w in many for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(inside)


def test_counts_against_brute_force():
    random.seed(3)
    cases = [None, "", "a\n\na\n a", "x " * 40] + ["".join(random.choice(["a", "b ", "c\n", " ", "#|", "é", "\u00a0", "\x0b"]) for _ in range(120)) for _ in range(60)]
    for text in cases:
        assert quality_rules.statistics(text)[0] == brute_counts(text)


def test_repeated_words_with_many_kinds():
    words = [str(i).encode() for i in range(9000)] + [b"a", b"b", b"c", b"d", b"e", b"f"] * 2
    assert quality_rules.repeated_words(words) == 12


def test_quality_rules_cases(spark, texts):
    docs = texts(EDGES)
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (7, None)], "doc_id long, quality int")
    trees = quality_rules.learn(docs, labels)
    found = quality_rules.judge(docs, trees)
    assert found.count() == len(EDGES)
    got = {(r.doc_id, r.n_words): r for r in found.collect()}
    assert got[1, 0].base_failed and not got[1, 0].kept
    assert got[7, 30_000].base_failed and got[7, 30_000].n_repeat_words == 30_000
    assert quality_rules.judge(texts([]), trees).count() == 0
    kept = quality_rules.keep(docs, trees)
    assert kept.columns == docs.columns


def test_trees_learn_and_keep_monotone():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] < 0.5) ^ (rng.random(3000) < 0.05)).astype(float)
    trees = gbt.fit(x, y, np.array([-1, 0, 0]))
    assert ((trees.score(x) > 0.5) == (x[:, 0] < 0.5)).mean() > 0.97
    line = np.tile(rng.random(3), (200, 1))
    line[:, 0] = np.linspace(0, 1, 200)
    assert (np.diff(trees.margin(line)) <= 1e-12).all()


def test_trees_of_equal_gains_and_of_one_label():
    y = np.repeat([0.0, 1.0], 100)
    x = np.stack([np.ones(200), y, y], 1)
    trees = gbt.fit(x, y, np.zeros(3, int), trees=3)
    assert (trees.feature[:, 0] == 1).all() and (trees.threshold[:, 0] == 0).all()
    for rows, share in ((x[:0], 0.5), (x[100:], 1 - 1e-6), (x[90:105], 1 / 3)):
        trees = gbt.fit(rows, rows[:, 1], np.zeros(3, int))
        assert len(trees.value) == 0 and trees.score(x) == pytest.approx(np.full(200, share))


def test_classifier_learns_and_handles_cases(spark, texts):
    random.seed(1)
    clean = [(i, " ".join(random.choice(["the", "tion", "and", "re"]) for _ in range(60))) for i in range(100, 300)]
    junk = [(i, " ".join(random.choice(["BUY!!", "NOW!!", "###"]) for _ in range(60))) for i in range(300, 400)]
    docs = texts(clean + junk + EDGES)
    labels = spark.createDataFrame([(i, int(i < 300)) for i, _ in clean + junk] + [(None, 1)], "doc_id long, quality int")
    model = knn_quality.learn(docs, labels)
    rows = knn_quality.classify(docs, model).collect()
    assert len(rows) == 300 + len(EDGES) and all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id and 100 <= r.doc_id < 400]
    assert held and all(r.predicted == int(r.doc_id < 300) for r in held)
    empty = [r.score for r in rows if r.doc_id in (1, 2)]
    assert empty == [pytest.approx(model.prior)] * 2
    assert knn_quality.classify(texts([]), model).count() == 0
    assert knn_quality.classify(docs, knn_quality.learn(docs, labels.limit(0))).first().score == 0.5


def test_classifier_neighbours_against_plain_products():
    rng = np.random.default_rng(5)
    x = np.abs(rng.standard_normal((60, knn_quality.TERMS))).astype(np.float32)
    model = knn_quality.fit(x[:40], (rng.random(40) < 0.5).astype(float), rank=8)
    near = knn_quality._unit(knn_quality._weigh(x[40:], model.idf) @ model.project) @ model.vectors.T
    for row, got in zip(near, knn_quality.score(model, x[40:], neighbours=5)):
        best = np.argsort(-row, kind="stable")[:5]
        weight = np.maximum(row[best].astype(float), 0) ** 4 + 1e-9
        assert got == pytest.approx((weight * model.labels[best]).sum() / weight.sum())


def brute_winnow(text):
    codes = np.array([ord(c) for c in text], np.uint32)
    hashes = winnow.kgram_hashes(codes)
    window = min(winnow.WINDOW, len(hashes))
    return sorted({max(j for j in range(i, i + window) if hashes[j] == hashes[i : i + window].min()) for i in range(len(hashes) - window + 1)})


def test_winnowing_against_brute_force(monkeypatch):
    random.seed(2)
    cases = ["ab" * 150, "a" * 400] + ["".join(random.choice("abc é") for _ in range(n)) for n in (16, 17, 63, 64, 65, 500)]
    for piece in (winnow.PIECE, 100):
        monkeypatch.setattr(winnow, "PIECE", piece)
        for text in cases:
            assert winnow.fingerprint(text)[1].tolist() == brute_winnow(text)


def test_shared_passage_shares_a_fingerprint():
    random.seed(4)
    make = lambda n: "".join(random.choice("abcdefgh ") for _ in range(n))
    passage = make(winnow.WINDOW + winnow.K - 1)
    a, b = make(300) + passage + make(200), make(77) + passage + make(500)
    assert set(winnow.fingerprint(a)[0].tolist()) & set(winnow.fingerprint(b)[0].tolist())


def test_winnowing_query_cases(texts):
    rows = sorted(EDGES, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    found = winnow.compare_with_next(texts(EDGES)).collect()
    want = []
    for i, (doc, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        n = len(text) // 4
        want.append((doc, len(text), hashlib.sha256((text[: len(text) - n] + after[:n]).encode()).hexdigest()))
    assert sorted([tuple(r)[:3] for r in found], key=repr) == sorted(want, key=repr)
    assert winnow.compare_with_next(texts([])).count() == 0
    only = winnow.compare_with_next(texts([(1, "just this text, alone")])).first()
    assert only.near_next == 1.0
    assert winnow.fingerprints(texts(EDGES)).count() == len(EDGES)


FILE, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def test_bpe_pieces_join_up(monkeypatch):
    random.seed(6)
    enc = bpe.encoding(FILE, PATTERN)
    monkeypatch.setattr(bpe, "PIECE_CHARS", 20)
    for _ in range(300):
        text = "".join(random.choice(["foo", " ", "  ", "\n", "\u00a0", "é", "'s", "12", "\u3000", "!", "\x1c"]) for _ in range(80))
        assert "".join(bpe.safe_pieces(text, 20)) == text
        assert bpe.encode_text(enc, text).tolist() == enc.encode_ordinary(text)


def test_bpe_pieces_without_spaces(monkeypatch):
    random.seed(8)
    enc = bpe.encoding(FILE, PATTERN)
    monkeypatch.setattr(bpe, "PIECE_CHARS", 20)
    kinds = ["字", "日本", "。", "，", "ab", "É", "é", "e\u0301", "7", "42", "'s", "'", "'ll", "!", "/", "+", "\n", "\u00a0", "ة", "؟", "가", "_"]
    for _ in range(500):
        text = "".join(random.choice(kinds) for _ in range(90))
        assert "".join(bpe.safe_pieces(text, 20)) == text
        assert bpe.encode_text(enc, text).tolist() == enc.encode_ordinary(text)
    assert max(map(len, bpe.safe_pieces("字字字。" * 50_000, 1000))) < 1010
    assert max(map(len, bpe.safe_pieces("aGVsbG8x+/9" * 20_000, 1000))) < 1020
    assert list(bpe.safe_pieces("a" * 5000, 1000)) == ["a" * 5000]


def test_whole_texts_without_spaces_for_the_tokenizers_library():
    from tokenizers import Tokenizer

    random.seed(9)
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    for _ in range(200):
        text = "".join(random.choice(["字", "。", "ab", "é", "7", "'s", "'", "!", "/", "\n", "\u00a0", "ة", " "]) for _ in range(200))
        pieces = [i for p in bpe.safe_pieces(text, 20) for i in whole.encode(p, add_special_tokens=False).ids]
        assert pieces == whole.encode(text, add_special_tokens=False).ids


def test_bpe_round_trip(texts):
    found = bpe.decode(bpe.encode(texts(EDGES), FILE, PATTERN), FILE, PATTERN).collect()
    assert sorted((r.doc_id, bytes(r.decoded).decode()) for r in found if r.doc_id) == sorted((i, t or "") for i, t in EDGES if i)
    assert all(r.n_tokens * 4 == len(r.ids) for r in found)
    assert rows_of(bpe.encode(texts(EDGES), FILE, PATTERN, decoded=True)) == sorted((tuple(r) for r in found), key=repr)
    assert bpe.encode(texts([]), FILE, PATTERN).count() == 0


def brute_rule(rules, host, path):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (r.host.count("."), len(r.path), r.action == "block"), default=None)


def test_trie_against_brute_force():
    random.seed(7)
    hosts = ["com", "a.com", "b.a.com", "net", "x.net", ".com", "", "com."]
    paths = ["", "/", "/e", "/en", "/en/", "/en/x", "/fr/", "/en//"]
    for _ in range(200):
        rules = [url_rules.Rule(random.choice(["allow", "block"]), random.choice(hosts[:5]), random.choice(paths)) for _ in range(6)]
        trie = url_rules.RuleTrie(rules)
        for host in hosts + ["www.b.a.com", "acom"]:
            for path in paths:
                want, got = brute_rule(rules, host, path), trie.find(host, path)
                assert (want and (want.action, want.name)) == (got and (got.action, got.name))


@pytest.mark.parametrize("limit", [url_rules.MAX_TRIE_CHARS, 1])
@pytest.mark.parametrize("actions", [("allow", "block"), ("block", "allow")])
def test_block_wins_among_equal_rules(spark, monkeypatch, limit, actions):
    monkeypatch.setattr(url_rules, "MAX_TRIE_CHARS", limit)
    pages = spark.createDataFrame([(1, "http://a.com/x/y")], "page_id long, url string")
    assert url_rules.judge_urls(pages, [url_rules.Rule(a, "a.com", "/x") for a in actions]).first().verdict == "block"


@pytest.mark.parametrize("limit", [url_rules.MAX_TRIE_CHARS, 1])
def test_url_cases(spark, monkeypatch, limit):
    monkeypatch.setattr(url_rules, "MAX_TRIE_CHARS", limit)  # one trie, or one per rule
    rules = [url_rules.Rule("allow", "com"), url_rules.Rule("block", "example.com", "/en/"), url_rules.Rule("allow", "www.example.com", "/en/")]
    urls = {1: None, 2: "no scheme.com/x", 3: "http://WWW.Example.com/en/a?q", 4: "http://blog.example.com/en/", 5: "http://a.com", 6: "http://a.com#/x", 7: "x://y://z.com/", 8: "http://a.org/en/"}
    pages = spark.createDataFrame(list(urls.items()) + [(3, urls[3])], "page_id long, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge_urls(pages, rules, default="block").collect()}
    assert got == {
        1: ("", "", None, "block"), 2: ("", "", None, "block"), 3: ("www.example.com", "/en/a", "www.example.com/en/", "allow"), 4: ("blog.example.com", "/en/", "example.com/en/", "block"),
        5: ("a.com", "", None, "block"), 6: ("a.com", "", None, "block"), 7: ("y:", "//z.com/", None, "block"), 8: ("a.org", "/en/", None, "block"),
    }
    assert url_rules.judge_urls(pages.limit(0), rules).count() == 0


def test_url_rules_of_one_host_are_looked_up(spark):
    rules = [url_rules.Rule("block", "a.com", f"/p{i}x") for i in range(10_000)] + [url_rules.Rule("allow", "a.com", "/p77x/deep/")]
    trie = url_rules.RuleTrie(rules)
    node = trie.root.below["com"].below["a"].paths.below[""]
    assert len(node.rules) == 10_000 and node.lengths == [6, 5, 4, 3]
    assert trie.find("b.a.com", "/p4321xyz").path == "/p4321x" and trie.find("a.com", "/p77x/deep/z").action == "allow" and trie.find("a.com", "/q") is None


def test_url_rules_beside_other_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x", "h", "p", "r", "v", 3)], "page_id long, url string, host string, path string, _rule string, verdict string, _new int")
    assert tuple(url_rules.judge_urls(pages, [url_rules.Rule("block", "a.com", "/x")]).first()) == (1, "a.com", "/x", "a.com/x", "block")
