"""Suffix-array dedup, n-gram join and components against brute force."""

import random

import numpy as np
import pytest

from maktaba.llm import components, ngram_join, packs, suffix_dedup


def brute_removed(rows, length=suffix_dedup.LENGTH):
    """The kept bytes of each row."""
    data = [(i, (t or "").encode()) for i, t in rows]
    out = []
    for i, t in data:
        smaller = [u for j, u in data if j is not None and (i is None or j < i)]
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - length + 1):
            if any(t[s : s + length] in u for u in smaller):
                gone[s : s + length] = True
        out.append((i, len(t), bytes(b for b, g in zip(t, gone) if not g)))
    return sorted(out, key=repr)


def some_texts(seed, n=40):
    rng = random.Random(seed)
    make = lambda k: "".join(rng.choice(["ab", "c", "é", " ", "the ", "\n"]) for _ in range(k))
    shared = [make(60) for _ in range(4)]
    rows = [(i, make(rng.randint(0, 40)) + (rng.choice(shared) if rng.random() < 0.7 else "") + make(rng.randint(0, 60))) for i in range(n)]
    return rows + [(3, rows[3][1]), (n, rows[5][1]), (n + 1, rows[5][1][10:]), (n + 2, None), (n + 3, ""), (None, rows[5][1]), (n + 4, "a" * 300), (n + 5, "a" * 120), (n + 6, "x" * 20 + shared[0][:49])]


@pytest.mark.parametrize(("pack", "hot"), [(suffix_dedup.PACK_BYTES, suffix_dedup.HOT), (64, suffix_dedup.HOT), (suffix_dedup.PACK_BYTES, 1), (64, 0)])
def test_dedup_against_brute_force(texts, monkeypatch, pack, hot):
    monkeypatch.setattr(suffix_dedup, "PACK_BYTES", pack)  # 64: chunks of single documents
    monkeypatch.setattr(suffix_dedup, "HOT", hot)  # 0 and 1: strings of all or most triggers meet by themselves
    monkeypatch.setattr(suffix_dedup, "CROWDED", hot)
    rows = some_texts(1)
    found = suffix_dedup.dedup(texts(rows)).collect()
    assert sorted([(r.doc_id, r.n_bytes, bytes(r.kept)) for r in found], key=repr) == brute_removed(rows)
    assert all(sum(s.end - s.start for s in r.spans) == r.n_bytes - len(r.kept) for r in found)


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 0])
def test_dedup_in_bundles_of_packs(texts, monkeypatch, hot):
    bundled, to_buckets, sent = suffix_dedup.bundled, suffix_dedup.to_buckets, []
    monkeypatch.setattr(suffix_dedup, "PACK_BYTES", 64)
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "CROWDED", hot)
    monkeypatch.setattr(suffix_dedup, "bundled", lambda packs: bundled(packs.coalesce(1), 40))  # more than the chunks of a part
    monkeypatch.setattr(suffix_dedup, "to_buckets", lambda rows: sent.append(rows.count()) or to_buckets(rows))
    rows = some_texts(4, 60)
    found = suffix_dedup.dedup(texts(rows)).collect()
    assert sorted([(r.doc_id, r.n_bytes, bytes(r.kept)) for r in found], key=repr) == brute_removed(rows)
    assert sent[0] <= 4 * 4 * 3 + 16  # about a blob for a part and a range, not for each of 60 packs and a range


def test_answers_chunk_by_chunk():
    told = suffix_dedup.Answers({1: np.array([5, 6, 7], np.uint8), 3: np.array([8], np.uint8)}, 4)
    assert told.take(np.array([1, 0, 1])).tolist() == [5, 0, 6]
    assert told.take(np.array([], np.int64)).tolist() == []
    assert told.take(np.array([3, 2, 1])).tolist() == [8, 0, 7]


def test_owners_of_phrases():
    for ids in ([7] * 5, [3, -(1 << 62), packs.NO_ID, 3], list(range(0, 900, 3)) * 9, [1 << 40, 5] * 500):
        assert suffix_dedup._owned(*suffix_dedup._owners(np.array(ids, np.int64)), len(ids)).tolist() == ids


def test_dedup_of_a_passage_with_many_surroundings(texts, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", 50)
    monkeypatch.setattr(suffix_dedup, "CROWDED", 50)
    rng = random.Random(8)
    make = lambda k: "".join(rng.choice("abcdefghijklmnop") for _ in range(k))
    passage = make(80)
    rows = [(i, make(rng.randint(30, 60)) + passage + make(rng.randint(30, 60))) for i in range(300)]
    data = np.frombuffer("".join(t for _, t in rows).encode(), np.uint8)
    p = suffix_dedup.Phrases(data, np.concatenate([[0], np.cumsum([len(t) for _, t in rows])]), np.arange(300))
    groups = suffix_dedup.Groups(p, np.full(len(p.trig), suffix_dedup.SPREAD, np.uint8))
    most = max(np.unique(p.trig, return_counts=True)[1])
    spread = [len(which) for _, which in suffix_dedup.Strings(p, groups, np.ones(len(groups.core), bool)).dealt(64)]
    assert most > 200 and max(spread) < 3 * sum(spread) / 64  # a trigger that all share, and strings that fall apart
    found = suffix_dedup.dedup(texts(rows)).collect()
    assert sorted([(r.doc_id, r.n_bytes, bytes(r.kept)) for r in found], key=repr) == brute_removed(rows)


def test_strings_of_groups_against_plain_sets():
    rng = random.Random(9)
    passage = "".join(rng.choice("ab") for _ in range(70))
    rows = [passage[rng.randint(0, 9) : rng.randint(58, 70)] + "".join(rng.choice("ab") for _ in range(rng.randint(0, 9))) for _ in range(60)]
    ids = np.array([rng.randint(-3, 40) for _ in rows[1:]] + [packs.NO_ID])
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in rows])])
    p = suffix_dedup.Phrases(np.frombuffer("".join(rows).encode(), np.uint8), offsets, ids)
    groups = suffix_dedup.Groups(p, np.full(len(p.trig), suffix_dedup.SPREAD, np.uint8))
    hit = suffix_dedup.held_strings(groups.doc[groups.sent], groups.facts[groups.sent], suffix_dedup.CROWDED)
    place = {int(x): i for i, x in enumerate(groups.sent)}
    answers = {b: hit[[place[int(x)] for x in which]].tobytes() for b, which in groups.dealt(8)}
    data, least = "".join(rows), {}
    spots = [(int(a) + i, d) for a, t, d in zip(offsets, rows, ids) for i in range(len(t) - suffix_dedup.LENGTH + 1)]
    for at, d in spots:
        string = data[at : at + suffix_dedup.LENGTH]
        least[string] = min(least.get(string, d), d)
    assert sorted(groups.answered(answers, 8)[0].tolist()) == [at for at, d in spots if least[data[at : at + suffix_dedup.LENGTH]] < d]


def test_narrow_numbers():
    for ids in ([5], [-3, 252], [7, 7 + (1 << 20)], [-(1 << 63), packs.NO_ID, 0]):
        assert suffix_dedup.wide(suffix_dedup.narrow(np.array(ids, np.int64)), len(ids)).tolist() == ids


def test_dedup_exact_length(texts):
    rng = random.Random(2)
    make = lambda k: "".join(rng.choice("abcdefghijklmnop") for _ in range(k))
    fifty, short = make(50), make(49)
    rows = [(1, make(30) + fifty + "1" + short + "2"), (2, "3" + fifty + "4" + short + "5"), (3, short)]
    found = {r.doc_id: bytes(r.kept).decode() for r in suffix_dedup.dedup(texts(rows)).collect()}
    assert found == {1: rows[0][1], 2: "34" + short + "5", 3: short}
    assert suffix_dedup.dedup(texts([])).count() == 0


def test_cut_repeats_keeps_columns(texts):
    passage = "".join(random.Random(3).choice("abcdefgh") for _ in range(80))
    docs = texts([(1, passage), (2, "é" + passage + "é"), (3, None)])
    found = suffix_dedup.cut_repeats(docs, length_column="n")
    assert found.columns == docs.columns and found.schema["n"].dataType == docs.schema["n"].dataType
    got = {r.doc_id: (r.text, r.n, r.tokens, r._id) for r in found.collect()}
    assert got == {1: (passage, 1, 1, "y"), 2: ("éé", 2, 1, "y"), 3: (None, 1, 1, "y")}


def test_string_ranks():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 99, 400).astype(np.uint8)
    data[200:280] = data[20:100]
    ranks = suffix_dedup.string_ranks(data)
    padded = data.tobytes() + bytes(50)
    strings = [padded[i : i + 50] for i in range(400)]
    order = {s: k for k, s in enumerate(sorted(set(strings)))}
    want = np.array([order[s] for s in strings])
    assert (np.argsort(np.argsort(want, kind="stable")) == np.argsort(np.argsort(ranks, kind="stable"))).all()
    assert len(set(zip(want.tolist(), ranks.tolist()))) == len(order)


def brute_sets(text):
    words = [w.decode() for w in (text or "").encode().lower().split()]
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute_join(rows):
    sets = [brute_sets(t) for _, t in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and rows[i][0] is not None and rows[j][0] is not None and 100 * both >= 80 * len(sets[i] | sets[j]):
                top[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted([(d, len(sets[i]), None if d is None else least[find(i)]) for i, (d, _) in enumerate(rows)], key=repr)


def near_copies(seed, bases=6, copies=9):
    rng = random.Random(seed)
    rows, doc = [], 0
    for _ in range(bases):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([7, 40, 120]))]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(words) // 18))):
                words[rng.randrange(len(words))] = f"x{rng.randint(0, 10**6)}"
            rows.append((doc, rng.choice([" ", "\n"]).join(words).replace("w1", "W1" if rng.random() < 0.5 else "w1")))
            doc += 1
    rng.shuffle(rows)
    return rows


EDGES = [(900, None), (901, ""), (902, " \t\n"), (903, "one Two"), (904, "ONE two"), (905, "one two three"), (906, "one two"), (906, "one two"), (None, "one two"), (907, "a b c d e " * 2000), (908, "a b c d e " * 2000)]


@pytest.mark.parametrize(("seed", "centres", "left"), [(1, ngram_join.CENTRES, ngram_join.LEFT_PER_ENTRY), (2, 1, 30), (3, 1, 0)])
def test_join_against_brute_force(texts, monkeypatch, seed, centres, left):
    monkeypatch.setattr(ngram_join, "CENTRES", centres)  # few centres and no allowance: many rounds
    monkeypatch.setattr(ngram_join, "LEFT_PER_ENTRY", left)
    rows = near_copies(seed) + EDGES
    found = ngram_join.join(texts(rows))
    assert sorted([tuple(r) for r in found.collect()], key=repr) == brute_join(rows)


@pytest.mark.parametrize(("rest", "asks"), [(89, True), (88, False)])
def test_sets_are_compared_only_where_their_first_common_token_may_stand(spark, rest, asks):
    # Sets of 100 that link share 89 members, so no less stands from their first common token on.
    entries = spark.createDataFrame([(7, i, 100, rest, i) for i in range(20)], "token long, node long, n long, rest long, label long")
    open_tokens = spark.createDataFrame([(7, 0)], "token long, lo long")
    assert bool(ngram_join.centre_trees(entries, 0)[0].count()) == asks
    assert bool(ngram_join.block_trees(entries, open_tokens)[0].count()) == asks


def test_join_of_very_long_texts(texts):
    words = [f"w{i}" for i in range(110_000)]
    rows = [(3, " ".join(words)), (5, " ".join([*words[:60_000], "x", *words[60_001:]])), (7, " ".join(reversed(words)))]
    found = ngram_join.join(texts(rows))
    assert sorted(tuple(r) for r in found.collect()) == [(3, 109_996, 3), (5, 109_996, 3), (7, 109_996, 7)]


def test_join_of_nothing(texts):
    assert ngram_join.join(texts([])).count() == 0
    assert [tuple(r) for r in ngram_join.join(texts([(4, None)])).collect()] == [(4, 0, 4)]


def test_keep_one(texts):
    rows = near_copies(5, bases=3) + EDGES
    docs = texts(rows)
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns and {r.text for r in kept.collect() if r.doc_id == 900} == {None}
    want = {c for _, _, c in brute_join(rows) if c is not None}
    assert {r.doc_id for r in kept.collect()} == want | {None} and kept.count() == len(want) + 1


def test_prefix_tree():
    rng = np.random.default_rng(6)
    base = np.unique(rng.integers(0, 2**63, 300).astype(np.uint64))
    sets = [np.sort(rng.permutation(base)[: rng.integers(200, len(base))]) for _ in range(30)] + [base, base[:10]]
    tree = ngram_join.PrefixTree(sets)
    for x in sets:
        want = [i for i, s in enumerate(sets) if 100 * len(np.intersect1d(s, x)) >= 80 * len(np.union1d(s, x))]
        assert sorted(tree.alike(x)) == want


def test_components(spark):
    rng = random.Random(7)
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 102), (5, 5)] + [(200, rng.randint(201, 240)) for _ in range(60)]
    got = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = {}
    for a, b in edges:
        if a != b:
            for x in (a, b):
                want[x] = 0 if x <= 60 else 100 if x in (100, 101) else 102 if x in (102, 103) else 200
    assert got == want
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
