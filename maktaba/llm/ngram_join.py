"""N-gram Jaccard join with prefix trees: documents whose sets of word n-grams are alike, and their components.

A document's set holds the 64-bit hashes of its distinct N-word shingles (A-Z lower-cased, words split at ASCII white
space); a text with fewer words has one shingle, all its words. Two documents link when
100 * intersection >= 100 * SIMILARITY * union. All steps are exact; hashes stand for shingles.

1. Equal sets form a class, and the least id stands for it.
2. A document that links with another shares all but a fifth of its set with it. Shingles whose hash lies below SKETCH
   are counted over all classes; a class with too few of them in any other class links with nothing and drops out here.
3. Among the rest all shingles are counted. The order of a set is rarest first. Two linked sets share a shingle within
   the first fifth (and one more) of either, so only those places are indexed, and there only shingles that two sets hold.
4. Sets that share such a place are compared. In a large group of alike sets most pairs need no comparison, as a few
   links already put the sets into one component: first each member meets a few of its group (centres), then only pairs
   between different components are left, and all of these are compared.
5. A member meets its candidates in a prefix tree of their ordered sets: shared beginnings are counted once, and a
   subtree is left as soon as the remaining length can't bring the overlap to the least that a link needs.

Texts and sets lie in files of the shared folder; what travels is 32 bits of a shingle in blobs by hash range, an answer
per blob, and the sets that a task compares.

Cases: null or empty texts, or texts of white space, have an empty set, link with nothing and are their own component;
rows with equal ids and texts give equal rows; a null id gives the component null, and its row links with nothing; very
long texts are taken whole; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE, RangeHash, collecting, drop, filesystem, flat_bytes, mix, partitions, shared_dir, staged, text_slices
from .components import components
from .packs import by_bucket, carry_all, open_pack, pick, to_buckets, write_packs

N = 5
#: 100 * intersection >= PERCENT * union
PERCENT = 80
#: Share of the hash range whose shingles are counted first.
SKETCH = 0.35
TOP = int(SKETCH * 2**64)
#: Members of a group that all others meet first, at most; each further round doubles them.
CENTRES = 16
#: Pairs left per index entry up to which all of them are compared at once; above it another round of centres comes first.
LEFT_PER_ENTRY = 100
MAX_ROUNDS = 6
#: Nodes in a tree of the last round, about.
BLOCK = 64
#: Members that ask the trees of one home in one place, about.
ASKERS = 2048
#: Bytes of sets that members of one key have, about, as a task holds the sets of a key.
KEY_BYTES = 32 << 20
SLICE_BYTES = 6 << 20
#: Bytes of copies of one set that leave a task at a time.
COPY_BYTES = 2 << 20
_WHITE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the n+1 offsets of the texts among them."""
    data, offsets = flat_bytes(texts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    inside = ~_WHITE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, after = np.concatenate([[False], inside[:-1]]), np.concatenate([inside[1:], [False]])
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return RangeHash(_LOWER[data])(starts, ends), np.searchsorted(starts, offsets)


def shingle_sets(texts: pa.Array, n: int = N) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, offsets = word_hashes(texts)
    many = max(0, len(words) - n + 1)
    joined = np.zeros(many, np.uint64)
    for k in range(n):
        joined = joined * np.uint64(BASE) + words[k : k + many]
    joined = mix(joined)
    out = []
    for a, b in zip(offsets[:-1], offsets[1:]):
        if b - a >= n:
            out.append(np.unique(joined[a : b - n + 1]))
        elif b > a:
            whole = np.uint64(b - a)
            for w in words[a:b]:
                whole = _fold(whole, w)
            out.append(np.array([whole], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _fold(a: np.uint64, b: np.uint64) -> np.uint64:
    return mix(np.array([a], np.uint64) * np.uint64(BASE) + np.array([b], np.uint64))[0]


def _set_keys(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit keys of a set, the same for equal sets."""
    one, two = mix(s + np.uint64(1)).sum(dtype=np.uint64), mix(s ^ np.uint64(BASE)).sum(dtype=np.uint64)
    return int(one.view(np.int64)), int(two.view(np.int64))


def slack(n):
    """How many members of a set of n may lack in a set that links with it, at most."""
    return n * (100 - PERCENT) // 100


class PackSets:
    """The sets of a pack's documents: one owner per distinct set, in order of appearance."""

    def __init__(self, pack: str):
        self.ids, self.known, offsets, data = open_pack(pack)
        buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
        texts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.ids), buffers)
        self.sets = shingle_sets(texts)
        self.keys = [_set_keys(s) for s in self.sets]
        first: dict[int, int] = {}
        self.owner = [first.setdefault(k, len(first)) if len(s) else -1 for (k, _), s in zip(self.keys, self.sets)]
        self.owners = _first_places(self.owner, len(first))

    def low(self, i: int) -> int:
        """How many members of a document's set lie below SKETCH."""
        return int(np.searchsorted(self.sets[i], np.uint64(TOP)))


def _first_places(owner: list[int], n: int) -> list[int]:
    out = [-1] * n
    for i, o in enumerate(owner):
        if o >= 0 and out[o] < 0:
            out[o] = i
    return out


class Deal:
    """Shingles of several sets by hash range: for each bucket its values' places in `values`, ascending by value within a set."""

    def __init__(self, sets: list[np.ndarray], buckets: int, top: int):
        self.values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        self.set = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        width = top // buckets + 1
        bucket = (self.values // np.uint64(width)).astype(np.int32) if buckets > 1 else np.zeros(len(self.values), np.int32)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        self.parts = [(int(bucket[p[0]]), p) for p in np.split(order, cuts) if len(p)]
        self._width, self._shift = width, np.uint64(max(0, width.bit_length() - 32))

    def short(self, bucket: int, places: np.ndarray) -> bytes:
        """32 bits of each value's place in its bucket. Values that share them only make the work more, never less."""
        return ((self.values[places] - np.uint64(bucket * self._width)) >> self._shift).astype("<u4").tobytes()


def _answers(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["pack", "bucket", "answer"])


def _ask(packs: DataFrame, send, answer, blob: str) -> DataFrame:
    """pack and answers (bucket, answer): what `answer` makes of each blob that `send` makes of the packs."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_bucket(batches):
            yield _answers(answer(rows))

    sent = packs.repartition(partitions(packs)).mapInArrow(send, f"pack string, bucket int, {blob}")
    found = to_buckets(sent).mapInArrow(meet, "pack string, bucket int, answer binary")
    return found.groupBy("pack").agg(F.collect_list(F.struct("bucket", "answer")).alias("answers"))


def document_sets(packs: DataFrame) -> DataFrame:
    """pack, place, _id, n, key1 and key2 of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack in batch.column("pack").to_pylist():
                p = PackSets(pack)
                n = len(p.ids)
                arrays = [pa.array([pack] * n), pa.array(np.arange(n)), pa.array(p.ids, mask=~p.known), pa.array([len(s) for s in p.sets], pa.int64()), pa.array([k for k, _ in p.keys], pa.int64()), pa.array([k for _, k in p.keys], pa.int64())]
                yield pa.RecordBatch.from_arrays(arrays, names=["pack", "place", "_id", "n", "key1", "key2"])

    return packs.select("pack").repartition(partitions(packs)).mapInArrow(run, "pack string, place long, _id long, n long, key1 long, key2 long")


def shared_in_sketch(packs: DataFrame, buckets: int) -> DataFrame:
    """Step 2. For each blob: of each owner in it, how many of its members another class holds too."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack in batch.column("pack").to_pylist():
                p = PackSets(pack)
                low = [p.sets[i][: p.low(i)] for i in p.owners]
                deal, keys = Deal(low, buckets, TOP), np.array([p.keys[i][0] for i in p.owners], np.int64)
                rows = []
                for bucket, places in deal.parts:
                    here, at = np.unique(deal.set[places], return_inverse=True)
                    rows.append((pack, bucket, keys[here].astype("<i8").tobytes(), at.astype("<u4" if len(here) > 1 << 16 else "<u2").tobytes(), deal.short(bucket, places)))
                if rows:
                    kinds = [pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["pack", "bucket", "owners", "at", "tokens"])

    def answer(rows: list[dict]) -> list[tuple]:
        tokens = [np.frombuffer(r["tokens"], "<u4") for r in rows]
        owners = [np.frombuffer(r["owners"], "<i8") for r in rows]
        at = [np.frombuffer(r["at"], f"<u{len(r['at']) // len(t)}").astype(np.int64) for r, t in zip(rows, tokens)]
        t, o = np.concatenate(tokens), np.concatenate([o[a] for o, a in zip(owners, at)])
        order = np.lexsort((o, t))
        t, o = t[order], o[order]
        # A token is shared if the owners of its run are not all the same.
        starts = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
        ends = np.append(starts[1:], len(t))
        shared = np.empty(len(t), bool)
        shared[order] = np.repeat(o[starts] != o[ends - 1], ends - starts)
        out, lo = [], 0
        for r, own, a in zip(rows, owners, at):
            counts = np.bincount(a[shared[lo : lo + len(a)]], minlength=len(own))
            lo += len(a)
            if counts.any():
                out.append((r["pack"], r["bucket"], zlib.compress(counts.astype("<u4").tobytes(), 1)))
        return out

    return _ask(packs, send, answer, "owners binary, at binary, tokens binary")


def write_sets(packs: DataFrame, documents: DataFrame, shared: DataFrame, buckets: int, folder: str) -> DataFrame:
    """Writes the sets of the classes that step 2 leaves, and returns the manifest: pack, nodes and sizes of each file.

    A class has the first key of its set as node; its document with the least id stands for it.
    """
    chosen = documents.filter("n > 0 and _id is not null").groupBy("key1", "key2", "n").agg(F.min(F.struct("_id", "pack", "place")).alias("c"))
    chosen = chosen.groupBy("c.pack").agg(F.collect_list("c.place").alias("places"))  # of one pack, a few hundred at most
    rows = packs.select("pack").join(chosen, "pack").join(shared, "pack", "left")

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = filesystem(folder)
        fs.create_dir(root, recursive=True)
        for batch in batches:
            for pack, places, answers in zip(*(batch.column(c).to_pylist() for c in ("pack", "places", "answers"))):
                p = PackSets(pack)
                deal = Deal([p.sets[i][: p.low(i)] for i in p.owners], buckets, TOP)
                counts, given = np.zeros(len(p.owners), np.int64), {x["bucket"]: x["answer"] for x in answers or []}
                for bucket, places_ in deal.parts:
                    if bucket in given:
                        counts[np.unique(deal.set[places_])] += np.frombuffer(zlib.decompress(given[bucket]), "<u4")
                able = [i for i in sorted(places) if counts[p.owner[i]] >= p.low(i) - slack(len(p.sets[i]))]
                if able:
                    name = uuid.uuid4().hex
                    with fs.open_output_stream(f"{root}/{name}") as f:
                        for i in able:
                            f.write(p.sets[i].astype("<u8").tobytes())
                    nodes, sizes = np.array([p.keys[i][0] for i in able], "<i8"), np.array([len(p.sets[i]) for i in able], "<i8")
                    yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([nodes.tobytes()], pa.binary()), pa.array([sizes.tobytes()], pa.binary())], names=["pack", "nodes", "sizes"])

    return staged(rows.repartition(partitions(packs)).mapInArrow(save, "pack string, nodes binary, sizes binary"), "sets")


def open_sets(pack: str, sizes: np.ndarray) -> list[np.ndarray]:
    fs, path = filesystem(pack)
    with fs.open_input_stream(path) as f:
        return np.split(np.frombuffer(f.read(), "<u8"), np.cumsum(sizes)[:-1])


def index_entries(files: DataFrame, buckets: int) -> DataFrame:
    """Step 3: token, node, n and rest of the indexed places: rest members of the set, the token too, stand from there on."""
    manifest = files.select("pack", "sizes", "nodes")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack, sizes in zip(batch.column("pack").to_pylist(), batch.column("sizes").to_pylist()):
                deal = Deal(open_sets(pack, np.frombuffer(sizes, "<i8")), buckets, 2**64)
                rows = [(pack, bucket, deal.short(bucket, places)) for bucket, places in deal.parts]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate([pa.string(), pa.int32(), pa.binary()])], names=["pack", "bucket", "tokens"])

    def answer(rows: list[dict]) -> list[tuple]:
        # Each class is in one file only, so a token's count is the number of classes that hold it.
        tokens = [np.frombuffer(r["tokens"], "<u4") for r in rows]
        _, inverse, counts = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
        times = counts[inverse].astype("<u4")
        return [(r["pack"], r["bucket"], zlib.compress(t.tobytes(), 1)) for r, t in zip(rows, np.split(times, np.cumsum([len(t) for t in tokens])[:-1]))]

    found = _ask(manifest, send, answer, "tokens binary")

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack, sizes, nodes, answers in zip(*(batch.column(c).to_pylist() for c in ("pack", "sizes", "nodes", "answers"))):
                sizes, nodes = np.frombuffer(sizes, "<i8"), np.frombuffer(nodes, "<i8")
                deal = Deal(open_sets(pack, sizes), buckets, 2**64)
                times, given = np.ones(len(deal.values), np.int64), {x["bucket"]: x["answer"] for x in answers}
                for bucket, places in deal.parts:
                    times[places] = np.frombuffer(zlib.decompress(given[bucket]), "<u4")
                order = np.lexsort((deal.values, times, deal.set))
                nth = np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                chosen = (nth <= slack(sizes)[deal.set[order]]) & (times[order] >= 2)
                taken = order[chosen]
                n = sizes[deal.set[taken]]
                yield pa.RecordBatch.from_arrays([pa.array(deal.values[taken].astype(np.uint64).view(np.int64)), pa.array(nodes[deal.set[taken]]), pa.array(n), pa.array(n - nth[chosen])], names=["token", "node", "n", "rest"])

    return manifest.join(found, "pack").repartition(partitions(files)).mapInArrow(prefix, "token long, node long, n long, rest long")


class PrefixTree:
    """Ordered sets that share their beginnings; each tree node holds a run of members, cut after RUN of them."""

    RUN = 64

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = [len(s) for s in sets]
        self.root = self._grow([(i, s) for i, s in enumerate(sets)])

    def _grow(self, members: list[tuple[int, np.ndarray]]) -> list:
        """Nodes (run, sets that end here, children, least size, most size, depth of the end) for the sets.

        A long set makes a path of many nodes, so what is left to grow waits on a stack.
        """
        root: list = []
        waiting = [([m for m in members if len(m[1])], 0, root)]
        while waiting:
            members, depth, out = waiting.pop()  # all alike up to depth
            by_first: dict = {}
            for i, s in members:
                by_first.setdefault(int(s[depth]), []).append((i, s))
            for group in by_first.values():
                head = min((s for _, s in group), key=len)
                end = min(len(head), depth + self.RUN)
                for _, s in group:
                    same = s[depth:end] == head[depth:end]
                    if not same.all():
                        end = depth + int(np.argmin(same))
                done = [i for i, s in group if len(s) == end]
                sizes = [len(s) for _, s in group]
                below: list = []
                out.append((head[depth:end], done, below, min(sizes), max(sizes), end))
                longer = [m for m in group if len(m[1]) > end]
                if longer:
                    waiting.append((longer, end, below))
        return root

    def alike(self, x: np.ndarray) -> list[int]:
        """The sets that link with x."""
        found, stack = [], [(node, 0) for node in self.root]
        while stack:
            (run, done, below, least, most, depth), overlap = stack.pop()
            at = np.searchsorted(x, run)
            overlap += int((x[np.minimum(at, len(x) - 1)] == run).sum())
            for i in done:
                if 100 * overlap >= PERCENT * (len(x) + self.sizes[i] - overlap):
                    found.append(i)
            left = min(len(x) - int(np.searchsorted(x, run[-1], side="right")), most - depth)
            if below and (100 + PERCENT) * (overlap + left) >= PERCENT * (len(x) + least):
                stack += [(node, overlap) for node in below]
        return found


def _fetch(needed: DataFrame, files: DataFrame) -> DataFrame:
    """key, node, tokens for the wanted (key, node) rows: each set goes to each task that needs it once, from its file."""
    n = partitions(files)

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack, nodes in zip(batch.column("pack").to_pylist(), batch.column("nodes").to_pylist()):
                nodes = np.frombuffer(nodes, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array([pack] * len(nodes)), pa.array(np.arange(len(nodes)))], names=["node", "pack", "place"])

    where = files.select("pack", "nodes").mapInArrow(places, "node long, pack string, place long")
    wanted = needed.groupBy("node").agg(F.collect_set("key").alias("keys")).join(where, "node")  # at most n keys a node
    orders = wanted.groupBy("pack").agg(F.collect_list(F.struct("place", "keys")).alias("orders")).join(files, "pack")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack, nodes, sizes, orders in zip(*(batch.column(c).to_pylist() for c in ("pack", "nodes", "sizes", "orders"))):
                sets, nodes = open_sets(pack, np.frombuffer(sizes, "<i8")), np.frombuffer(nodes, "<i8")
                for x in orders:
                    i = x["place"]
                    step = max(1, COPY_BYTES // max(1, sets[i].nbytes))  # a long set that many tasks want goes out a few copies at a time
                    for lo in range(0, len(x["keys"]), step):
                        keys = x["keys"][lo : lo + step]
                        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array([nodes[i]] * len(keys), pa.int64()), pa.array([sets[i].tobytes()] * len(keys), pa.binary())], names=["key", "node", "tokens"])

    return orders.repartition(n).mapInArrow(fetch, "key int, node long, tokens binary")


def links(asked: DataFrame, trees: DataFrame, files: DataFrame) -> DataFrame:
    """a, b: links that connect all that the members' links with their trees connect.

    asked: tree, home, member, n, label (of distinct tree and member). trees: tree, nodes, labels. What asks trees of one
    home meets in one place, so that sets come there once; a home that very many ask is cut by member into places of
    about ASKERS, and places are dealt to as many keys as keep the sets of a key within KEY_BYTES. A place gives a link
    only if its earlier ones don't connect the two sets yet; a member passes through a tree only if it holds a set that
    the member is neither connected with nor was compared with.
    """
    n, spark = partitions(files), asked.sparkSession
    asked = staged(asked, "asked")
    keys = n * max(1, -(-8 * (asked.agg(F.sum("n")).first()[0] or 0) // (n * KEY_BYTES)))
    cuts = asked.groupBy("home").agg(F.ceil(F.count("*") / ASKERS).alias("cuts"))
    place = F.pmod(F.xxhash64("home", F.pmod(F.xxhash64("member"), F.col("cuts"))), F.lit(keys)).cast("int")
    asked = staged(asked.join(cuts, "home").select("tree", "member", "label", place.alias("key")), "asked")
    trees = staged(asked.select("key", "tree").distinct().join(trees, "tree"), "trees")
    needed = asked.select("key", F.col("member").alias("node")).union(trees.select("key", F.explode("nodes"))).distinct()
    null = lambda kind: F.lit(None).cast(kind)
    rows = _fetch(needed, files).select("key", null("long").alias("tree"), F.lit(0).alias("kind"), "node", null("long").alias("label"), "tokens", null("array<long>").alias("nodes"), null("array<long>").alias("labels"))
    rows = rows.union(trees.select("key", "tree", F.lit(1), null("long"), null("long"), null("binary"), "nodes", "labels"))
    rows = rows.union(asked.select("key", "tree", F.lit(2), "member", "label", null("binary"), null("array<long>"), null("array<long>")))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, nodes, labels, tree, top, met = None, {}, [], [], None, {}, {}

        def find(x: int) -> int:
            while (up := top.setdefault(x, x)) != x:
                top[x] = x = top[up]
            return x

        for some in text_slices(batches, "tokens", SLICE_BYTES):
            a, b = [], []
            for k, kind, node, label, tokens, members, names in zip(*(some.column(c).to_pylist() for c in ("key", "kind", "node", "label", "tokens", "nodes", "labels"))):
                if k != key:
                    key, held, top, met = k, {}, {}, {}
                if kind == 0:
                    held[node] = np.frombuffer(tokens, "<u8")
                elif kind == 1:
                    nodes, labels, tree = members, names, None
                else:
                    seen = met.setdefault(node, set())
                    if all(x in seen or find(y) == find(label) for x, y in zip(nodes, labels)):
                        continue
                    tree = tree or PrefixTree([held[x] for x in nodes])
                    seen.update(nodes)
                    for i in tree.alike(held[node]):
                        if find(labels[i]) != find(label):
                            top[find(label)] = find(labels[i])
                            a.append(label)
                            b.append(labels[i])
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    rows = rows.repartitionById(n, F.pmod("key", F.lit(n))).sortWithinPartitions("key", F.col("tree").asc_nulls_first(), "kind")
    return rows.mapInArrow(meet, "a long, b long")


def _fits(n, least, most):
    """Whether a set of n members can link with some set of least to most members, by their sizes."""
    return (100 * F.col(most) >= PERCENT * F.col(n)) & (PERCENT * F.col(least) <= 100 * F.col(n))


def _reaches(n, rest, m, other_rest):
    """Whether two sets of n and m members may link and have no common member before a token from which rest and other_rest stand.

    What two sets share from their first common token on is no more than the lesser rest, and a link needs so much. Linked
    sets pass at that token, so it is enough to compare sets at tokens where they pass.
    """
    return (100 + PERCENT) * F.least(rest, other_rest) >= PERCENT * (n + m)


def centre_trees(entries: DataFrame, round_: int) -> tuple[DataFrame, DataFrame]:
    """Step 4, its first rounds: asked and trees for links().

    The nodes of a token fall into slots by hash, and the first of each slot, in an order of this round that all tokens
    share, is a centre. The centres of a token make one tree, and each node of the token asks that tree: a row per index
    entry at most. No task holds a token's nodes: the slots' firsts are partial aggregates.
    """
    slot = F.pmod(F.xxhash64("node", F.lit(-round_ - 1)), F.lit(CENTRES << round_))
    firsts = entries.groupBy("token", slot.alias("slot")).agg(F.min(F.struct(F.xxhash64("node", F.lit(round_)).alias("nth"), "node", "n", "rest", "label")).alias("c"))
    centres = firsts.groupBy("token").agg(F.sort_array(F.collect_list("c")).alias("c")).filter((F.size("c") > 1))  # one per slot at most
    centres = centres.select("token", F.col("c.node").alias("nodes"), F.col("c.n").alias("sizes"), F.col("c.rest").alias("rests"), F.col("c.label").alias("labels")).withColumn("tree", F.xxhash64("nodes"))
    centres = staged(centres, "centres")
    other = lambda l, m, rest: (l != F.col("label")) & _reaches(F.col("n"), F.col("rest"), m, rest)
    rows = entries.join(centres, "token").filter(F.exists(F.arrays_zip("labels", "sizes", "rests"), lambda x: other(x["labels"], x["sizes"], x["rests"])))
    asked = rows.select("tree", F.col("nodes")[0].alias("home"), F.col("node").alias("member"), "n", "label").distinct()
    return asked, centres.select("tree", "nodes", "labels").dropDuplicates(["tree"])


def block_trees(entries: DataFrame, open_tokens: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Step 4, its last round: trees of about BLOCK nodes of one family, which all nodes ask that may link with one of them.

    A family holds the nodes whose tokens lead to the same least label, so alike sets mostly share a tree. A node asks its
    own tree and those after it that share a token with it, hold another label there, fit its size, and have enough left
    from that token on. The rows of a token meet its trees in a join, whose large partitions Spark can cut.
    """
    family = entries.join(open_tokens.select("token", "lo"), "token").groupBy("node").agg(F.min("lo").alias("family"))
    sizes = family.groupBy("family").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    nodes = family.join(sizes, "family").select("node", F.xxhash64("family", F.pmod(F.xxhash64("node"), F.col("blocks"))).alias("tree"))
    rows = staged(entries.join(nodes, "node"), "blocks")
    there = rows.groupBy("token", F.col("tree").alias("other")).agg(F.min("label").alias("l0"), F.max("label").alias("l1"), F.min("n").alias("n0"), F.max("n").alias("n1"), F.max("rest").alias("rest1"))
    met = rows.join(there, (rows["token"] == there["token"]) & (F.col("tree") <= F.col("other")) & ((F.col("l0") != F.col("label")) | (F.col("l1") != F.col("label"))) & _fits("n", "n0", "n1") & _reaches(F.col("n"), F.col("rest"), F.col("n0"), F.col("rest1")))
    asked = met.select(F.col("other").alias("tree"), F.col("other").alias("home"), F.col("node").alias("member"), "n", "label").distinct()
    members = rows.select("tree", "node", "label").distinct().groupBy("tree").agg(F.collect_list(F.struct("node", "label")).alias("c"))
    return asked, members.select("tree", F.col("c.node").alias("nodes"), F.col("c.label").alias("labels"))


def linked_components(entries: DataFrame, files: DataFrame) -> DataFrame:
    """Step 4: node, component for all nodes that link with another."""
    label, total, spark = None, entries.count(), entries.sparkSession
    for round_ in range(MAX_ROUNDS + 1):
        with collecting() as made:
            rows, last = entries.withColumn("label", F.col("node")), False
            if label is not None:
                rows = entries.join(label.withColumnRenamed("component", "label"), "node", "left").withColumn("label", F.coalesce("label", "node"))
                counts = rows.groupBy("token", "label").agg(F.count("*").alias("c")).groupBy("token").agg(F.min("label").alias("lo"), (F.sum("c") * F.sum("c") - F.sum(F.col("c") * F.col("c"))).alias("p"))
                counts = staged(counts.filter("p > 0"), "open_tokens")
                left = counts.agg(F.sum("p")).first()[0]
                if not left:
                    break
                rows = staged(rows.join(counts.select("token"), "token", "left_semi"), "open_entries")
                last = left / 2 <= LEFT_PER_ENTRY * total or round_ == MAX_ROUNDS
            asked, trees = block_trees(rows, counts) if last else centre_trees(rows, round_)
            new = staged(links(asked, trees, files), "links")
            # The components so far stand for the links that made them.
            label = staged(components(new if label is None else new.union(label)), "labels")
            drop(spark, made[:-1])  # all that led to the labels
        if last:
            break
    return label


def _placed(docs: DataFrame, id_column: str, text_column: str, *, carry: bool) -> DataFrame:
    """pack, place, _id, n, key1, key2 and component of each document; the packs hold carry_all(docs) if asked to."""
    spark, buckets = docs.sparkSession, partitions(docs)
    with collecting() as made:
        packs = write_packs(docs, shared_dir(spark, "join_packs"), id_column, text_column, carry_all(docs, text_column) if carry else None)
        needed = made[:1] if carry else []  # the texts, which the caller picks from
        documents = staged(document_sets(packs), "document_sets")
        needed += made[-1:]
        shared = staged(shared_in_sketch(packs, buckets), "shared")
        files = write_sets(packs, documents, shared, buckets, shared_dir(spark, "set_files"))
        entries = staged(index_entries(files, buckets), "entries")
        classes = documents.filter("n > 0 and _id is not null").groupBy("key1", "key2", "n").agg(F.min("_id").alias("first"))
        label = staged(linked_components(entries, files), "components")
        drop(spark, [f for f in made[:-1] if f not in needed])
    classes = classes.join(label.withColumnRenamed("node", "key1"), "key1", "left").withColumn("component", F.coalesce("component", "key1"))
    least = classes.groupBy("component").agg(F.min("first").alias("least"))
    classes = classes.join(least, "component").select("key1", "key2", "n", "least")
    found = documents.join(classes, ["key1", "key2", "n"], "left")
    return found.select("pack", "place", "_id", "n", "key1", "key2", F.when(F.col("_id").isNotNull(), F.coalesce("least", "_id")).alias("component"))


def join(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its id, n_shingles and component_id (the least id that links lead to, itself included)."""
    found = _placed(docs, id_column, text_column, carry=False)
    return found.select(F.col("_id").alias(id_column), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def keep_one(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The row of docs with the least id of each component, all columns unchanged.

    Of rows with that id and equal sets one stays; rows with that id and other sets all stay. A null id links with
    nothing, so its rows stay. The rows come from the packs; no text is shuffled.
    """
    found = _placed(docs, id_column, text_column, carry=True)
    first = found.filter(F.col("_id") == F.col("component")).groupBy("_id", "key1", "key2", "n").agg(F.min(F.struct("pack", "place")).alias("at")).select("at.pack", "at.place")
    first = first.union(found.filter(F.col("_id").isNull()).select("pack", "place"))
    return pick(first.groupBy("pack").agg(F.collect_list("place").alias("places")), docs, text_column)
