"""Dedup of byte strings by prefix-free parsing, with phrase hashes in place of the parse's suffix array and corpus order.

A byte goes if it lies in a string of LENGTH bytes that also starts in a document with a smaller id. Strings never cross
documents and are judged on the input. The steps:

1. Texts are written once, as packs in the shared folder. All later steps read packs; no text is shuffled.
2. Triggers: of the rolling hashes of K bytes in each string of LENGTH bytes the least counts, of equal ones the
   rightmost. The strings in a row with one trigger make a phrase, of at most 2 * LENGTH - K bytes. Equal strings have the
   same trigger at the same place, so phrases parse the texts alike wherever they are alike.
3. Dictionary: (trigger, phrase) hashes meet by trigger range. A phrase that a smaller document has is covered whole.
   Within a pack only the smallest document of a phrase is sent, so that a passage of many documents weighs little. What
   up to BUNDLE packs send to a range is one blob, as the ranges grow with the corpus like the packs do.
4. Where a smaller document has the trigger but not the phrase (at the ends of a repeat), the phrases themselves meet. A
   suffix array of these phrases, by prefix doubling up to LENGTH bytes, puts equal strings side by side; the least
   document of each run decides for each string of each phrase.
   A trigger with more than HOT such phrases is no such group: its strings meet by the range of the hash of a core, the 44
   bytes that up to seven strings of a phrase share, so that no task holds all that surrounds a common passage. The bytes
   beside the core, up to six on each side, travel with it and tell its strings apart.
5. Strings around a core that more than CROWDED groups share, as at the ends of a common passage, meet one by one, by the range
   of their own hashes.
6. Each pack gathers the verdicts on its phrases, and the union of covered strings is cut from each text.

Phrases count as equal by 80 bits of two hashes; strings in step 4 are compared exactly, those of hot triggers by
80 bits of the core and the bytes beside it, those of step 5 by 80 bits.

Cases: a null text is empty; rows with equal ids don't remove from each other; a null id counts as larger than all
others, so that its text is judged and never a reason; long documents are parsed in chunks that overlap by LENGTH - 1
bytes; texts shorter than LENGTH stay as they are; an empty table gives an empty result; `dedup` doesn't read other
columns, and `cut_repeats` passes them on.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import RangeHash, mix, partitions, shared_dir, staged
from .packs import PACK_BYTES, by_bucket, carry_all, open_pack, to_buckets, write_packs

LENGTH = 50
#: Bytes of a trigger. Short ones are shared by chance, and the more so the larger the corpus: 16 bytes send 0.27 bytes of
#: phrases a byte of text through step 4 on 0.17 GB of text and 0.39 on 0.86 GB, 24 bytes 0.16 and 0.19.
K = 24
WINDOW = LENGTH - K + 1
#: In step 4 a partition's triggers fall into so many ranges; a task holds the phrases of one range at a time.
RANGES = 2
#: Packs that send together, at most, and chunks whose phrases are held until they are sent.
BUNDLE = 16
#: Phrases of one trigger that may meet in one range.
HOT = 2048
#: Strings of a hot trigger that may travel as one group; a group's places fit into a byte, its sides into a word.
STEP = 7
#: Groups that may share a core: they take about 10 MB in a task, as HOT phrases do in string_ranks.
CROWDED = 1 << 14
#: The answer to a group whose core more than CROWDED groups share.
AGAIN = 0x80
SAME, ASK, SOURCE, SPREAD = 1, 2, 3, 4  # states of a phrase: covered whole; strings to be looked up; only looked at; strings looked up by their cores


def window_minima(hashes: np.ndarray, window: int, block: int = 1 << 15) -> np.ndarray:
    """The position of the rightmost least hash in each window. Blocks keep the work inside the processor's cache."""
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int32)
    out = np.empty(n, np.int32)
    for lo in range(0, n, block):
        hi = min(n, lo + block)
        out[lo:hi] = _block_minima(hashes[lo : hi + window - 1], window)
        out[lo:hi] += lo
    return out


def _block_minima(hashes: np.ndarray, window: int) -> np.ndarray:
    least, size = hashes, 1
    while size < window:
        step = min(size, window - size)
        least = np.minimum(least[step:], least[: len(least) - step])
        size += step
    # Where the window's last hash is the least, it is the rightmost one. Where the least one has just left the window,
    # the window is searched. Elsewhere the place stays, and places never fall, so a running maximum fills them in.
    last = hashes[window - 1 :] == least
    lost = ~last
    lost[1:] &= least[1:] != least[:-1]
    at = np.where(last, np.arange(window - 1, window - 1 + len(least), dtype=np.int32), np.int32(0))
    where = np.flatnonzero(lost)
    inside = hashes[where[:, None] + np.arange(window - 1, -1, -1)]
    at[where] = where + window - 1 - inside.argmin(1)
    return np.maximum.accumulate(at)


def _range(hashes: np.ndarray, n: int) -> np.ndarray:
    """Which of n ranges of 64-bit hashes each lies in."""
    return (hashes // np.uint64((1 << 64) // n + 1)).astype(np.int64)


def by_range(bucket: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Each range with the places of its entries, in the order in which they came."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    return [(int(bucket[places[0]]), places) for places in np.split(order, cuts) if len(places)]


class Answers:
    """The answers to a part's blobs, one value an entry. The chunks of the part take theirs in the order in which they sent."""

    def __init__(self, found: dict[int, np.ndarray], buckets: int, kind: type = np.uint8):
        self._flat = np.concatenate([np.zeros(0, kind), *found.values()])
        self._next, at = np.full(buckets, -1, np.int64), 0
        for bucket, values in found.items():
            self._next[bucket] = at
            at += len(values)

    def take(self, bucket: np.ndarray) -> np.ndarray:
        """The values of a chunk's entries, given their ranges; 0 for blobs without an answer."""
        order, counts = np.argsort(bucket, kind="stable"), np.bincount(bucket, minlength=len(self._next))
        b = bucket[order]
        place = self._next[b] + np.arange(len(b)) - (np.cumsum(counts) - counts)[b]
        known = self._next[b] >= 0
        out = np.zeros(len(b), self._flat.dtype)
        out[order[known]] = self._flat[place[known]]
        self._next[self._next >= 0] += counts[self._next >= 0]
        return out


class Phrases:
    """The parse of a chunk: for each phrase its text, first string, number of strings, trigger place, and two hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, docs: np.ndarray):
        self.data, self.offsets = data, offsets
        ranges = RangeHash(data)
        at = window_minima(ranges.every(K), WINDOW)
        # A string starts in each text but for its last LENGTH - 1 bytes.
        long = np.flatnonzero(np.diff(offsets) >= LENGTH)
        stops = offsets[long + 1] - LENGTH + 1
        new = np.zeros(len(at) + 1, bool)
        new[1:-1] = at[1:] != at[:-1]
        new[offsets[long]] = True
        new[stops] = True
        first = np.flatnonzero(new)
        ends = np.append(first[1:], len(at))
        text = np.searchsorted(offsets, first, side="right") - 1
        inside = first < offsets[np.minimum(text + 1, len(offsets) - 1)] - LENGTH + 1
        self.start, self.text, self.count = first[inside], text[inside], (ends - first)[inside]
        self.trigger = at[self.start].astype(np.int64)
        self.end = self.start + self.count + LENGTH - 1
        # Least hashes crowd at the low end, so they are scrambled anew before ranges are cut.
        self.trig = mix(ranges(self.trigger, self.trigger + K))
        # Two phrases are equal if their bytes are, and the trigger stands at the same place in both.
        whole = ranges(self.start, self.end) + (self.trigger - self.start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        self.unit = whole >> np.uint64(16)
        self.doc = docs[self.text]
        # Of equal phrases in the chunk the one of the smallest document speaks for all.
        order = np.lexsort((self.doc, self.unit, self.trig))
        t, u = self.trig[order], self.unit[order]
        lead = np.ones(len(order), bool)
        lead[1:] = (t[1:] != t[:-1]) | (u[1:] != u[:-1])
        self.lead = np.empty(len(order), np.int64)
        self.lead[order] = order[np.flatnonzero(lead)[np.cumsum(lead) - 1]] if len(order) else 0
        self.sent = np.flatnonzero(self.lead == np.arange(len(order)))

    def bucket(self, which: np.ndarray, buckets: int) -> np.ndarray:
        """The ranges of the trigger hashes of some phrases."""
        return _range(self.trig[which], buckets)

    def states(self, told: Answers, buckets: int) -> np.ndarray:
        """The state of each phrase, from the answers to those that are sent."""
        out = np.zeros(len(self.trig), np.uint8)
        out[self.sent] = told.take(self.bucket(self.sent, buckets))
        mine = self.doc == self.doc[self.lead]
        return np.where(mine, out[self.lead], SAME).astype(np.uint8)


class Groups:
    """The strings of the phrases of a chunk that are in state SPREAD, up to STEP of them in a row by what they share.

    Group g of a phrase has the strings in which the trigger stands at the places g * STEP to g * STEP + STEP - 1. All of
    them hold the core, LENGTH - STEP + 1 bytes; the string of place j in the group starts j bytes before the core and ends
    STEP - 1 - j bytes after it. `facts` has 24 bytes a group: hash of the core, STEP - 1 bytes on each side of it (zero
    where no string needs them), 16 more bits that stand for the core, a bit for each place, and a zero.
    """

    def __init__(self, p: Phrases, state: np.ndarray):
        of = np.flatnonzero(state == SPREAD)
        most = p.trigger[of] - p.start[of]
        least = most - p.count[of] + 1
        n = most // STEP - least // STEP + 1
        phrase, most, least, group = (np.repeat(x, n) for x in (of, most, least, least // STEP))
        group += np.arange(len(phrase)) - np.repeat(np.cumsum(n) - n, n)
        low, high = np.maximum(least - group * STEP, 0), np.minimum(most - group * STEP, STEP - 1)
        self.doc, self.core = p.doc[phrase], p.trigger[phrase] - group * STEP
        after = self.core + LENGTH - STEP + 1
        k = np.arange(STEP - 1)
        self.facts = np.zeros((len(phrase), 24), np.uint8)
        if len(phrase):
            self.facts[:, :8] = RangeHash(p.data)(self.core, after).astype("<u8").view(np.uint8).reshape(-1, 8)
            self.facts[:, 8:14] = np.where(k >= STEP - 1 - high[:, None], p.data[np.maximum(self.core[:, None] - STEP + 1 + k, 0)], 0)
            self.facts[:, 14:20] = np.where(k < STEP - 1 - low[:, None], p.data[np.minimum(after[:, None] + k, len(p.data) - 1)], 0)
            more = p.trig[phrase] + group.astype(np.uint64)
            self.facts[:, 20:22] = (more & np.uint64(0xFFFF)).astype("<u2").view(np.uint8).reshape(-1, 2)
            self.facts[:, 22] = (1 << high + 1) - (1 << low)
        # Of equal groups in the chunk the one of the smallest document speaks for all.
        words = self.facts.view("<u8")
        order = np.lexsort((self.doc, words[:, 2], words[:, 1], words[:, 0]))
        lead = np.ones(len(order), bool)
        lead[1:] = (words[order[1:]] != words[order[:-1]]).any(1)
        self.lead = np.empty(len(order), np.int64)
        self.lead[order] = order[np.flatnonzero(lead)[np.cumsum(lead) - 1]] if len(order) else 0
        self.sent = np.flatnonzero(self.lead == np.arange(len(order)))

    def bucket(self, ranges: int) -> np.ndarray:
        """The ranges of the cores' hashes of the groups that are sent; their numbers follow those of the triggers."""
        return _range(self.facts.view("<u8")[self.sent, 0], ranges) + ranges

    def dealt(self, ranges: int) -> list[tuple[int, np.ndarray]]:
        """The groups that are sent, by range."""
        return [(bucket, self.sent[places]) for bucket, places in by_range(self.bucket(ranges))]

    def answered(self, told: Answers | dict[int, bytes], ranges: int) -> tuple[np.ndarray, np.ndarray]:
        """The first bytes of the strings that a smaller document has, and which groups are to ask string by string."""
        if isinstance(told, dict):
            told = Answers({b: np.frombuffer(x, np.uint8) for b, x in told.items()}, 2 * ranges)
        hit = np.zeros(len(self.core), np.uint8)
        hit[self.sent] = told.take(self.bucket(ranges))
        hit = np.where(self.doc > self.doc[self.lead], self.facts[:, 22], hit[self.lead])
        return np.concatenate([self.core[hit >> j & 1 == 1] - j for j in range(STEP)]), hit & AGAIN > 0


def held_strings(doc: np.ndarray, facts: np.ndarray, hot: int) -> np.ndarray:
    """For each group, a bit for each place whose string a smaller document has, or AGAIN where more than `hot` share the core.

    Groups and documents are as in Groups.
    """
    hashes, entry, keys, rest = facts.view("<u8")[:, 0], [], [], []
    _, which, sizes = np.unique(hashes, return_inverse=True, return_counts=True)
    crowded = sizes[which] > hot
    for j in range(STEP):
        at = np.flatnonzero((facts[:, 22] >> j & 1 == 1) & ~crowded)
        entry.append(at)
        keys.append(hashes[at] + np.uint64(j * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        beside = facts[at, 8 + STEP - 1 - j : 8 + 2 * (STEP - 1) - j]
        rest.append(np.concatenate([beside, facts[at, 20:22]], axis=1).view("<u8").ravel())
    place = np.repeat(np.arange(STEP), [len(x) for x in entry])
    of, key, text = np.concatenate(entry), np.concatenate(keys), np.concatenate(rest)
    hit = _smaller_has(doc[of], text, key)
    out = np.where(crowded, AGAIN, 0).astype(np.uint8)
    for j in range(STEP):
        out[of[hit & (place == j)]] |= 1 << j
    return out


def _smaller_has(doc: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """For each row, whether one with the same keys has a smaller document."""
    order = np.lexsort((doc, *keys))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[order[1:]] != key[order[:-1]]
    d, hit = doc[order], np.empty(len(order), bool)
    hit[order] = d[np.flatnonzero(new)[np.cumsum(new) - 1]] < d
    return hit


class Strings:
    """The strings of the groups of a chunk that ask again: first byte, document, and 80 bits that stand for the string."""

    def __init__(self, p: Phrases, groups: Groups, again: np.ndarray):
        which = np.flatnonzero(again)
        of, place = np.nonzero(groups.facts[which, 22][:, None] >> np.arange(STEP) & 1)
        of = which[of]
        self.start, self.doc = groups.core[of] - place, groups.doc[of]
        self.hash = RangeHash(p.data)(self.start, self.start + LENGTH) if len(of) else np.zeros(0, np.uint64)
        self.more = groups.facts[of, 20:22].view("<u2").ravel() + place.astype(np.uint16)
        # Of equal strings in the chunk the one of the smallest document speaks for all.
        order = np.lexsort((self.doc, self.more, self.hash))
        h, m = self.hash[order], self.more[order]
        lead = np.ones(len(order), bool)
        lead[1:] = (h[1:] != h[:-1]) | (m[1:] != m[:-1])
        self.lead = np.empty(len(order), np.int64)
        self.lead[order] = order[np.flatnonzero(lead)[np.cumsum(lead) - 1]] if len(order) else 0
        self.sent = np.flatnonzero(self.lead == np.arange(len(order)))

    def bucket(self, ranges: int) -> np.ndarray:
        """The ranges of the hashes of the strings that are sent."""
        return _range(self.hash[self.sent], ranges)

    def dealt(self, ranges: int) -> list[tuple[int, np.ndarray]]:
        """The strings that are sent, by range."""
        return [(bucket, self.sent[places]) for bucket, places in by_range(self.bucket(ranges))]

    def covered(self, told: Answers, ranges: int) -> np.ndarray:
        """The first bytes of the strings that a smaller document has."""
        hit = np.zeros(len(self.start), bool)
        hit[self.sent] = told.take(self.bucket(ranges)).astype(bool)
        return self.start[hit[self.lead] | (self.doc > self.doc[self.lead])]


def narrow(ids: np.ndarray) -> bytes:
    """Whole numbers, at least one, as the least and the distances from it in as few bytes each as they all fit."""
    least = ids.min()
    away = ids.astype(np.uint64) - least.astype(np.uint64)
    width = next(w for w in (1, 2, 4, 8) if int(away.max()) < 1 << 8 * w)
    return np.int64(least).tobytes() + away.astype(f"<u{width}").tobytes()


def wide(data: bytes, n: int) -> np.ndarray:
    """The n numbers that narrow wrote."""
    away = np.frombuffer(data, f"<u{(len(data) - 8) // n}", offset=8).astype(np.uint64)
    return (away + np.frombuffer(data, "<u8", 1)).view(np.int64)


def _owners(docs: np.ndarray) -> tuple[bytes, bytes | None]:
    """The documents of some phrases: each as it is, or once, with the places of the phrases among them."""
    own, at = np.unique(docs, return_inverse=True)
    each, once, at = narrow(docs), narrow(own), at.astype("<u4" if len(own) > 1 << 16 else "<u2").tobytes()
    return (each, None) if len(each) <= len(once) + len(at) else (len(own).to_bytes(4, "little") + once, at)


def _owned(docs: bytes, at: bytes | None, n: int) -> np.ndarray:
    """The documents of n phrases that _owners wrote."""
    if at is None:
        return wide(docs, n)
    return wide(docs[4:], int.from_bytes(docs[:4], "little"))[np.frombuffer(at, f"<u{len(at) // n}")]


def chunks(docs: np.ndarray, offsets: np.ndarray, data: np.ndarray) -> Iterator[tuple[int, Phrases]]:
    """First byte and parse of each chunk: the whole pack, or parts of one long document."""
    if len(data) <= 2 * PACK_BYTES:
        yield 0, Phrases(data, offsets, docs)
        return
    for i in range(len(docs)):  # a long document stands alone, perhaps after short ones
        for lo in range(int(offsets[i]), max(int(offsets[i]) + 1, int(offsets[i + 1]) - LENGTH + 1), PACK_BYTES):
            hi = min(int(offsets[i + 1]), lo + PACK_BYTES + LENGTH - 1)
            yield lo, Phrases(data[lo:hi], np.array([0, hi - lo]), docs[i : i + 1])


def bundled(packs: DataFrame, size: int | None = None) -> DataFrame:
    """bundle and packs: packs next to each other by their first ids, fewer than BUNDLE where tasks would go without work."""
    n = partitions(packs)
    size = size or max(1, min(BUNDLE, n // 16))

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [pack for batch in batches for pack in batch.column("pack").to_pylist()]
        some = [names[lo : lo + size] for lo in range(0, len(names), size)]
        if some:
            yield pa.RecordBatch.from_arrays([pa.array([x[0].rsplit("/", 1)[1] for x in some]), pa.array(some, pa.list_(pa.string()))], names=["bundle", "packs"])

    return staged(packs.repartitionByRange(n, "first").sortWithinPartitions("first").mapInArrow(bundle, "bundle string, packs array<string>"), "bundles")


def parts(packs: list[str]) -> Iterator[tuple[int, Iterator[Phrases]]]:
    """The chunks of a bundle, by part: BUNDLE of them in a row, of which all must be read before the next part."""
    parsed = (p for pack in packs for docs, _, offsets, data in [open_pack(pack)] for _, p in chunks(docs, offsets, data))
    for part in itertools.count():
        if (first := next(parsed, None)) is None:
            return
        yield part, itertools.chain([first], itertools.islice(parsed, BUNDLE - 1))


class Told:
    """The answers that a bundle got. Its chunks must ask in the order in which they sent."""

    def __init__(self, buckets: int, ranges: int, *answers: list[dict] | None):
        self._sizes, self._answers, self._chunk = (buckets, ranges), [_parts(x) for x in answers], 0
        self.any = bool(self._answers[0])

    def next(self) -> list[Answers]:
        """For the next chunk: states, bits of asked phrases, of groups, of strings, as far as there are such answers."""
        part, at = divmod(self._chunk, BUNDLE)
        self._chunk += 1
        if not at:
            first, second, third = [*(x.get(part, {}) for x in self._answers), {}, {}][:3]
            buckets, ranges = self._sizes
            self._now = [
                Answers({b: np.frombuffer(zlib.decompress(x), np.uint8) for b, x in first.items()}, buckets),
                Answers({b: np.frombuffer(x, "<u8") for b, x in second.items() if b < ranges}, ranges, np.uint64),
                Answers({b: np.frombuffer(x, np.uint8) for b, x in second.items() if b >= ranges}, 2 * ranges),
                Answers({b: np.unpackbits(np.frombuffer(x, np.uint8)) for b, x in third.items()}, ranges),
            ]
        return self._now


def _by_bundle(answers: DataFrame) -> DataFrame:
    """One row per bundle with the answers to its blobs: at most one per range and part."""
    return answers.groupBy("bundle").agg(F.collect_list(F.struct("part", "bucket", "answer")).alias("answers"))


def _parts(answers: list[dict] | None) -> dict[int, dict[int, bytes]]:
    out: dict[int, dict[int, bytes]] = {}
    for x in answers or []:
        out.setdefault(x["part"], {})[x["bucket"]] = x["answer"]
    return out


ANSWER = "bundle string, part int, bucket int, answer binary"


def _answers(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.int32(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["bundle", "part", "bucket", "answer"])


def _blobs(bundle: str, part: int, bucket: list[np.ndarray], columns: Callable[[int, np.ndarray], tuple]) -> list[tuple]:
    """A row per range that the chunks of a part send to: what `columns` makes of the places of its entries."""
    return [(bundle, part, number, *columns(number, places)) for number, places in by_range(np.concatenate(bucket))]


def _sent(rows: list[tuple], *columns: str) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.int32(), *[pa.binary()] * len(columns)]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["bundle", "part", "bucket", *columns])


def dictionary_states(bundles: DataFrame, buckets: int) -> DataFrame:
    """Step 3: the states of the phrases that each blob sent."""
    width = (1 << 64) // buckets + 1
    shift = np.uint64(max(0, ((1 << 64) // buckets).bit_length() - 32))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle, packs in zip(batch.column("bundle").to_pylist(), batch.column("packs").to_pylist()):
                for part, parsed in parts(packs):
                    held = [(p.bucket(p.sent, buckets), p.trig[p.sent], p.unit[p.sent], p.doc[p.sent]) for p in parsed]
                    bucket, trig, unit, doc = zip(*held)
                    trig, unit, doc = np.concatenate(trig), np.concatenate(unit), np.concatenate(doc)

                    def columns(number: int, which: np.ndarray) -> tuple:
                        short = ((trig[which] - np.uint64(number * width)) >> shift).astype("<u4")
                        return (*_owners(doc[which]), short.tobytes(), unit[which].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes())

                    if rows := _blobs(bundle, part, bucket, columns):
                        yield _sent(rows, "docs", "at", "trig", "unit")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_bucket(batches):
            yield answer(rows)

    def answer(rows: list[dict]) -> pa.RecordBatch:
        of: list[tuple] = []
        trigs, units, docs = [], [], []
        for row in rows:
            t = np.frombuffer(row["trig"], "<u4")
            units.append(np.pad(np.frombuffer(row["unit"], np.uint8).reshape(-1, 6), ((0, 0), (0, 2))).copy().view("<u8").ravel())
            docs.append(_owned(row["docs"], row["at"], len(t)))
            trigs.append(t)
            of.append((row["bundle"], row["part"], row["bucket"], len(t)))
        trig, unit, doc = np.concatenate(trigs), np.concatenate(units), np.concatenate(docs)
        del trigs, units, docs
        order = np.lexsort((doc, unit, trig))
        t, u, d = trig[order], unit[order], doc[order]
        new_trig = np.concatenate([[True], t[1:] != t[:-1]])
        new_unit = new_trig | np.concatenate([[True], u[1:] != u[:-1]])
        group, kind = np.cumsum(new_trig) - 1, np.cumsum(new_unit) - 1
        least_of_trig = np.minimum.reduceat(d, np.flatnonzero(new_trig))[group]
        least_of_unit = d[np.flatnonzero(new_unit)][kind]
        state = np.where(least_of_unit < d, SAME, np.where(least_of_trig < d, ASK, 0)).astype(np.uint8)
        asked = np.zeros(group[-1] + 1, bool)
        asked[group[state == ASK]] = True
        state[(state == 0) & asked[group]] = SOURCE
        crowded = np.bincount(group[state >= ASK], minlength=group[-1] + 1) > HOT
        state[(state >= ASK) & crowded[group]] = SPREAD
        out = np.empty(len(state), np.uint8)
        out[order] = state
        ends = np.cumsum([n for *_, n in of])
        return _answers([(*x[:3], zlib.compress(out[e - x[3] : e].tobytes(), 1)) for x, e in zip(of, ends) if out[e - x[3] : e].any()])

    sent = bundles.repartition(partitions(bundles)).mapInArrow(send, "bundle string, part int, bucket int, docs binary, at binary, trig binary, unit binary")
    return _by_bundle(to_buckets(sent).mapInArrow(meet, ANSWER))


def string_ranks(data: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """The rank of the string of `length` bytes at each place in the order of all of them: a suffix array by prefix doubling.

    Ranks of 8 bytes give ranks of 16, then 32, and two overlapping ranks the whole length. Places past the end read zeros.
    """
    padded = np.concatenate([data, np.zeros(length + 8, np.uint8)]).astype(np.uint64)
    n = len(data)
    words = np.zeros(n + length, np.uint64)
    for k in range(8):
        words = words << np.uint64(8) | padded[k : k + n + length]
    rank, size = np.unique(words, return_inverse=True)[1].astype(np.uint64), 8
    while size < length:
        step = min(size, length - size)
        rank = np.unique(rank[:-step] * np.uint64(len(rank) + 1) + rank[step:], return_inverse=True)[1].astype(np.uint64)
        size += step
    return rank[:n].astype(np.int64)


def string_verdicts(states: DataFrame, buckets: int, ranges: int) -> DataFrame:
    """Step 4: for the asked phrases of each blob, a bit for each string that a smaller document has."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle, packs, answers in zip(*(batch.column(c).to_pylist() for c in ("bundle", "packs", "answers"))):
                told = Told(buckets, ranges, answers)
                for part, parsed in parts(packs):
                    phrases, groups, texts = [], [], []
                    for p in parsed:
                        state = p.states(told.next()[0], buckets)
                        which = p.sent[(state[p.sent] == ASK) | (state[p.sent] == SOURCE)]
                        phrases.append((p.bucket(which, ranges), p.doc[which], state[which] == ASK, p.count[which].astype(np.uint8)))
                        texts += [p.data[a:b].tobytes() for a, b in zip(p.start[which], p.end[which])]
                        if (state == SPREAD).any():
                            g = Groups(p, state)
                            groups.append((g.bucket(ranges), g.doc[g.sent], g.facts[g.sent]))
                    bucket, *held = zip(*phrases)
                    doc, asked, count = (np.concatenate(x) for x in held)
                    rows = _blobs(bundle, part, bucket, lambda _, which: (narrow(doc[which]), asked[which].tobytes(), count[which].tobytes(), b"".join([texts[i] for i in which])))
                    if groups:
                        bucket, *held = zip(*groups)
                        owner, facts = (np.concatenate(x) for x in held)
                        rows += _blobs(bundle, part, bucket, lambda _, which: (narrow(owner[which]), None, None, facts[which].tobytes()))
                    if rows:
                        yield _sent(rows, "docs", "asked", "counts", "phrases")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_bucket(batches):
            yield answer(rows) if rows[0]["bucket"] < ranges else answer_groups(rows)

    def answer_groups(rows: list[dict]) -> pa.RecordBatch:
        counts = [len(r["phrases"]) // 24 for r in rows]
        doc = np.concatenate([wide(r["docs"], n) for r, n in zip(rows, counts)])
        hit = held_strings(doc, np.frombuffer(b"".join(r["phrases"] for r in rows), np.uint8).reshape(-1, 24), CROWDED)
        parts = [(r, hit[e - n : e]) for r, n, e in zip(rows, counts, np.cumsum(counts))]
        return _answers([(r["bundle"], r["part"], r["bucket"], x.tobytes()) for r, x in parts if x.any()])

    def answer(rows: list[dict]) -> pa.RecordBatch:
        of, docs, asked, counts, phrases = [], [], [], [], []
        for row in rows:
            asked.append(np.frombuffer(row["asked"], bool))
            docs.append(wide(row["docs"], len(asked[-1])))
            counts.append(np.frombuffer(row["counts"], np.uint8).astype(np.int64))
            phrases.append(row["phrases"])
            of.append((row["bundle"], row["part"], row["bucket"], int(asked[-1].sum())))
        doc, ask, count = np.concatenate(docs), np.concatenate(asked), np.concatenate(counts)
        rank = string_ranks(np.frombuffer(b"".join(phrases), np.uint8))
        ends = np.cumsum(count + LENGTH - 1)
        phrase = np.repeat(np.arange(len(count)), count)
        nth = np.arange(len(phrase)) - np.repeat(np.cumsum(count) - count, count)
        rank, owner = rank[(ends - count - LENGTH + 1)[phrase] + nth], doc[phrase]
        order = np.lexsort((owner, rank))
        new = np.concatenate([[True], np.diff(rank[order]) != 0])
        least = np.empty(len(order), np.int64)
        least[order] = owner[order][np.flatnonzero(new)[np.cumsum(new) - 1]]
        masks = np.zeros(len(count), np.uint64)
        hit = np.flatnonzero(least < owner)
        np.bitwise_or.at(masks, phrase[hit], np.uint64(1) << nth[hit].astype(np.uint64))
        masks = masks[ask]
        to = np.cumsum([n for *_, n in of])
        return _answers([(*x[:3], masks[e - x[3] : e].astype("<u8").tobytes()) for x, e in zip(of, to) if masks[e - x[3] : e].any()])

    sent = states.repartition(partitions(states)).mapInArrow(send, "bundle string, part int, bucket int, docs binary, asked binary, counts binary, phrases binary")
    return _by_bundle(to_buckets(sent).mapInArrow(meet, ANSWER))


def asks_again(verdicts: list[dict] | None, ranges: int) -> bool:
    return any(x["bucket"] >= ranges and (np.frombuffer(x["answer"], np.uint8) & AGAIN).any() for x in verdicts or [])


def lone_verdicts(asked: DataFrame, buckets: int, ranges: int) -> DataFrame:
    """Step 5: for the strings of groups that ask again, a bit for each that a smaller document has."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle, packs, first, second in zip(*(batch.column(c).to_pylist() for c in ("bundle", "packs", "states", "verdicts"))):
                if not asks_again(second, ranges):
                    continue
                told = Told(buckets, ranges, first, second)
                for part, parsed in parts(packs):
                    held = []
                    for p in parsed:
                        states, _, of_groups, _ = told.next()
                        groups = Groups(p, p.states(states, buckets))
                        alone = Strings(p, groups, groups.answered(of_groups, ranges)[1])
                        held.append((alone.bucket(ranges), alone.doc[alone.sent], alone.more[alone.sent], alone.hash[alone.sent]))
                    bucket, *held = zip(*held)
                    doc, more, hashes = (np.concatenate(x) for x in held)
                    if rows := _blobs(bundle, part, bucket, lambda _, which: (narrow(doc[which]), more[which].tobytes(), hashes[which].astype("<u8").tobytes())):
                        yield _sent(rows, "docs", "more", "hash")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in by_bucket(batches):
            counts = [len(r["more"]) // 2 for r in rows]
            doc = np.concatenate([wide(r["docs"], n) for r, n in zip(rows, counts)])
            more, hashes = (np.concatenate([np.frombuffer(r[c], kind) for r in rows]) for c, kind in (("more", "<u2"), ("hash", "<u8")))
            hit = _smaller_has(doc, more, hashes)
            parts = [(r, hit[e - n : e]) for r, n, e in zip(rows, counts, np.cumsum(counts))]
            yield _answers([(r["bundle"], r["part"], r["bucket"], np.packbits(x).tobytes()) for r, x in parts if x.any()])

    sent = asked.repartition(partitions(asked)).mapInArrow(send, "bundle string, part int, bucket int, docs binary, more binary, hash binary")
    return _by_bundle(to_buckets(sent).mapInArrow(meet, ANSWER))


def covered_bytes(docs: np.ndarray, offsets: np.ndarray, data: np.ndarray, told: Told, buckets: int, ranges: int) -> np.ndarray:
    """Which bytes of a pack go. The packs of a bundle must come in its order."""
    if not told.any:
        return np.zeros(len(data), bool)
    step = np.zeros(len(data) + 1, np.int32)
    for base, p in chunks(docs, offsets, data):
        states, of_phrases, of_groups, of_strings = told.next()
        state = p.states(states, buckets)
        whole = np.flatnonzero(state == SAME)
        np.add.at(step, base + p.start[whole], 1)
        np.add.at(step, base + p.end[whole], -1)
        masks = np.zeros(len(state), np.uint64)
        asked = p.sent[state[p.sent] == ASK]
        masks[asked] = of_phrases.take(p.bucket(asked, ranges))
        masks = np.where(state == ASK, masks[p.lead], 0).astype(np.uint64)
        if (state == SPREAD).any():
            groups = Groups(p, state)
            at, again = groups.answered(of_groups, ranges)
            if again.any():
                at = np.concatenate([at, Strings(p, groups, again).covered(of_strings, ranges)])
            np.add.at(step, base + at, 1)
            np.add.at(step, base + at + LENGTH, -1)
        for k in range(WINDOW):
            at = np.flatnonzero(masks >> np.uint64(k) & np.uint64(1)) if masks.any() else []
            if len(at):
                np.add.at(step, base + p.start[at] + k, 1)
                np.add.at(step, base + p.start[at] + k + LENGTH, -1)
    return np.cumsum(step[:-1]) > 0


def dedup(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", carry: bool = False) -> DataFrame:
    """One row per document: its id, n_bytes, spans (removed runs as start and end) and kept (the bytes that stay).

    With carry also kept_text, and carried: the other columns of docs as c0, c1, ... by their place.
    """
    spark, buckets = docs.sparkSession, max(2, partitions(docs))
    ranges = buckets * RANGES
    carried = carry_all(docs, text_column) if carry else None
    packs = write_packs(docs, shared_dir(spark, "pack_files"), id_column, text_column, carried, size=PACK_BYTES)
    extra = f", kept_text string, carried {docs.select(carried.alias('c')).schema['c'].dataType.simpleString()}" if carry else ""
    bundles = bundled(packs)
    # The answers grow with the corpus, so none of these joins broadcasts.
    states = staged(dictionary_states(bundles, buckets), "phrase_states").hint("merge")
    verdicts = staged(string_verdicts(bundles.join(states, "bundle"), buckets, ranges), "string_verdicts").hint("merge")
    both = bundles.join(states.withColumnRenamed("answers", "states"), "bundle").join(verdicts.withColumnRenamed("answers", "verdicts"), "bundle")
    lone = staged(lone_verdicts(both, buckets, ranges), "lone_verdicts").hint("merge")
    rows = bundles
    for found, name in ((states, "states"), (verdicts, "verdicts"), (lone, "lone")):
        rows = rows.join(found.withColumnRenamed("answers", name), "bundle", "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, *answers in zip(*(batch.column(c).to_pylist() for c in ("packs", "states", "verdicts", "lone"))):
                told = Told(buckets, ranges, *answers)
                for pack in some:
                    yield cut_pack(pack, told)

    def cut_pack(pack: str, told: Told) -> pa.RecordBatch:
        keys, known, offsets, data = open_pack(pack)
        gone = covered_bytes(keys, offsets, data, told, buckets, ranges)
        spans, kept = [], []
        for a, b in zip(offsets[:-1], offsets[1:]):
            edge = np.flatnonzero(np.diff(np.concatenate([[False], gone[a:b], [False]]).astype(np.int8)))
            spans.append([{"start": int(x), "end": int(y)} for x, y in zip(edge[::2], edge[1::2])])
            kept.append(data[a:b][~gone[a:b]].tobytes())
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        arrays, names = [pa.array(keys, mask=~known), pa.array(np.diff(offsets)), pa.array(spans, span), pa.array(kept, pa.binary())], [id_column, "n_bytes", "spans", "kept"]
        if carry:
            arrays += [pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string()), open_pack(pack, 2)]
            names += ["kept_text", "carried"]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    return rows.repartition(partitions(rows)).mapInArrow(cut, f"{id_column} long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary{extra}")


def cut_repeats(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", length_column: str | None = "n_chars") -> DataFrame:
    """docs with the bytes that stay as text, and their number of characters in length_column if docs has it.

    A cut may fall inside a character; the bytes of such a character that are left on their own are dropped. A null text
    stays null.
    """
    found = dedup(docs, id_column=id_column, text_column=text_column, carry=True)
    columns = {c: F.col(f"carried.c{i}") for i, c in enumerate(docs.columns)}
    columns[text_column] = F.when(~F.col("carried.no_text"), F.col("kept_text"))
    if length_column in columns:
        columns[length_column] = F.when(F.size("spans") > 0, F.length("kept_text").cast(docs.schema[length_column].dataType)).otherwise(columns[length_column])
    return found.select(*[x.alias(c) for c, x in columns.items()])
