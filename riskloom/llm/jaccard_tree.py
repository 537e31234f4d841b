"""Jaccard self-join of documents on word n-grams, by signature trees.

Who can meet whom: two sets whose similarity reaches the threshold differ in at most
``D = (n + m)(100 - p) / (100 + p)`` n-grams. The hash range is cut into more than D regions, as many
for all sets of a size class, so at least one region that is not empty holds the same n-grams in
both. The n-grams of a region are one key; sets that share a key get into one family, and linked
sets are always in one family. Unlike single n-grams, such keys do not become frequent when many
documents share a passage.

Inside a family the join is a dual traversal of a signature tree: a node holds the OR of the token
bitmaps below it and their range of sizes, and a pair of nodes goes when the most tokens it can
share is too few. What is left is compared exactly. Pairs already connected are passed over, so a
group of near copies costs about its size in comparisons, and links leave a task as a spanning
forest. A family above ``FAMILY_ROWS`` sets or ``FAMILY_TOKENS`` n-grams is cut into blocks by size, which are
joined alone; what then is not connected to the rest of the family goes to all its blocks whose sizes can match.

A key shared by more than ``FAMILY_ROWS`` sets, such as one from a passage that many documents have, says too little to
make a family of them. Its sets get keys anew, from ``FINER`` times as many regions. Of these, two linked sets share all but D,
so a set of which fewer regions are empty or crowded than any link must share has a key that is neither in common with
all it links to, and needs no crowded one. Only sets that have more, as members of a large group of near copies do, become one family by
a crowded key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import texts
from riskloom.llm.components import components
from riskloom.llm.narrowing import may_have, may_have_hashes
from riskloom.session import materialise

FAMILY_ROWS = 4096
FAMILY_TOKENS = 1 << 21
LEAF = 8
MOST_BITS = 1 << 14
#: Bits of a key that travel: two keys that fall together only make a group larger, which costs a comparison and loses nothing.
KEY_MASK = (1 << 48) - 1
#: Regions per n-gram of difference, where sets have crowded keys; and the low bits of such a key, which say its size class.
FINER = 3
CLASS_BITS = 7
#: Postings that a task packs, and later opens, at a time.
HELD_POSTINGS = 1 << 20
#: Bytes of text whose n-grams a task works on at a time.
TEXT_BYTES = 1 << 18
_BLOCK = pa.schema([("bucket", pa.int32()), ("first", pa.int64()), ("n", pa.int32()), *((c, pa.binary()) for c in ("steps", "sids", "place"))])
BLOCKS = "bucket int, first long, n int, steps binary, sids binary, place binary"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram hashes of each text, end to end, and their n + 1 offsets."""
    raw = _LOWER[raw]
    starts, ends, at = texts.words(raw, offsets)
    h = texts.span_hash(texts.prefix_hash(raw), starts, ends)
    out, bounds = [], np.zeros(len(offsets), np.int64)
    grams = None
    if len(h) >= size:
        m = len(h) - size + 1
        grams = np.zeros(m, np.uint64)
        for i in range(size):
            grams *= np.uint64(0xD1342543DE82EF95)
            grams += h[i:i + m]
        grams = texts.mix(grams)
    for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
        if b - a >= size:
            one = np.sort(grams[a:b - size + 1])
            keep = np.empty(len(one), bool)
            keep[0] = True
            np.not_equal(one[1:], one[:-1], out=keep[1:])
            one = one[keep]
        elif b > a:
            whole = np.full(1, b - a, np.uint64) * _ODD
            for x in h[a:b]:
                whole = whole * np.uint64(0xA24BAED4963EE407) + x
            one = texts.mix(whole)
        else:
            one = np.zeros(0, np.uint64)
        out.append(one)
        bounds[i + 1] = bounds[i] + len(one)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), bounds


def set_ids(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One 64-bit id per set; equal sets have equal ids."""
    sums = np.zeros(len(tokens) + 1, np.uint64)
    np.cumsum(texts.mix(tokens ^ _ODD), out=sums[1:])
    return texts.mix(sums[bounds[1:]] - sums[bounds[:-1]] + np.diff(bounds).astype(np.uint64) * _ODD).view(np.int64)


def size_classes() -> np.ndarray:
    """Lower bounds of the size classes: each half as large again as the one before."""
    bounds = [1]
    while bounds[-1] < 1 << 40:
        bounds.append(max(bounds[-1] + 1, bounds[-1] * 3 // 2))
    return np.array(bounds, np.int64)


_CLASSES = size_classes()


def _levels(sizes: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The sets that have keys in their own size class, then those that have some in the next, if a set half a class larger can
    still match them, and so on: (sets, size classes, how many n-grams two linked sets of that class can differ in)."""
    own = np.searchsorted(_CLASSES, sizes, side="right") - 1
    reach = np.searchsorted(_CLASSES, sizes * 100 // percent, side="right") - 1
    for step in range(int((reach - own).max(initial=0)) + 1):
        rows = np.flatnonzero((sizes > 0) & (own + step <= reach))
        level = own[rows] + step
        differ = 2 * (_CLASSES[level + 1] - 1) * (100 - percent) // (100 + percent)
        rows, level, differ = rows[differ > 0], level[differ > 0], differ[differ > 0]
        if len(rows):
            yield rows, level, differ


def _regions(tokens: np.ndarray, bounds: np.ndarray, rows: np.ndarray, regions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The regions that are not empty of the sets ``rows``, each set's hash range cut into its number of ``regions``:
    (which of ``rows``, region, sum of its n-grams)."""
    n = np.diff(bounds)[rows]
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(bounds[rows], n)
    t = tokens[place]
    region = ((t >> np.uint64(32)) * np.repeat(regions, n).astype(np.uint64)) >> np.uint64(32)
    owner = np.repeat(np.arange(len(rows)), n)
    first = np.flatnonzero(np.concatenate([[True], (region[1:] != region[:-1]) | (owner[1:] != owner[:-1])]))
    return owner[first], region[first], np.add.reduceat(texts.mix(t + _ODD), first)


def region_keys(tokens: np.ndarray, bounds: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all sets, end to end in the order of the sets, and their n + 1 offsets.

    A set has keys in its own size class and, if a set half a class larger can still match it, in
    the next. A set with so many empty regions that the only equal ones might be empty also gets
    its smallest n-grams as keys, enough to share one with any match.
    """
    sizes = np.diff(bounds)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for rows, level, differ in _levels(sizes, percent):
        regions = differ + 2 + differ // 32
        n = sizes[rows]
        who, region, sums = _regions(tokens, bounds, rows, regions)
        salt = region * np.uint64(0xC2B2AE3D27D4EB4F) + level[who].astype(np.uint64) * _ODD
        found.append((rows[who], texts.mix(sums + salt)))
        empty = regions - np.bincount(who, minlength=len(rows))
        for r in np.flatnonzero(empty >= regions - differ).tolist():
            few = n[r] - -(-percent * n[r] // 100) + 1
            one = tokens[bounds[rows[r]]:bounds[rows[r]] + few]
            found.append((np.full(few, rows[r]), texts.mix(one ^ np.uint64(level[r] + 1))))
    if not found:
        return np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    who = np.concatenate([w for w, _ in found])
    order = np.argsort(who, kind="stable")
    keys = np.concatenate([k for _, k in found])[order].view(np.int64)
    return keys, np.concatenate([[0], np.cumsum(np.bincount(who, minlength=len(sizes)))])


def finer_keys(tokens: np.ndarray, bounds: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(set of each key, keys, sets, their size classes, how many keys each can spare) per step of the size classes, from ``FINER`` times as many
    regions as ``region_keys`` has.

    Of a set's regions, all but those that it and the largest set that can match it differ in are equal in both. So if fewer
    than that are empty or have a crowded key, one that is neither is equal, whatever the match: a set can spare as many keys.
    """
    sizes = np.diff(bounds)
    for rows, level, differ in _levels(sizes, percent):
        regions, n = FINER * differ + 2, sizes[rows]
        who, region, sums = _regions(tokens, bounds, rows, regions)
        salt = region * np.uint64(0xC2B2AE3D27D4EB4F) + (level[who] + len(_CLASSES)).astype(np.uint64) * _ODD
        keys = (texts.mix(sums + salt) & np.uint64(KEY_MASK)).view(np.int64) >> CLASS_BITS << CLASS_BITS | level[who]
        most = (n + np.minimum(_CLASSES[level + 1] - 1, n * 100 // percent)) * (100 - percent) // (100 + percent)
        empty = regions - np.bincount(who, minlength=len(rows))
        yield rows[who], keys, rows, level, regions - most - 1 - empty


def bitmap(tokens: np.ndarray) -> bytes:
    """The set's token bitmap: two bits or more per token, up to ``MOST_BITS`` in all."""
    size = 64
    while size < min(2 * len(tokens), MOST_BITS):
        size *= 2
    bits = np.zeros(size, bool)
    bits[(tokens & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def folded(maps: list[bytes]) -> np.ndarray:
    """Bitmaps as rows of one width, the smallest: halves of a larger one are OR-combined."""
    width = min(map(len, maps)) // 8
    return np.stack([np.bitwise_or.reduce(np.frombuffer(m, np.uint64).reshape(-1, width), axis=0) for m in maps])


class SignatureTree:
    """A tree over sets in a given order, from their bitmaps and sizes: leaves of ``LEAF`` sets,
    each level above joining ``LEAF`` nodes."""

    def __init__(self, maps: np.ndarray, n: np.ndarray):
        #: per level from the sets up: bitmap, least size, largest size, most tokens beyond the set bits
        self.levels = [(maps, n, n, n - np.bitwise_count(maps).sum(1).astype(np.int64))]
        while len(self.levels[-1][0]) > 1:
            m, low, high, slack = self.levels[-1]
            at = np.arange(0, len(m), LEAF)
            self.levels.append((np.bitwise_or.reduceat(m, at), np.minimum.reduceat(low, at),
                                np.maximum.reduceat(high, at), np.maximum.reduceat(slack, at)))

    def alive(self, level: int, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
        """Which node pairs can hold a match: sizes compatible, and enough tokens to share."""
        m, low, high, slack = self.levels[level]
        out = (100 * high[i] >= percent * low[j]) & (100 * high[j] >= percent * low[i])
        for a in range(0, len(i), 4096):
            s = slice(a, a + 4096)
            x, y = i[s], j[s]
            shared = np.bitwise_count(m[x] & m[y]).sum(1).astype(np.int64) + np.minimum(slack[x], slack[y])
            out[s] &= (100 + percent) * np.minimum(shared, np.minimum(high[x], high[y])) >= percent * (low[x] + low[y])
        return out

    def leaf_pairs(self, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs i <= j of leaves that the dual traversal leaves over."""
        top = len(self.levels) - 1
        i = j = np.zeros(1, np.int64)
        for level in range(top - 1, 0, -1):
            count = len(self.levels[level][0])
            a = (i[:, None, None] * LEAF + np.arange(LEAF)[None, :, None]) + np.zeros((1, 1, LEAF), np.int64)
            b = (j[:, None, None] * LEAF + np.arange(LEAF)[None, None, :]) + np.zeros((1, LEAF, 1), np.int64)
            a, b = a.ravel(), b.ravel()
            ok = (a <= b) & (a < count) & (b < count)
            a, b = a[ok], b[ok]
            ok = self.alive(level, a, b, percent)
            i, j = a[ok], b[ok]
        return i, j


class Forest:
    """Which members of a group are connected so far."""

    def __init__(self, n: int):
        self.root = list(range(n))

    def find(self, i: int) -> int:
        root = self.root
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def join(self, i: int, j: int) -> None:
        self.root[self.find(j)] = self.find(i)


def traverse(tree: SignatureTree, forest: Forest, percent: int) -> Iterator[tuple[int, int]]:
    """Pairs of sets that the dual traversal leaves over and that are not connected by then."""
    n = len(tree.levels[0][0])
    i, j = tree.leaf_pairs(percent)
    nearest = np.argsort(j - i, kind="stable")
    for a, b in zip(i[nearest].tolist(), j[nearest].tolist(), strict=True):
        left, right = range(a * LEAF, min(a * LEAF + LEAF, n)), range(b * LEAF, min(b * LEAF + LEAF, n))
        if len({forest.find(x) for x in left} | {forest.find(y) for y in right}) == 1:
            continue
        x, y = np.array([(p, q) for p in left for q in right if p < q], np.int64).reshape(-1, 2).T
        ok = tree.alive(0, x, y, percent)
        for p, q in zip(x[ok].tolist(), y[ok].tolist(), strict=True):
            if forest.find(p) != forest.find(q):
                yield p, q


def possible_links(maps: list[bytes], sizes: list[int], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that can be links by size and bitmap."""
    n, links = len(maps), []
    forest = Forest(n)
    if n > 4 * LEAF:
        order = sorted(range(n), key=lambda i: (sizes[i], maps[i]))
        tree = SignatureTree(folded([maps[i] for i in order]), np.array([sizes[i] for i in order], np.int64))
        for p, q in traverse(tree, forest, percent):
            forest.join(p, q)
            links.append((order[p], order[q]))
        return links
    width = min(map(len, maps))
    bits = [int.from_bytes(m if len(m) == width else folded([m, bytes(width)])[0].tobytes(), "little") for m in maps]
    for p in range(n):
        for q in range(p + 1, n):
            x, y = sizes[p], sizes[q]
            if 100 * min(x, y) < percent * max(x, y) or forest.find(p) == forest.find(q):
                continue
            common = min(x - (bits[p] & ~bits[q]).bit_count(), y - (bits[q] & ~bits[p]).bit_count())
            if (100 + percent) * common >= percent * (x + y):
                forest.join(p, q)
                links.append((p, q))
    return links


def family_links(sets: list[np.ndarray], sides: np.ndarray | None, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between ``sets``; with ``sides``, only links across sides."""
    if len(sets) < 2:
        return []
    order = sorted(range(len(sets)), key=lambda i: (sets[i][0], len(sets[i])) if len(sets[i]) else (0, 0))
    sets = [sets[i] for i in order]
    side = None if sides is None else sides[order]
    tree = SignatureTree(folded([bitmap(s) for s in sets]), np.array([len(s) for s in sets], np.int64))
    forest, links = Forest(len(sets)), []
    for p, q in traverse(tree, forest, percent):
        if side is not None and side[p] == side[q]:
            continue
        small, large = (sets[p], sets[q]) if len(sets[p]) <= len(sets[q]) else (sets[q], sets[p])
        at = np.searchsorted(large, small)
        common = int((large[np.minimum(at, len(large) - 1)] == small).sum())
        if 100 * common >= percent * (len(small) + len(large) - common):
            forest.join(p, q)
            links.append((order[p], order[q]))
    return links


def pack_postings(found: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], buckets: int, held: int = HELD_POSTINGS) -> Iterator[pa.RecordBatch]:
    """Blocks of the postings ``found``: (keys, place of each key's set, set ids). A block has the postings of one of ``buckets``
    equal parts of the key range: the sorted keys as steps, the distinct sets, and which of them each key is of. That is some 7
    bytes for a posting, where a row of two longs has 24. Up to ``held`` postings are packed at a time."""
    edges = np.array([-(-(b * (KEY_MASK + 1)) // buckets) for b in range(buckets + 1)], np.int64)

    def close() -> Iterator[pa.RecordBatch]:
        base = np.cumsum([0] + [len(s) for _, _, s in waiting])
        keys, sids = np.concatenate([k for k, _, _ in waiting]), np.concatenate([s for _, _, s in waiting])
        owner = np.concatenate([o + start for (_, o, _), start in zip(waiting, base.tolist(), strict=False)])
        order = np.argsort(keys)
        keys, owner = keys[order], owner[order]
        cuts = np.searchsorted(keys, edges)
        rows, size = [], 0
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            one, of = keys[cuts[b]:cuts[b + 1]], owner[cuts[b]:cuts[b + 1]]
            used = np.zeros(len(sids), bool)
            used[of] = True
            steps = np.diff(one, prepend=one[:1])
            steps = steps.astype(np.uint32) if steps.max() < 1 << 32 else steps
            place = (np.cumsum(used) - 1)[of].astype(np.uint16 if used.sum() <= 1 << 16 else np.uint32)
            rows.append((b, int(one[0]), len(one), steps.tobytes(), sids[used].tobytes(), place.tobytes()))
            size += len(one)
            if size >= 1 << 18 or b == buckets - 1:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _BLOCK, strict=True)], schema=_BLOCK)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _BLOCK, strict=True)], schema=_BLOCK)

    waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for one in found:
        if len(one[0]):
            waiting.append(one)
        if sum(len(k) for k, _, _ in waiting) >= held:
            yield from close()
            waiting = []
    if waiting:
        yield from close()


def groups_between(blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray]], low: int, high: int, held: int,
                   crowd: int | None = None, crowded: Callable[[np.ndarray, np.ndarray], None] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(name, sid) of the groups of sets whose key is in [low, high), from ``blocks`` (sorted keys, set ids, places in these): keys of
    one set only are left out, keys with the same sets are one group. A range of more than ``held`` postings is halved; a
    single key with more is passed on block by block, named by itself. The keys of more than ``crowd`` sets, and of more than ``held`` postings, are
    not passed on but given to ``crowded`` with their sets, if there is one."""
    spans = [np.searchsorted(keys, (low, high)).tolist() for keys, _, _ in blocks]
    total = sum(z - a for a, z in spans)
    if total < 2:
        return
    if total > held and high - low > 1:
        yield from groups_between(blocks, low, (low + high) // 2, held, crowd, crowded)
        yield from groups_between(blocks, (low + high) // 2, high, held, crowd, crowded)
        return
    if total > held:
        name = texts.mix(np.array([low], np.uint64) ^ _ODD).view(np.int64)
        for (_, known, place), (a, z) in zip(blocks, spans, strict=True):
            sids = np.unique(known[place[a:z]])
            if crowded:
                crowded(np.full(len(sids), low), sids)
            else:
                yield np.repeat(name, len(sids)), sids
        return
    keys = np.concatenate([k[a:z] for (k, _, _), (a, z) in zip(blocks, spans, strict=True)])
    sids = np.concatenate([known[place[a:z]] for (_, known, place), (a, z) in zip(blocks, spans, strict=True)])
    order = np.argsort(keys)
    keys, sids = keys[order], sids[order]
    same = keys[1:] == keys[:-1]
    again = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    keys, sids = keys[again], sids[again]
    order = np.lexsort((sids, keys))
    keys, sids = keys[order], sids[order]
    fresh = np.concatenate([[True], (keys[1:] != keys[:-1]) | (sids[1:] != sids[:-1])])[:len(keys)]
    keys, sids = keys[fresh], sids[fresh]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
    if not len(first):
        return
    count = np.diff(np.append(first, len(keys)))
    names = texts.mix(np.add.reduceat(texts.mix(sids.view(np.uint64) + _ODD), first) + count.astype(np.uint64) * _ODD)
    one = np.zeros(len(first), bool)
    one[np.unique(names, return_index=True)[1]] = True
    one &= count > 1
    if crowded:
        full = np.repeat(count > crowd, count)
        crowded(keys[full], sids[full])
        one &= count <= crowd
    yield np.repeat(names[one].view(np.int64), count[one]), sids[np.repeat(one, count)]


def shared_groups(blocks: DataFrame, buckets: int, held: int = HELD_POSTINGS) -> DataFrame:
    """Distinct (key, sid) of the packed postings ``blocks`` without keys of one set only; keys with the same sets become one,
    named by a sum over its sets, each counted once however often it was posted. A task has one part of the key range; it
    holds that part's blocks, about twice what the shuffle brings it, and opens ``held`` postings of it at a time."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, sids in groups_between(opened(batches), 0, KEY_MASK + 1, held):
            for a in range(0, len(names), 1 << 17):
                yield pa.RecordBatch.from_arrays([pa.array(names[a:a + (1 << 17)]), pa.array(sids[a:a + (1 << 17)])], names=["key", "sid"])

    return blocks.repartitionById(buckets, F.col("bucket")).mapInArrow(merge, "key long, sid long").distinct()


def opened(batches: Iterator[pa.RecordBatch]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, set ids, places in these) of the blocks that ``pack_postings`` made."""
    found = []
    for batch in batches:
        for _, start, n, steps, sids, place in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
            keys = np.cumsum(np.frombuffer(steps, np.uint32 if len(steps) == 4 * n else np.int64), dtype=np.int64) + start
            found.append((keys, np.frombuffer(sids, np.int64), np.frombuffer(place, np.uint16 if len(place) == 2 * n else np.uint32)))
    return found


def finer_groups(blocks: DataFrame, buckets: int, crowd: int, held: int = HELD_POSTINGS) -> DataFrame:
    """What ``shared_groups`` gives of the keys (``finer_keys``) that at most ``crowd`` sets share, not yet distinct, with 0 as ``n``. Of other keys a
    row (size class, sid, n) says how many of them a set has; the rows of a set add up."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full: list[tuple[np.ndarray, np.ndarray]] = []

        def rows(key: np.ndarray, sid: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for a in range(0, len(key), 1 << 17):
                yield pa.RecordBatch.from_arrays([pa.array(c[a:a + (1 << 17)]) for c in (key, sid, n)], names=["key", "sid", "n"])

        def counted() -> Iterator[pa.RecordBatch]:
            if full:
                level, sid = (np.concatenate([x[i] for x in full]) for i in range(2))
                full.clear()
                order = np.lexsort((sid, level))
                level, sid = level[order], sid[order]
                first = np.flatnonzero(np.concatenate([[True], (level[1:] != level[:-1]) | (sid[1:] != sid[:-1])])[:len(sid)])
                yield from rows(level[first], sid[first], np.diff(np.append(first, len(sid))))

        def crowded(keys: np.ndarray, sids: np.ndarray) -> None:
            full.append((keys & ((1 << CLASS_BITS) - 1), sids))

        for names, sids in groups_between(opened(batches), 0, KEY_MASK + 1, held, crowd, crowded):
            yield from rows(names, sids, np.zeros(len(names), np.int64))
            if sum(len(s) for _, s in full) >= held:
                yield from counted()
        yield from counted()

    return blocks.repartitionById(buckets, F.col("bucket")).mapInArrow(merge, "key long, sid long, n long")


def named_groups(postings: DataFrame, buckets: int = 8, held: int = HELD_POSTINGS) -> DataFrame:
    """``shared_groups`` of postings that are rows (key, sid)."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            for batch in batches:
                sids, place = np.unique(batch.column(1).to_numpy(), return_inverse=True)
                yield batch.column(0).to_numpy(), place, sids
        return pack_postings(found(), buckets, held)

    return shared_groups(postings.mapInArrow(pack, BLOCKS), buckets, held)


def _across_blocks(placed: DataFrame, found: DataFrame, compare: Callable[[DataFrame], DataFrame], percent: int,
                   family_rows: int, family_tokens: int) -> DataFrame:
    """The links across the blocks of large families, as far as they matter for what is connected, given the links ``found`` within the blocks.

    One member of each component of each block stands for it in a comparison of its own, which connects most of a group of near copies. What a
    family then has beside its largest component goes to all blocks whose sizes can match; two members of the largest
    component need no comparison. So a text goes to a few tasks, not to every pair of blocks.
    """
    def labelled(links: DataFrame) -> DataFrame:
        known = components(links, "jaccard-blocks").select(F.col("node").alias("sid"), F.col("component").alias("label"))
        return placed.join(known, "sid", "left").withColumn("label", F.coalesce("label", "sid"))

    def cut(rows: DataFrame, *by: str) -> DataFrame:
        """``rows`` with ``parts``: how many tasks those that agree in ``by`` are cut into."""
        size = rows.groupBy(*by).agg(F.count("*").alias("rows"), F.sum("n").alias("tokens"))
        return rows.join(size.select(*by, F.greatest(F.lit(1), F.ceil(2 * F.col("rows") / family_rows), F.ceil(2 * F.col("tokens") / family_tokens)).alias("parts")), list(by))

    first = labelled(found).groupBy("family", "band", "part", "label").agg(F.min(F.struct("sid", "id", "n")).alias("one")).select("family", "one.*")
    stand = cut(first, "family").select("sid", "id", F.xxhash64(F.col("family"), F.lit("stand"), F.pmod("sid", "parts")).alias("task"),
                                        F.lit(0).alias("side"), F.lit(True).alias("alone"))
    more = compare(stand)
    now = materialise(labelled(found.unionByName(more)), "jaccard-labelled")
    sizes = now.groupBy("family", "label").agg(F.count("*").alias("rows"))
    main = sizes.groupBy("family").agg(F.max_by("label", F.struct("rows", "label")).alias("main"))
    rest = now.join(main, "family").where("label != main")
    rest = materialise(cut(rest.drop("parts"), "family", "band").withColumn("piece", F.pmod("sid", "parts")), "jaccard-rest")
    if rest.isEmpty():
        return more
    reach = int(np.ceil(np.log(100 / percent) / np.log(1.1))) + 1
    pieces = rest.select("family", "band", "piece").distinct()
    every = placed.select("family", F.col("band").alias("band2"), F.col("part").alias("part2")).distinct()
    pairs = pieces.join(every, "family").where(f"abs(band2 - band) <= {reach}").withColumn("task", F.xxhash64("family", "band", "piece", "band2", "part2"))
    pairs = materialise(pairs, "jaccard-pairs")
    left = rest.join(pairs, ["family", "band", "piece"]).select("sid", "id", "task", F.lit(0).alias("side"), F.lit(False).alias("alone"))
    right = now.select("family", F.col("band").alias("band2"), F.col("part").alias("part2"), "sid", "id").join(pairs, ["family", "band2", "part2"])
    right = right.select("sid", "id", "task", F.lit(1).alias("side"), F.lit(False).alias("alone"))
    # A member of both the piece and the block counts as the block's: the block's own members have met already.
    both = left.unionByName(right).groupBy("sid", "id", "task", "alone").agg(F.max("side").alias("side"))
    return more.unionByName(compare(both))


def jaccard_components(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = 5,
                       percent: int = 80, family_rows: int = FAMILY_ROWS, family_tokens: int = FAMILY_TOKENS,
                       rows_apart: bool = False) -> DataFrame:
    """(key, n_shingles, component_id) of every row: ``component_id`` is the smallest key reachable
    over links, and two rows link when 100 * common >= percent * union of their word n-gram sets.

    Words are runs of anything but the six ASCII blanks, A-Z in lower case. A text with fewer words
    than ``shingle`` is one n-gram. A null, empty or blank text has no n-grams and stays alone; so
    does a row with a null key, whose component is null. Rows repeated in all columns stay repeated. An empty table gives an empty
    one. Other columns are not read, whatever their names. N-grams, sets and keys are 64-bit hashes.

    With ``rows_apart``, also what tells rows apart that share a key: ``text_hash``, xxhash64 of the text, and
    ``component``, one number per component (null for rows that stay alone).
    """
    spark = docs.sparkSession
    source = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    hashed = source.withColumn("text_hash", F.xxhash64("text")) if rows_apart else source
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def fresh_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """(ids, sets, offsets, set ids, which of them this task meets for the first time): a copy
        in the same task adds nothing."""
        seen: set[int] = set()
        for batch in batches:
            ids, hashes = batch.column(0), batch.column(batch.num_columns - 1)
            for a, b, raw, offsets in texts.chunks(batch.column(1), TEXT_BYTES):
                tokens, bounds = shingle_sets(raw, offsets, shingle)
                sids = set_ids(tokens, bounds)
                fresh = np.zeros(b - a, bool)
                for i, sid in enumerate(sids.tolist()):
                    if sid not in seen and ids[a + i].is_valid:
                        seen.add(sid)
                        fresh[i] = True
                yield ids.slice(a, b - a), tokens, bounds, sids, fresh, hashes.slice(a, b - a)

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, tokens, bounds, sids, fresh, hashes in fresh_sets(batches):
            cuts = bounds.tolist()
            maps = [bitmap(tokens[x:y]) if f and y > x else None for x, y, f in zip(cuts[:-1], cuts[1:], fresh.tolist(), strict=True)]
            columns = {"id": ids, "n": pa.array(np.diff(bounds)), "sid": pa.array(sids), "bits": pa.array(maps, pa.binary())}
            yield pa.RecordBatch.from_pydict(columns | ({"text_hash": hashes} if rows_apart else {}))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            for _, tokens, bounds, sids, fresh, _ in fresh_sets(batches):
                keys, at = region_keys(tokens, bounds, percent)
                keep, owner = np.repeat(fresh, np.diff(at)), np.repeat(np.arange(len(sids)), np.diff(at))
                yield keys[keep] & KEY_MASK, owner[keep], sids
        return pack_postings(found(), width)

    # Sets are hashed again for their keys: that is cheaper than writing the keys.
    profiles = materialise(hashed.mapInArrow(profile, "id long, n long, sid long, bits binary" + ", text_hash long" * rows_apart), "jaccard-profiles")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, crowded = None, {}, False

        def close() -> Iterator[pa.RecordBatch]:
            if crowded:
                yield pa.RecordBatch.from_arrays([pa.array([first] * len(held)), pa.array(list(held))], names=["a", "b"])
            elif len(held) > 1:
                ids, (sizes, maps) = list(held), zip(*held.values(), strict=True)
                found = possible_links(list(maps), list(sizes), percent)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([ids[p] for p, _ in found]), pa.array([ids[q] for _, q in found])], names=["a", "b"])

        for batch in batches:
            over: list[tuple[int, int]] = []
            for k, sid, n, bits in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if k != key:
                    yield from close()
                    key, held, crowded, first = k, {}, False, sid
                if sid in held or bits is None:
                    continue
                if len(held) < family_rows:
                    held[sid] = (n, bits)
                else:  # a group beyond what a task compares is one family, held sets and all
                    crowded = True
                    over.append((first, sid))
            if over:
                yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in over]), pa.array([b for _, b in over])], names=["a", "b"])
        yield from close()

    def uncrowded(postings: DataFrame, crowded: DataFrame) -> DataFrame:
        """``postings`` with finer keys in place of those in ``crowded``, which only sets keep that cannot spare them."""
        full = materialise(postings.join(crowded, "key", "left_semi"), "jaccard-full")
        live = may_have_hashes(full.select("sid").distinct())

        def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, tuple]]:
            for _, tokens, bounds, sids, fresh, _ in fresh_sets(batches):
                keep = np.flatnonzero(fresh & live(sids.view(np.uint64)))
                if len(keep):
                    own = np.concatenate([tokens[bounds[i]:bounds[i + 1]] for i in keep.tolist()])
                    for one in finer_keys(own, np.concatenate([[0], np.cumsum(np.diff(bounds)[keep])]), percent):
                        yield sids[keep], one

        def post_finer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return pack_postings(((keys, owner, sids) for sids, (owner, keys, *_) in chosen(batches)), width)

        def spare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for sids, (_, _, rows, level, most) in chosen(batches):
                yield pa.RecordBatch.from_arrays([pa.array(sids[rows]), pa.array(level), pa.array(most)], names=["sid", "level", "spare"])

        finer = materialise(finer_groups(source.mapInArrow(post_finer, BLOCKS), width, family_rows), "jaccard-finer")
        over = finer.where("n > 0").groupBy("sid", F.col("key").alias("level")).agg(F.sum("n").alias("n"))
        short = source.mapInArrow(spare, "sid long, level long, spare long").join(over, ["sid", "level"], "left").where("coalesce(n, 0) > spare")
        short = materialise(short.select("sid").distinct(), "jaccard-short")
        return postings.join(crowded, "key", "left_anti").unionByName(finer.where("n = 0").select("key", "sid").distinct()).unionByName(
            full.join(short, "sid", "left_semi").select("key", "sid"))

    # Keys of one set only go at once. Near copies share most of their keys: groups with the same
    # members are one group, named by their members. What is left is written, so that the packed postings
    # need not stay on disk while it takes sizes and bitmaps along.
    postings = materialise(shared_groups(source.mapInArrow(post, BLOCKS), width), "jaccard-postings")
    crowded = materialise(postings.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > family_rows).select("key"), "jaccard-crowded")
    if not crowded.isEmpty():
        postings = uncrowded(postings, crowded)
    maps = profiles.where("bits is not null").groupBy("sid").agg(F.min("id").alias("id"), F.min("n").alias("n")).join(
        profiles.where("bits is not null").select("id", "sid", "bits").withColumnRenamed("sid", "of"), "id").where("sid = of").select("sid", "n", "bits")
    meets = postings.join(maps, "sid").select("key", "sid", "n", "bits").repartition(width, "key").sortWithinPartitions("key", "sid").mapInArrow(
        meet, "a long, b long")
    families = components(meets, "jaccard-families").select(F.col("node").alias("sid"), F.col("component").alias("family"))
    first = profiles.where("n > 0 and id is not null").groupBy("sid").agg(F.min("id").alias("id"), F.first("n").alias("n"))
    members = materialise(families.join(first, "sid"), "jaccard-members")

    # Blocks: one for a family that fits a task; otherwise by size, and by hash where many are of a size.
    band = F.floor(F.log(F.col("n")) / F.log(F.lit(1.1)))
    total = members.groupBy("family").agg(F.count("*").alias("rows"), F.sum("n").alias("tokens"))
    large = materialise(total.where((F.col("rows") > family_rows) | (F.col("tokens") > family_tokens)).select("family"), "jaccard-large")
    placed = members.join(large.withColumn("large", F.lit(True)), "family", "left").withColumn(
        "band", F.when(F.col("large"), band).otherwise(F.lit(0)))
    split = (placed.where("large").groupBy("family", "band").agg(F.count("*").alias("rows"), F.sum("n").alias("tokens"))
             .select("family", "band", F.greatest(F.lit(1), F.ceil(2 * F.col("rows") / family_rows),
                                                  F.ceil(2 * F.col("tokens") / family_tokens)).alias("parts")))
    placed = materialise(placed.join(split, ["family", "band"], "left").withColumn("part", F.coalesce(F.pmod("sid", "parts"), F.lit(0))), "jaccard-placed")

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, ids, held, side, alone = None, [], [], [], True

        def close() -> Iterator[pa.RecordBatch]:
            found = family_links(held, None if alone else np.array(side), percent)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([ids[p] for p, _ in found]), pa.array([ids[q] for _, q in found])], names=["a", "b"])

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for a, b, raw, offsets in texts.chunks(batch.column(4), TEXT_BYTES):
                tokens, bounds = shingle_sets(raw, offsets, shingle)
                own = set_ids(tokens, bounds).tolist()
                for i, (t, sid, s, whole) in enumerate(zip(*(c[a:b] for c in columns), strict=True)):
                    if own[i] != sid:  # another text with the same key
                        continue
                    if t != task:
                        yield from close()
                        task, ids, held, side, alone = t, [], [], [], whole
                    elif ids[-1] == sid:  # a repeated row
                        continue
                    ids.append(sid)
                    held.append(tokens[bounds[i]:bounds[i + 1]].copy())
                    side.append(s)
        yield from close()

    def compare(tasks: DataFrame) -> DataFrame:
        """The links found in ``tasks`` (sid, id, task, side, alone), written. Texts, not their larger sets, go there; a text goes once
        through the join by key."""
        needed = materialise(tasks.groupBy("id", "sid").agg(F.collect_list(F.struct("task", "side", "alone")).alias("to")), "jaccard-needed")
        sent = source.where(may_have(needed.select("id"), F.col("id"))).join(needed, "id").select("sid", "text", F.explode("to").alias("to"))
        sent = sent.select("to.task", "sid", "to.side", "to.alone", "text")
        return materialise(sent.repartition(width, "task").sortWithinPartitions("task", "sid").mapInArrow(links, "a long, b long"), "jaccard-found")

    # A small family is one task. Of a large one, first its blocks are joined, each alone.
    whole = placed.where("large is null").select("sid", "id", F.col("family").alias("task"), F.lit(0).alias("side"), F.lit(True).alias("alone"))
    blocks = placed.where("large").select("sid", "id", F.xxhash64("family", "band", "part").alias("task"), F.lit(0).alias("side"), F.lit(True).alias("alone"))
    found = compare(whole.unionByName(blocks))
    if not large.isEmpty():
        found = found.unionByName(_across_blocks(placed.where("large"), found, compare, percent, family_rows, family_tokens))
    labels = components(found, "jaccard-links").select(F.col("node").alias("sid"), F.col("component").alias("label"))

    known = first.select("sid", "id").join(labels, "sid", "left").select("sid", "id", F.coalesce("label", "sid").alias("label"))
    least = known.groupBy("label").agg(F.min("id").alias("component_id"))
    classes = known.join(least, "label").select("sid", "component_id", "label")
    linked = (F.col("n") > 0) & F.col("id").isNotNull()
    apart = ["text_hash", F.when(linked, F.col("label")).alias("component")] if rows_apart else []
    return profiles.drop("bits").join(classes, "sid", "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"),
        F.when(linked, F.col("component_id")).otherwise(F.col("id")).alias("component_id"), *apart)
