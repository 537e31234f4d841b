"""Removal of long repeated byte strings, by interval trees over sparse suffix arrays.

A string of ``length`` bytes is found through its anchor: among the ``GRAM``-byte grams inside it,
the one with the smallest hash, the first of equals. Equal strings have equal anchors at equal
places, so two strings can be equal only if their anchors' grams are, and only anchors whose gram
occurs again go on. Each takes with it as much text on both sides as a string of that length
around it can reach, its context.

The contexts of one gram form a sparse suffix array: sorted by what follows the anchor, with the
common prefixes of neighbours. A stack scan of these gives the tree of common-prefix intervals.
In each interval the left sides are sorted and compared: an occurrence is in a repeat as long as
the interval's prefix and the longest left extension it shares with any other member, so all
occurrences of every maximal repeat are found, not just neighbours.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import texts
from riskloom.llm.narrowing import may_have, may_have_hashes
from riskloom.session import materialise

GRAM = 48
#: A gram with more different contexts is resolved by counting windows, not as one group.
GROUP_ROWS = 20_000
_PIECE = 4 << 20


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values."""
    n = len(v)
    if n < width:
        return v[:0]
    full = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = v
    blocks = full.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - width + 1], ahead[width - 1:n])


def anchors(raw: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``raw`` of the anchors of all strings of ``length`` inside one text, and the
    hashes of their grams. ``raw`` may have up to 2 ** 24 bytes."""
    if len(raw) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(len(raw) - gram + 1)
    h = texts.span_hash(texts.prefix_hash(raw), at, at + gram)
    place = np.uint64((1 << 24) - 1)
    least = sliding_min((h & ~place) | at.astype(np.uint64), length - gram + 1)
    ends = np.repeat(offsets[1:], np.diff(offsets))[:len(least)]
    found = (least[np.arange(len(least)) + length <= ends] & place).astype(np.int64)
    if not len(found):
        return found, h[:0]
    found = found[np.concatenate([[True], found[1:] != found[:-1]])]
    return found, h[found]


def contexts(raw: np.ndarray, low: np.ndarray, high: np.ndarray, at: np.ndarray, left: int, right: int) -> np.ndarray:
    """A row per position: the bytes from ``left`` before it to ``right`` after it, each plus 1
    (UTF-8 has no byte 255), and 0 outside its text, which is [low, high)."""
    place = at[:, None] + np.arange(-left, right)
    inside = (place >= low[:, None]) & (place < high[:, None])
    out = raw[np.clip(place, 0, max(len(raw) - 1, 0))] + np.uint8(1)
    out[~inside] = 0
    return out


def row_hash(rows: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every row of bytes."""
    wide = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    wide[:, :rows.shape[1]] = rows
    h = np.zeros(len(rows), np.uint64)
    for column in wide.view(np.uint64).T:
        h = texts.mix(h * np.uint64(0x9FB21C651E98DF25) + column)
    return h


def shared(rows: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """How many leading bytes each row has in common with the next, not past its text's end."""
    if len(rows) < 2:
        return np.zeros(0, np.int64)
    other = rows[1:] != rows[:-1]
    first = np.where(other.any(1), other.argmax(1), rows.shape[1])
    return np.minimum(first, filled[:-1])


def common_prefix_intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """(first, last, prefix) of the intervals of a suffix array with these common prefixes of
    neighbours, inner intervals before outer ones; those of prefix 0 are left out."""
    stack: list[tuple[int, int]] = []
    for i, value in enumerate([*lcp, 0]):
        first = i
        while stack and stack[-1][1] > value:
            first, prefix = stack.pop()
            yield first, i, prefix
        if value and (not stack or stack[-1][1] < value):
            stack.append((first, value))


def extents(rows: np.ndarray, keys: np.ndarray, left: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each context how far the repeats of at least ``length`` bytes around its anchor go to
    the left and to the right; both 0 if there are none. ``keys`` are sorted; contexts with equal
    keys are compared, and they differ from one another."""
    n = len(rows)
    reach_left, reach_right = np.zeros(n, np.int64), np.zeros(n, np.int64)
    backward, forward = np.ascontiguousarray(rows[:, left - 1::-1] if left else rows[:, :0]), np.ascontiguousarray(rows[:, left:])
    has_left, has_right = (backward > 0).sum(1), (forward > 0).sum(1)
    edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    sizes = np.diff(edges)

    two = edges[:-1][sizes == 2]
    if len(two):
        other = np.concatenate([forward[two] != forward[two + 1], np.ones((len(two), 1), bool)], axis=1)
        after = np.minimum(other.argmax(1), has_right[two])
        other = np.concatenate([backward[two] != backward[two + 1], np.ones((len(two), 1), bool)], axis=1)
        before = np.minimum(other.argmax(1), has_left[two])
        for i in (0, 1):
            reach_left[two + i] = np.where(before + after >= length, before, 0)
            reach_right[two + i] = np.where(before + after >= length, after, 0)

    for a, b in zip(edges[:-1][sizes > 2].tolist(), edges[1:][sizes > 2].tolist(), strict=True):
        suffixes = a + np.argsort(forward[a:b].view(f"S{forward.shape[1]}").ravel(), kind="stable")
        by_left = a + np.argsort(backward[a:b].view(f"S{backward.shape[1]}").ravel(), kind="stable") if left else suffixes
        rank = np.empty(b - a, np.int64)
        rank[by_left - a] = np.arange(b - a)
        lcp = shared(forward[suffixes], has_right[suffixes])
        most_left = int(shared(backward[by_left], has_left[by_left]).max())
        if int(lcp.max()) + most_left < length:
            continue
        for first, last, prefix in common_prefix_intervals(lcp.tolist()):
            if prefix + most_left < length:
                continue
            members = suffixes[first:last + 1]
            members = members[np.argsort(rank[members - a], kind="stable")]
            lcs = shared(backward[members], has_left[members])
            best = np.maximum(np.concatenate([[0], lcs]), np.concatenate([lcs, [0]]))
            good = best + prefix >= length
            hit = members[good]
            reach_left[hit] = np.maximum(reach_left[hit], best[good])
            reach_right[hit] = np.maximum(reach_right[hit], prefix)
    return reach_left, reach_right


def repeated_spans(docs: DataFrame, text: str = "text", key: str = "doc_id", length: int = 200,
                   group_rows: int = GROUP_ROWS, gram: int = GRAM, whole_characters: bool = False,
                   carry: tuple[str, ...] = ()) -> DataFrame:
    """``key``, the columns named in ``carry``, n_bytes, kept (binary), spans (array of removed
    [start, end)) of every row.

    A byte of the UTF-8 text goes if it is in a string of ``length`` bytes that also starts
    anywhere else in the table, in the same or another row; strings do not cross rows. Null text
    is empty; a text shorter than ``length`` stays as it is. A null key is a key like any other,
    rows repeated in all columns are rows of their own (their long texts repeat each other), and an
    empty table gives an empty one. Other columns are not read, whatever their names. With
    ``whole_characters`` a character of which a byte goes, goes whole, so what is kept is UTF-8.
    Grams and contexts are compared by 64-bit hashes before their bytes are.
    """
    spark = docs.sparkSession
    left, gram = length - min(gram, length), min(gram, length)
    carried = F.struct(*(F.col(f"`{c}`") for c in (key, *carry))).alias("carried")
    source = docs.select(F.col(f"`{key}`").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"), carried)
    source = source.withColumn("row", F.xxhash64("id", "text"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            small, sizes = texts.compressed(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), small, sizes], names=["row", "carried", "packed", "size"])

    kind = source.schema["carried"].dataType.simpleString()
    # Texts are dealt twice, each time compressed.
    dealt = source.select("row", "carried", "text").mapInArrow(pack, f"row long, carried {kind}, packed binary, size long").repartition(width, "row")
    alone = source.select("row", "text").mapInArrow(
        lambda batches: (pa.RecordBatch.from_arrays([b.column(0), *texts.compressed(b.column(1))], names=["row", "packed", "size"]) for b in batches),
        "row long, packed binary, size long").repartition(width, "row")

    def find(batches: Iterator[pa.RecordBatch], live: Callable[[np.ndarray], np.ndarray] | None = None) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0).to_numpy(zero_copy_only=False)
            for a, b, raw, offsets in texts.chunks(batch.column(1), texts.SMALL_CHUNK):
                owner = np.arange(a, b)
                for start in range(0, max(len(raw), 1), _PIECE):  # more than one for a very long text only
                    part = raw[start:start + _PIECE + length - 1]
                    if start and len(part) < length:
                        break
                    cut = offsets if len(raw) == len(part) else np.array([0, len(part)])
                    at, h = anchors(part, cut, length, gram)
                    if live:
                        keep = live(h)
                        at, h = at[keep], h[keep]
                    who = np.searchsorted(cut, at, side="right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h.view(np.int64)), pa.array(rows[owner[who]]), pa.array(at + start - cut[who])], names=["gram", "row", "at"])

    found = source.select("row", "text").mapInArrow(find, "gram long, row long, at long")
    again = materialise(found.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"), "repeat-anchors")
    live = may_have_hashes(again)
    found = source.select("row", "text").mapInArrow(lambda batches: find(batches, live), "gram long, row long, at long")
    places = found.join(again, "gram", "left_semi").groupBy("row").agg(F.collect_set("at").alias("ats"))

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # contexts that this task has sent
        for batch in batches:
            rows = batch.column(0).to_numpy(zero_copy_only=False)
            ats = batch.column(3)
            for a, b, raw, offsets in texts.restored(batch.column(1), batch.column(2), texts.SMALL_CHUNK):
                one = ats.slice(a, b - a)
                counts = np.diff(one.offsets.to_numpy())
                at = np.asarray(one.flatten().to_numpy(zero_copy_only=False), np.int64)
                who = np.repeat(np.arange(b - a), counts)
                order = np.lexsort((at, who))
                at, who = at[order], who[order]
                for s in range(0, len(at), 2048):
                    p, w = at[s:s + 2048], who[s:s + 2048]
                    cuts = contexts(raw, offsets[w], offsets[w + 1], p + offsets[w], left, length)
                    h = row_hash(cuts).view(np.int64)
                    grams = row_hash(cuts[:, left:left + gram]).view(np.int64)
                    fresh = np.zeros(len(p), bool)
                    for i, x in enumerate(h.tolist()):
                        if x not in seen:
                            seen.add(x)
                            fresh[i] = True
                    data = pa.array([c.tobytes() if f else None for c, f in zip(cuts, fresh, strict=True)], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows[a:b][w]), pa.array(p), pa.array(grams), pa.array(h), data], names=["row", "at", "gram", "hash", "context"])

    occurrences = materialise(
        alone.join(places, "row").select("row", "packed", "size", "ats").mapInArrow(
            cut_out, "row long, at long, gram long, hash long, context binary"), "repeat-contexts")

    # A context that occurs again is in a repeat as far as it goes. So only grams with one that does not, and
    # another to compare it with, send their contexts; what the filter lets pass beside them finds nothing new.
    known = materialise(occurrences.groupBy("hash", "gram").agg(F.count("*").alias("n")), "repeat-hashes")
    grams = known.groupBy("gram").agg(F.count("*").alias("different"), F.min("n").alias("least")).where("different > 1 and least = 1")
    grams = materialise(grams.select("gram", "different"), "repeat-grams")
    counted = grams.where(F.col("different") > group_rows).select("gram")
    many = bool(counted.take(1))
    # Which way a gram goes is said by a filter, not by a join, so contexts are dealt out once. A gram that the filter takes for a
    # crowded one goes that way with all its contexts, and both ways give the same.
    needed, crowded = may_have(grams.select("gram"), F.col("gram")), may_have(counted, F.col("gram")) if many else F.lit(False)
    sent = occurrences.where("context is not null").select("gram", "hash", "context")

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = left + length

        def close(last: bool) -> pa.RecordBatch | None:
            """Works on all held rows but those of the last gram, which may go on."""
            g, h, rows = (np.concatenate([x[i] for x in held]) for i in range(3))
            end = len(g) if last else int(np.searchsorted(g, g[-1]))
            held[:] = [] if end == len(g) else [(g[end:], h[end:], rows[end:])]
            g, h, rows = g[:end], h[:end], rows[:end]
            if len(g):
                keep = np.concatenate([[True], (g[1:] != g[:-1]) | (h[1:] != h[:-1])])
                g, h, rows = g[keep], h[keep], rows[keep]
                before, after = extents(rows, g, left, length)
                hit = after > 0
                return pa.RecordBatch.from_arrays([pa.array(h[hit]), pa.array(before[hit]), pa.array(after[hit])], names=["hash", "before", "after"])

        for batch in batches:
            for s in range(0, batch.num_rows, 2048):
                part = batch.slice(s, 2048)
                raw, _ = texts.flat(part.column(2))
                held.append((part.column(0).to_numpy(), part.column(1).to_numpy(), raw.reshape(-1, size)))
                if held[0][0][0] != held[-1][0][-1] and sum(len(x[0]) for x in held) >= 4096 and (out := close(False)):
                    yield out
        if held and (out := close(True)):
            yield out

    reach = sent.where(needed & ~crowded).repartition(width, "gram").sortWithinPartitions("gram", "hash").mapInArrow(
        grouped, "hash long, before long, after long")
    if many:
        def windows(batches: Iterator[pa.RecordBatch], live: Callable[[np.ndarray], np.ndarray] | None = None) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for s in range(0, batch.num_rows, 1024):
                    part = batch.slice(s, 1024)
                    h, grams = part.column(0).to_numpy(), part.column(1).to_numpy()
                    raw, _ = texts.flat(part.column(2))
                    rows = raw.reshape(-1, left + length)
                    for offset in range(left + 1):
                        window = np.ascontiguousarray(rows[:, left - offset:left - offset + length])
                        ok = (window > 0).all(1)
                        # Of one gram at one place of the string: a string seen from two anchors is one occurrence.
                        place = texts.mix(texts.mix(row_hash(window[ok]) ^ grams[ok].view(np.uint64)) + np.uint64(offset))
                        own = h[ok]
                        if live:
                            keep = live(place)
                            place, own = place[keep], own[keep]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(place.view(np.int64)), pa.array(own), pa.array(np.full(len(own), offset))], names=["place", "hash", "before"])

        hot = materialise(sent.where(crowded).repartition(width, "hash").dropDuplicates(["hash"]).select("hash", "gram", "context"), "repeat-crowded")
        # Places are counted by an aggregate, which combines equal ones before the shuffle, and made again: one that a third
        # of the rows share is never one task's.
        shape = "place long, hash long, before long"
        twice = materialise(hot.mapInArrow(windows, shape).groupBy("place").agg(F.count("*").alias("n")).where("n > 1").select("place"), "repeat-windows")
        recurs = may_have_hashes(twice)
        seen_twice = hot.mapInArrow(lambda batches: windows(batches, recurs), shape).join(twice, "place", "left_semi")
        reach = reach.unionByName(seen_twice.groupBy("hash").agg(F.max("before").alias("before"), (F.lit(length) - F.min("before")).alias("after")))
    copies = known.where("n > 1").select(
        "hash", F.lit(left).cast("long").alias("before"), F.lit(length).cast("long").alias("after"))
    reach = reach.unionByName(copies).groupBy("hash").agg(F.max("before").alias("before"), F.max("after").alias("after"))
    covered = occurrences.select("row", "at", "hash").join(reach, "hash").groupBy("row").agg(
        F.collect_set(F.struct((F.col("at") - F.col("before")).alias("start"), (F.col("at") + F.col("after")).alias("end"))).alias("covered"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, covers = batch.column(0), batch.column(3)
            for a, b, raw, offsets in texts.restored(batch.column(1), batch.column(2), texts.SMALL_CHUNK):
                mask = np.zeros(len(raw), bool)
                for i in range(a, b):
                    if covers[i].is_valid:
                        low, high = offsets[i - a], offsets[i - a + 1]
                        for span in covers[i].as_py():
                            mask[max(low + span["start"], low):min(low + span["end"], high)] = True
                if whole_characters:
                    inner = (raw & 0xC0) == 0x80
                    character = np.cumsum(~inner) - 1
                    mask = np.bincount(character, weights=mask, minlength=1)[character] > 0 if len(raw) else mask
                step = np.zeros(len(raw) + 1, np.int8)
                edge = np.zeros(len(raw) + 1, bool)
                edge[offsets] = True
                step[0], step[-1] = (mask[0], -int(mask[-1])) if len(mask) else (0, 0)
                step[1:-1] = mask[1:].astype(np.int8) - mask[:-1]
                begin = np.flatnonzero((step == 1) | (edge & np.append(mask, False)))
                end = np.flatnonzero((step == -1) | (edge & np.concatenate([[False], mask])))
                who = np.searchsorted(offsets, begin, side="right") - 1
                per = np.concatenate([[0], np.cumsum(np.bincount(who, minlength=b - a))]).astype(np.int32)
                spans = pa.StructArray.from_arrays([pa.array(begin - offsets[who]), pa.array(end - offsets[who])], names=["start", "end"])
                left_over = np.concatenate([[0], np.cumsum(~mask)])[offsets]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(np.diff(offsets)), texts.packed(raw[~mask], left_over), pa.ListArray.from_arrays(pa.array(per), spans)],
                    names=["carried", "n_bytes", "kept", "spans"])

    out = dealt.join(covered, "row", "left").select("carried", "packed", "size", "covered").mapInArrow(
        remove, f"carried {kind}, n_bytes long, kept binary, spans array<struct<start long, end long>>")
    return out.select("carried.*", "n_bytes", "kept", "spans")
