"""Line deduplication by a sharded minimal perfect hash.

The distinct keys of lines that recur are cut into shards by their hash. A shard is a minimal
perfect hash, levels of bit arrays in which a key owns a bit where no other key of its level falls,
and arrays in the order of those bits: a compact fingerprint, the number of documents that hold the
line, and the largest document id among them. Documents probe the arrays with the hashes of their
lines; a key that was never put in meets another's fingerprint, or no bit at all, and is told apart by it.

While the whole index is small, tasks that read documents hold it. Beyond ``SHARED_BYTES`` the
hashes of lines travel to the shard they belong to instead, and only what was found travels back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import texts
from riskloom.session import materialise

#: Keys of a shard, on average.
SHARD_KEYS = 1 << 16
#: Bits of a level for each key that comes to it.
GAMMA = 2
#: An index above this size is probed shard by shard instead of being sent to every executor.
SHARED_BYTES = 64 << 20
#: Copies of a shard among which its probes are dealt, so that one line that everybody has does not fill one task.
SALTS = 16
#: Stands for a null id: below every id.
NO_ID = np.iinfo(np.int64).min

INDEX = "shard long, n long, sizes binary, words binary, low binary, high binary, documents binary, last binary"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_HALF = np.uint64(32)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def line_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all lines, without their line ends, and the n + 1 numbers of lines before
    each text. An empty text is one empty line."""
    breaks = np.flatnonzero(raw == 10)
    ends = np.sort(np.concatenate([breaks, offsets[1:]]), kind="stable")
    at = np.searchsorted(breaks, offsets) + np.arange(len(offsets))
    starts = np.concatenate([np.zeros(1, np.int64), ends[:-1] + 1]) if len(ends) else ends
    starts[at[:-1]] = offsets[:-1]
    return starts, ends, at


def line_keys(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, min_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """Which lines have a key of ``min_chars`` code points or more, and the 64-bit hashes of those
    keys: the line without ASCII blanks at both ends, A-Z in lower case."""
    solid = np.flatnonzero(~texts.is_space(raw))
    if not len(solid):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    first, last = np.searchsorted(solid, starts), np.searchsorted(solid, ends) - 1
    some = np.flatnonzero(first <= last)
    begin, end = solid[first[some]], solid[last[some]] + 1
    points = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=points[1:])
    long = points[end] - points[begin] >= min_chars
    some, begin, end = some[long], begin[long], end[long]
    if not len(some):
        return some, np.zeros(0, np.uint64)
    return some, texts.span_hash(texts.prefix_hash(_LOWER[raw]), begin, end)


def place(keys: np.ndarray, level: int, size: np.ndarray | int) -> np.ndarray:
    """The bit of each key in a level of ``size`` bits."""
    h = texts.mix(keys + np.uint64((level + 1) * int(_ODD) % (1 << 64))) >> _HALF
    return ((h * np.asarray(size, np.uint64)) >> _HALF).astype(np.int64)


def perfect_hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of the levels in bits and all their bits, in 64-bit words, for distinct ``keys``."""
    sizes, words, level = [], [], 0
    while len(keys):
        size = -(-GAMMA * len(keys) // 64) * 64
        at = place(keys, level, size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        words.append(np.packbits(alone, bitorder="little").view(np.uint64))
        keys, level = keys[~alone[at]], level + 1
    return np.array(sizes, np.int64), np.concatenate(words) if words else np.zeros(0, np.uint64)


def ranks(words: np.ndarray) -> np.ndarray:
    """How many bits are set before each word."""
    counts = np.bitwise_count(words).astype(np.int64)
    return np.cumsum(counts) - counts


def owned(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the bits ``at`` are set, and how many are set before each."""
    word, bit = words[at >> 6], (at & 63).astype(np.uint64)
    under = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
    return (word >> bit) & np.uint64(1) > 0, before[at >> 6] + under


@dataclass
class LineIndex:
    """Some shards, end to end: shard ``s`` of ``shards`` in all is row ``row[s]`` here, or -1."""

    shards: int
    row: np.ndarray
    sizes: np.ndarray
    base: np.ndarray
    words: np.ndarray
    before: np.ndarray
    low: np.ndarray
    high: np.ndarray
    documents: np.ndarray
    last: np.ndarray

    @classmethod
    def of(cls, rows: Sequence[dict], shards: int) -> LineIndex:
        """From rows of the index table."""
        row = np.full(shards, -1, np.int64)
        row[[r["shard"] for r in rows]] = np.arange(len(rows))
        levels = [np.frombuffer(r["sizes"], np.int64) for r in rows]
        sizes = np.zeros((len(rows), max(map(len, levels), default=0)), np.int64)
        for i, one in enumerate(levels):
            sizes[i, :len(one)] = one
        base = (np.cumsum(sizes.ravel()) - sizes.ravel()).reshape(sizes.shape)

        def joined(name: str, kind: type) -> np.ndarray:
            return np.frombuffer(b"".join(bytes(r[name]) for r in rows), kind)

        words = joined("words", np.uint64)
        return cls(shards, row, sizes, base, words, ranks(words), joined("low", np.uint32), joined("high", np.uint16),
                   joined("documents", np.uint32), joined("last", np.int64))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for a key that is not there."""
        out = np.full(len(keys), -1, np.int64)
        row = self.row[shard_of(keys, self.shards)]
        live = np.flatnonzero(row >= 0)
        for level in range(self.sizes.shape[1]):
            size = self.sizes[row[live], level]
            live, size = live[size > 0], size[size > 0]
            if not len(live):
                break
            hit, slot = owned(self.words, self.before, place(keys[live], level, size) + self.base[row[live], level])
            out[live[hit]] = slot[hit]
            live = live[~hit]
        found = np.flatnonzero(out >= 0)
        slot, key = out[found], keys[found]
        other = (self.low[slot] != key.astype(np.uint32)) | (self.high[slot] != (key >> _HALF).astype(np.uint16))
        out[found[other]] = -1
        return out


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (((keys >> _HALF) * np.uint64(shards)) >> _HALF).astype(np.int64)


def shard_row(shard: int, keys: np.ndarray, documents: np.ndarray, last: np.ndarray) -> dict:
    """A row of the index table from the shard's distinct keys."""
    sizes, words = perfect_hash(keys)
    base, before = np.cumsum(sizes) - sizes, ranks(words)
    order, live = np.empty(len(keys), np.int64), np.arange(len(keys))
    for level, size in enumerate(sizes.tolist()):
        hit, slot = owned(words, before, place(keys[live], level, size) + base[level])
        order[slot[hit]] = live[hit]
        live = live[~hit]
    keys = keys[order]
    return {"shard": shard, "n": len(keys), "sizes": sizes.tobytes(), "words": words.tobytes(), "low": keys.astype(np.uint32).tobytes(),
            "high": (keys >> _HALF).astype(np.uint16).tobytes(), "documents": np.minimum(documents[order], 0xFFFFFFFF).astype(np.uint32).tobytes(),
            "last": last[order].astype(np.int64).tobytes()}


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(NO_ID).to_numpy(zero_copy_only=False)


def line_index(source: DataFrame, min_documents: int, min_chars: int) -> tuple[DataFrame, int]:
    """The index table of ``source`` (id, text), written, and its number of shards (0: no line recurs).

    A line counts once per document. Tasks combine the lines of a stretch of texts, Spark those of a
    task, before anything is shuffled, so a line that a third of the documents hold is a row per task.
    """
    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = _ids(batch.column(0))
            for a, b, raw, offsets in texts.chunks(batch.column(1)):
                starts, ends, at = line_spans(raw, offsets)
                some, keys = line_keys(raw, starts, ends, min_chars)
                if not len(some):
                    continue
                doc = np.searchsorted(at, some, side="right") - 1
                order = np.lexsort((doc, keys))
                keys, doc = keys[order], doc[order]
                new = np.concatenate([[True], keys[1:] != keys[:-1]])
                once = new | np.concatenate([[True], doc[1:] != doc[:-1]])
                first = np.flatnonzero(new)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[first].view(np.int64)), pa.array(np.add.reduceat(once.astype(np.int64), first)),
                     pa.array(np.maximum.reduceat(ids[a + doc], first))], names=["key", "n", "last"])

    counted = source.mapInArrow(met, "key long, n long, last long").groupBy("key").agg(F.sum("n").alias("n"), F.max("last").alias("last"))
    repeated = materialise(counted.where(F.col("n") >= min_documents), "lines-repeated")
    shards = -(-repeated.count() // SHARD_KEYS)

    def build(group: pa.Table) -> pa.Table:
        keys, n, last = (group.column(i).to_numpy() for i in range(3))
        keys = keys.view(np.uint64)
        row = shard_row(int(group.column(3)[0].as_py()), keys, n, last)
        return pa.table({c: [v] for c, v in row.items()})

    high = F.shiftrightunsigned("key", 32)
    dealt = repeated.withColumn("shard", F.shiftrightunsigned(high * F.lit(max(1, shards)), 32))
    return materialise(dealt.groupBy("shard").applyInArrow(build, INDEX), "lines-index"), shards


def dropped(source: DataFrame, index: DataFrame, shards: int, min_chars: int) -> DataFrame:
    """(doc, keys): of each document (its id and text as one hash) the keys of the lines it loses, as
    64-bit integers, found at the shards the lines belong to. Documents that lose none are not there."""
    named = source.select("id", "text", F.xxhash64("id", "text").alias("doc"))

    def probes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = 0
        for batch in batches:
            ids, docs = _ids(batch.column(0)), batch.column(2).to_numpy()
            for a, _, raw, offsets in texts.chunks(batch.column(1), 8 * texts.CHUNK_BYTES):
                starts, ends, at = line_spans(raw, offsets)
                some, keys = line_keys(raw, starts, ends, min_chars)
                if not len(some):
                    continue
                who = a + np.searchsorted(at, some, side="right") - 1
                shard = shard_of(keys, shards)
                order = np.argsort(shard, kind="stable")
                shard, keys, who = shard[order], keys[order], who[order]
                edges = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]]))
                salt += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard[edges[:-1]]), pa.array(np.full(len(edges) - 1, salt % SALTS)), texts.packed(keys, edges),
                     texts.packed(ids[who], edges), texts.packed(docs[who], edges)], names=["shard", "salt", "keys", "ids", "docs"])

    asked = named.mapInArrow(probes, "shard long, salt long, keys binary, ids binary, docs binary")
    asked = asked.select("shard", "salt", F.lit(1).alias("kind"), F.struct("keys", "ids", "docs").alias("probe"),
                         F.lit(None).cast(index.select(F.struct("*").alias("x")).schema["x"].dataType).alias("rows"))
    held = index.select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"), F.lit(0).alias("kind"),
                        F.lit(None).cast(asked.schema["probe"].dataType).alias("probe"), F.struct(*index.columns).alias("rows"))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == 0:
                    here = LineIndex.of([row["rows"]], shards)
                    continue
                keys = np.frombuffer(row["probe"]["keys"], np.uint64)
                slot = here.slots(keys) if here is not None and here.row[row["shard"]] >= 0 else np.full(len(keys), -1)
                gone = np.flatnonzero(slot >= 0)
                gone = gone[here.last[slot[gone]] != np.frombuffer(row["probe"]["ids"], np.int64)[gone]] if len(gone) else gone
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(row["probe"]["docs"], np.int64)[gone]), pa.array(keys[gone].view(np.int64))],
                                                 names=["doc", "key"])

    width = int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = held.unionByName(asked).repartition(width, "shard", "salt").sortWithinPartitions("shard", "salt", "kind").mapInArrow(
        look_up, "doc long, key long")
    return met.groupBy("doc").agg(F.collect_set("key").alias("keys"))


def drop_repeated_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", min_documents: int = 3, min_chars: int = 20,
                        shared_bytes: int = SHARED_BYTES) -> DataFrame:
    """(key, n_lines, n_dropped, kept) of every row of ``docs``.

    Texts are cut at line feeds. A line's key is the line without ASCII blanks at both ends, A-Z in
    lower case. Lines whose key has ``min_chars`` code points and is found in ``min_documents`` rows go,
    except from the rows with the largest ``key`` that holds it, which keep all of them. What stays
    is joined by line feeds. A null or empty text is one empty line, and its ``kept`` is empty. Rows repeated or with one
    id are documents of their own; a null id is below every id (as is -2 ** 63, which counts as null), and if no holder
    has an id, all of them keep the line. An empty table gives an empty one. Other columns are not read.

    Keys are 64-bit hashes; a fingerprint is 48 bits of one, so of 2 ** 48 lines that do not recur and
    meet a taken slot, one is taken for another.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    index, shards = line_index(source, min_documents, min_chars)
    columns = [F.length(c) for c in ("sizes", "words", "low", "high", "documents", "last")]
    size = index.agg(F.sum(sum(columns[1:], columns[0])).alias("bytes")).first()["bytes"] or 0

    def apply(batches: Iterator[pa.RecordBatch], gone: Callable[[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray], np.ndarray]) -> Iterator[pa.RecordBatch]:
        """``gone`` tells of each line, by its row and key, whether it goes."""
        for batch in batches:
            ids = batch.column(0)
            for a, b, raw, offsets in texts.chunks(batch.column(1)):
                starts, ends, at = line_spans(raw, offsets)
                some, keys = line_keys(raw, starts, ends, min_chars)
                drop = np.zeros(len(starts), bool)
                if len(some):
                    drop[some] = gone(batch, a + np.searchsorted(at, some, side="right") - 1, keys)
                kept, bounds = without(raw, offsets, starts, ends, at, drop)
                lost = np.concatenate([[0], np.cumsum(drop)])
                out = pa.StringArray.from_buffers(b - a, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(kept.tobytes()))
                yield pa.RecordBatch.from_arrays([ids.slice(a, b - a), pa.array(np.diff(at)), pa.array(lost[at[1:]] - lost[at[:-1]]), out],
                                                 names=["id", "n_lines", "n_dropped", "kept"])

    schema = "id long, n_lines long, n_dropped long, kept string"
    if size <= shared_bytes:
        rows = [r.asDict() for r in index.collect()]  # below ``shared_bytes`` in all
        shared = spark.sparkContext.broadcast(rows)
        kept: dict[str, LineIndex] = {}

        def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if "index" not in kept:
                kept["index"] = LineIndex.of(shared.value, max(1, shards))
            here = kept["index"]

            def gone(batch: pa.RecordBatch, who: np.ndarray, keys: np.ndarray) -> np.ndarray:
                slot = here.slots(keys)
                out = slot >= 0
                out[out] = here.last[slot[out]] != _ids(batch.column(0))[who[out]]
                return out

            yield from apply(batches, gone)

        done = source.mapInArrow(probe, schema)
    else:
        lost = dropped(source, index, shards, min_chars).withColumnRenamed("doc", "of")
        joined = source.join(lost, F.xxhash64("id", "text") == F.col("of"), "left").select("id", "text", "keys")

        def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def gone(batch: pa.RecordBatch, who: np.ndarray, keys: np.ndarray) -> np.ndarray:
                out, lists = np.zeros(len(keys), bool), batch.column(2)
                for i in np.unique(who).tolist():
                    if lists[i].is_valid:
                        mine = who == i
                        out[mine] = np.isin(keys[mine], lists[i].values.to_numpy().view(np.uint64))
                return out

            yield from apply(batches, gone)

        done = joined.mapInArrow(told, schema)
    return done.withColumnRenamed("id", key)


def without(raw: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, at: np.ndarray, drop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts without the dropped lines, and their n + 1 offsets."""
    if not drop.any():
        return raw, offsets
    final = np.zeros(len(starts), bool)
    final[at[1:] - 1] = True
    edge = np.zeros(len(raw) + 2, np.int32)
    np.add.at(edge, starts[drop], 1)
    np.add.at(edge, ends[drop] + ~final[drop], -1)
    gone = np.cumsum(edge[:-2]) > 0
    # The last line that stays loses its line feed, if it was not the last line.
    stays = np.flatnonzero(~drop)
    text = np.searchsorted(at, stays, side="right") - 1
    last = stays[np.concatenate([text[1:] != text[:-1], [True]])] if len(stays) else stays
    gone[ends[last[~final[last]]]] = True
    lost = np.concatenate([[0], np.cumsum(gone)])
    return raw[~gone], offsets - lost[offsets]
