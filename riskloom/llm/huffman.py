"""Token ids as files: canonical length-limited Huffman codes in independent blocks.

A store is a folder with two Parquet tables. ``code`` has the code length of every id that occurs;
canonical codes follow from it. ``blocks`` has a row per block of whole documents, in ascending
order of document key: the documents' keys and numbers of ids, the ids' code bits, and the bit
offset of every ``CHECKPOINT``-th id, from which decoding can begin.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import texts, wordids
from riskloom.session import materialise

#: Longest code in bits: the decoding table has two to this power entries.
LIMIT = 20
CHECKPOINT = 256
#: Ids after which a block is closed; a longer document is a block of its own.
BLOCK_IDS = 1 << 17
#: Blocks that a reader decodes at a time.
TOGETHER = 16


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Code length of each id, 0 for counts of 0: the cheapest prefix code without a longer code
    than ``limit``, by package-merge. Equal counts are taken in ascending order of id."""
    counts = np.asarray(counts, np.float64)
    used = np.flatnonzero(counts > 0)
    out = np.zeros(len(counts), np.int64)
    n = len(used)
    if n > 1 << limit:
        raise ValueError(f"{n} ids do not fit codes of {limit} bits")
    if n <= 1:
        out[used] = 1
        return out
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order]
    packages, kinds = np.zeros(0), []
    for _ in range(limit):
        merged = np.concatenate([leaves, packages])
        rank = np.argsort(merged, kind="stable")
        kinds.append(rank < n)  # whether a place in the list is a leaf
        merged = merged[rank]
        even = len(merged) // 2 * 2
        packages = merged[0:even:2] + merged[1:even:2]
    take = 2 * n - 2
    for leaf in reversed(kinds):
        whole = int(leaf[:take].sum())
        out[order[:whole]] += 1
        take = 2 * (take - whole)
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """The canonical code of each id: codes ascend by length, then id."""
    codes = np.zeros(len(lengths), np.uint64)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    if len(order):
        # Left-aligned in ``top`` bits, each code starts where the one before it ends.
        top = int(lengths[order].max())
        steps = np.uint64(1) << (top - lengths[order]).astype(np.uint64)
        starts = np.concatenate([np.zeros(1, np.uint64), np.cumsum(steps)[:-1]])
        codes[order] = starts >> (top - lengths[order]).astype(np.uint64)
    return codes


def decoding_table(lengths: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """(width, id, length) such that the next ``width`` bits of a stream give the next id."""
    used = np.flatnonzero(lengths)
    if not len(used):
        return 1, np.zeros(2, np.uint32), np.ones(2, np.uint8)
    order = used[np.lexsort((used, lengths[used]))]
    width = int(lengths[order].max())
    spread = 1 << (width - lengths[order])
    ids, sizes = np.zeros(1 << width, np.uint32), np.ones(1 << width, np.uint8)
    ids[:spread.sum()] = np.repeat(order, spread)
    sizes[:spread.sum()] = np.repeat(lengths[order], spread)
    return width, ids, sizes


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The code bits of ``ids``, high bit first in big-endian 64-bit words, and the bit offsets of
    every ``CHECKPOINT``-th id."""
    size = lengths[ids]
    if not size.all():
        raise ValueError("an id has no code")
    end = np.cumsum(size)
    begin = end - size
    total = int(end[-1]) if len(end) else 0
    words = np.zeros(total // 64 + 2, np.uint64)
    if total:
        code, size, shift = codes[ids], size.astype(np.uint64), (begin & 63).astype(np.uint64)
        place = begin >> 6
        room = np.uint64(64) - shift
        over = np.where(size > room, size - room, np.uint64(0))
        head = np.where(over > 0, code >> over, code << (room - np.minimum(size, room)))
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        words[place[first]] = np.bitwise_or.reduceat(head, first)
        split = np.flatnonzero(over > 0)
        words[place[split] + 1] |= code[split] << (np.uint64(64) - over[split])
    return words.astype(">u8").tobytes(), begin[::CHECKPOINT].astype(np.uint64)


def unpack(data: list[bytes], checkpoints: list[np.ndarray], counts: list[int],
           table: tuple[int, np.ndarray, np.ndarray]) -> np.ndarray:
    """The ids of some blocks, end to end: the stretches between checkpoints advance together,
    an id of each at a time, by table lookup."""
    width, symbol, size = table
    words = [np.frombuffer(d, ">u8").astype(np.uint64) for d in data]
    base = np.cumsum([0] + [len(w) for w in words]) * 64
    stream = np.concatenate([*words, np.zeros(1, np.uint64)])
    at = np.concatenate([c.astype(np.int64) + b for c, b in zip(checkpoints, base, strict=False)])
    per = [np.minimum(CHECKPOINT, n - np.arange(len(c)) * CHECKPOINT) for n, c in zip(counts, checkpoints, strict=True)]
    todo = np.concatenate(per).astype(np.int64)
    start = np.cumsum(todo) - todo
    out = np.zeros(int(todo.sum()), np.uint32)
    lanes = np.argsort(-todo, kind="stable")
    at, start, todo = at[lanes], start[lanes], todo[lanes]
    for step in range(int(todo.max(initial=0))):
        live = int(np.searchsorted(-todo, -step, side="left"))  # lanes with more than ``step`` ids
        at, start = at[:live], start[:live]
        place, shift = at >> 6, (at & 63).astype(np.uint64)
        bits = (stream[place] << shift) | ((stream[place + 1] >> np.uint64(1)) >> (np.uint64(63) - shift))
        bits = (bits >> np.uint64(64 - width)).astype(np.int64)
        out[start + step] = symbol[bits]
        at = at + size[bits]
    return out


def tokenised(docs: DataFrame, path: str, text: str, key: str) -> DataFrame:
    """``(key, ids, tie, row)`` of every document, written: its ids as packed integers, 16 bits wide if the
    vocabulary allows it, and what settles the order of documents that share a key."""
    with open(path, encoding="utf-8") as file:
        content = file.read()
    kind = id_type(wordids.check(content))
    shared = docs.sparkSession.sparkContext.broadcast(content)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = wordids.loaded(shared)
        for batch in batches:
            for a, b, raw, offsets in texts.chunks(batch.column(1)):
                ids, bounds = words.encode(raw, offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), texts.packed(ids.astype(kind), bounds)], names=["key", "ids"])

    source = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    encoded = source.mapInArrow(encode, "key long, ids binary")
    return materialise(encoded.select("key", "ids", F.xxhash64("ids").alias("tie"), F.monotonically_increasing_id().alias("row")), "huffman-ids")


def id_type(size: int) -> str:
    """The integers that a vocabulary of ``size`` ids is packed in."""
    return "<u2" if size <= 1 << 16 else "<u4"


def id_counts(encoded: DataFrame, kind: str, ids: str = "ids") -> tuple[np.ndarray, int]:
    """How often each id occurs in all documents, and the number of documents. A task sends a row per id it met."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(0, np.int64), 0
        for batch in batches:
            n += batch.num_rows
            flat, _ = texts.flat(batch.column(0))
            add = np.bincount(flat.view(kind), minlength=len(total))
            add[:len(total)] += total
            total = add
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(total[used], n))], names=["id", "n"])

    rows = encoded.select(ids).mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    known = {r["id"]: r["n"] for r in rows}  # one per id of the vocabulary at most
    n = known.pop(-1, 0)
    out = np.zeros(1 + max(known, default=0), np.int64)
    out[[*known]] = [*known.values()]
    return out, n


def write(docs: DataFrame, path: str, folder: str, end_id: int, text: str = "text", key: str = "doc_id",
          block_ids: int = BLOCK_IDS) -> None:
    """Writes the ids of all texts, ``end_id`` after each, as a store at ``folder``.

    Texts are encoded once, by the tokenizer file at ``path`` (see ``wordids.check`` for the files it takes), and their ids written; these are
    counted, then range-sorted by ``key`` and packed. Null keys come first; documents that share a key, null too, are
    ordered by a hash of their ids, so that even a key with most documents is cut into ranges. Null and empty texts have
    the end id alone; repeated rows are written as often as they occur. An empty table gives a store without blocks. Only the two
    named columns are read.
    """
    spark = docs.sparkSession
    encoded = tokenised(docs, path, text, key)
    with open(path, encoding="utf-8") as file:
        kind = id_type(wordids.check(file.read()))
    counts, n_docs = id_counts(encoded, kind)
    counts = np.pad(counts, (0, max(0, end_id + 1 - len(counts))))
    counts[end_id] += n_docs
    lengths = code_lengths(counts)
    used = np.flatnonzero(lengths)
    spark.createDataFrame(pa.table({"id": pa.array(used), "bits": pa.array(lengths[used])})).coalesce(1).write.parquet(f"{folder}/code")
    code = spark.sparkContext.broadcast((canonical(lengths), lengths))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, sizes = code.value
        part, number, before = TaskContext.get().partitionId(), 0, 0
        keys, held, ns, n = [], [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal number, before, n
            bits, checkpoints = pack(np.concatenate(held).astype(np.int64), codes, sizes)
            row = [[part], [number], [before], [n], [list(keys)], [list(ns)], [checkpoints.tobytes()], [bits]]
            number, before, n = number + 1, before + n, 0
            for x in (keys, held, ns):
                x.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()), strict=True)],
                names=["part", "block", "before", "n", "keys", "counts", "checkpoints", "bits"])

        tail = np.array([end_id], kind if end_id <= np.iinfo(kind).max else "<u4")
        for batch in batches:
            raw, offsets = texts.flat(batch.column(1))
            flat, at = raw.view(kind), (offsets // np.dtype(kind).itemsize).tolist()
            for key_, a, b in zip(batch.column(0).to_pylist(), at[:-1], at[1:], strict=True):
                keys.append(key_)
                held += [flat[a:b], tail]
                ns.append(b - a + 1)
                n += b - a + 1
                if n >= block_ids:
                    yield close()
        if keys:
            yield close()

    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["key", "tie", "row"]
    encoded.repartitionByRange(width, *order).sortWithinPartitions(*order).select("key", "ids").mapInArrow(
        blocks, "part int, block long, before long, n long, keys array<long>, counts array<long>, checkpoints binary, bits binary"
    ).write.option("compression", "uncompressed").parquet(f"{folder}/blocks")


def read(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """``key``, start, n_tokens, ids (little-endian unsigned 32-bit integers) of every document of
    a store; ``start`` counts the ids of all documents before it."""
    table = spark.read.parquet(f"{folder}/code")
    lengths = np.zeros(1 + (table.agg(F.max("id")).first()[0] or 0), np.int64)
    for row in table.collect():  # one per id of the vocabulary at most
        lengths[row["id"]] = row["bits"]
    stored = spark.read.parquet(f"{folder}/blocks")
    sums = sorted((r["part"], r["n"]) for r in stored.groupBy("part").agg(F.sum("n").alias("n")).collect())  # one per file
    starts, total = {}, 0
    for part, n in sums:
        starts[part] = total
        total += n
    shared = spark.sparkContext.broadcast((decoding_table(lengths), starts))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, ahead = shared.value
        for batch in batches:
            for first in range(0, batch.num_rows, TOGETHER):
                some = batch.slice(first, TOGETHER)
                part, before, n = (some.column(i).to_numpy() for i in range(3))
                ids = unpack(some.column(6).to_pylist(), [np.frombuffer(c, np.uint64) for c in some.column(5).to_pylist()], n.tolist(), code)
                docs = np.diff(some.column(3).offsets.to_numpy())
                keys, counts = some.column(3).flatten(), some.column(4).flatten().to_numpy()
                at = np.concatenate([[0], np.cumsum(counts)])  # ids of these blocks before each document
                base = np.array([ahead[p] for p in part.tolist()], np.int64) + before - (np.cumsum(n) - n)
                starts = at[:-1] + np.repeat(base, docs)
                for a in range(0, len(counts), 4096):  # documents per batch out
                    b = min(a + 4096, len(counts))
                    data = pa.Array.from_buffers(pa.binary(), b - a, [
                        None, pa.py_buffer(((at[a:b + 1] - at[a]) * 4).astype(np.int32).tobytes()), pa.py_buffer(ids[at[a]:at[b]].astype("<u4").tobytes())])
                    yield pa.RecordBatch.from_arrays(
                        [keys.slice(a, b - a), pa.array(starts[a:b]), pa.array(counts[a:b]), data], names=["key", "start", "n_tokens", "ids"])

    out = stored.select("part", "before", "n", "keys", "counts", "checkpoints", "bits").mapInArrow(
        decode, "key long, start long, n_tokens long, ids binary")
    return out.withColumnRenamed("key", key)
