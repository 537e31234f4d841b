"""Byte-level BPE on Spark: forced boundaries, merges by rank, decoding by table.

A pair of bytes that stands side by side in no vocabulary token can never be merged over, so
between two such bytes there is a boundary in any encoding. Words, as the pre-tokeniser's pattern
cuts them, are split there, and the fragments are encoded alone and concatenated.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from riskloom.llm import texts

#: Fixed value: the published pattern of byte-level pre-tokenisation.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words kept with their ids by one Python worker; above it the store is begun anew.
KEPT_WORDS = 100_000
_INPUT = "__input"
#: Characters of a word above which it is encoded alone and not kept.
LONG_WORD = 48
_NO_RANK = 1 << 62
_NEVER = (_NO_RANK, -1)


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for
    themselves, the others numbered from 256 in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class _Arrays:
    """A vocabulary's tables as arrays."""

    def __init__(self, vocabulary: Vocabulary):
        self.single = np.array(vocabulary.single, np.int64)
        self.inside = np.zeros((256, 256), bool)
        for pair in vocabulary.inside:
            self.inside[pair] = True
        self.width = len(vocabulary.tokens)
        pairs = np.array([a * self.width + b for a, b in vocabulary.merges] or [-1], np.int64)
        order = np.argsort(pairs)
        self.pairs = pairs[order]
        self.results = np.array([*vocabulary.merges.values()] or [_NEVER], np.int64)[order]

    def ranked(self, ids: np.ndarray, fragment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the merge of each id with the next of its fragment, and the merged id."""
        pair = np.full(len(ids), -2, np.int64)
        pair[:-1] = np.where(fragment[1:] == fragment[:-1], ids[:-1] * self.width + ids[1:], -2)
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        found = self.pairs[at] == pair
        return np.where(found, self.results[at, 0], _NO_RANK), self.results[at, 1]


@dataclass
class Vocabulary:
    """What a tokenizer file says, and the ids of words met so far."""

    tokens: list[bytes]
    #: id of each byte
    single: list[int]
    #: pair of ids: (rank, id of the merged token)
    merges: dict[tuple[int, int], tuple[int, int]]
    special: dict[str, int]
    #: pairs of bytes side by side in some token
    inside: set[tuple[int, int]]
    kept: dict[str, bytes] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.arrays = _Arrays(self)

    @classmethod
    def parse(cls, content: str) -> Vocabulary:
        """From the JSON of a byte-level BPE without normaliser."""
        data = json.loads(content)
        model, byte = data["model"], {c: b for b, c in enumerate(byte_symbols())}
        if model["type"] != "BPE" or data["pre_tokenizer"]["type"] != "ByteLevel" or data["normalizer"] or data["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("not a plain byte-level BPE file")
        special = {t["content"]: t["id"] for t in data["added_tokens"]}
        ids = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items()}
        tokens = [b""] * (max([*ids.values(), *special.values()]) + 1)
        inside: set[tuple[int, int]] = set()
        for token, i in ids.items():
            tokens[i] = token
            inside.update(zip(token, token[1:]))
        for token, i in special.items():
            tokens[i] = token.encode()
        merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = (bytes(byte[c] for c in part) for part in (pair.split(" ") if isinstance(pair, str) else pair))
            merges[ids[a], ids[b]] = (rank, ids[a + b])
        return cls(tokens, [ids[bytes([b])] for b in range(256)], merges, special, inside)

    def fragments(self, word: bytes) -> list[bytes]:
        """The word cut between bytes that are side by side in no token."""
        inside = self.inside
        cuts = [i for i, pair in enumerate(zip(word, word[1:]), 1) if pair not in inside]
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])] if cuts else [word]

    def merge(self, fragment: bytes) -> list[int]:
        """Ids of a fragment: the leftmost pair of lowest rank is merged until none is left. The pairs wait in a
        heap by rank and place, and the parts are linked to their neighbours, so the cost of a long fragment is little more than its length."""
        get = self.merges.get
        parts = [self.single[b] for b in fragment]
        n = len(parts)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        waiting = []
        for i, pair in enumerate(zip(parts, parts[1:])):
            found = get(pair)
            if found is not None:
                waiting.append((found[0], i, found[1], *pair))
        heapq.heapify(waiting)
        while waiting:
            _, i, new, left, right = heapq.heappop(waiting)
            j = after[i]
            if parts[i] != left or j < 0 or parts[j] != right:
                continue  # one of the two has been merged since
            parts[i], parts[j] = new, -1
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                found = get((new, parts[k]))
                if found is not None:
                    heapq.heappush(waiting, (found[0], i, found[1], new, parts[k]))
            h = before[i]
            if h >= 0:
                found = get((parts[h], new))
                if found is not None:
                    heapq.heappush(waiting, (found[0], h, found[1], parts[h], new))
        return [p for p in parts if p >= 0]

    def word(self, word: str) -> bytes:
        """The ids of one word, as little-endian 32-bit integers: for words too long to be learnt."""
        raw = word.encode()
        found = array("I")
        for fragment in self.fragments(raw):
            found.extend(self.merge(fragment))
        return found.tobytes()

    def learn(self, words: list[str]) -> None:
        """Keeps the ids of all these words. All their fragments are merged together: each round
        merges in every fragment the leftmost pair of lowest rank, until no fragment has one."""
        if not words:
            return
        raw = [w.encode() for w in words]
        sizes = np.array([len(r) for r in raw])
        flat = np.frombuffer(b"".join(raw), np.uint8)
        ids = self.arrays.single[flat]
        word = np.repeat(np.arange(len(raw)), sizes)
        begins = np.ones(len(flat), bool)
        begins[1:] = (word[1:] != word[:-1]) | ~self.arrays.inside[flat[:-1], flat[1:]]
        place, fragment = np.arange(len(flat)), np.cumsum(begins) - 1
        done_place, done_ids = [], []
        while len(ids):
            rank, new = self.arrays.ranked(ids, fragment)
            first = np.flatnonzero(np.concatenate([[True], fragment[1:] != fragment[:-1]]))
            counts = np.diff(np.append(first, len(ids)))
            least = np.minimum.reduceat(rank, first)
            going = np.repeat(least < _NO_RANK, counts)
            done_place.append(place[~going])
            done_ids.append(ids[~going])
            hit = np.flatnonzero((rank == np.repeat(least, counts)) & going)
            hit = hit[np.concatenate([[True], fragment[hit[1:]] != fragment[hit[:-1]]])] if len(hit) else hit
            ids[hit] = new[hit]
            going[hit + 1] = False
            ids, place, fragment = ids[going], place[going], fragment[going]
        place, ids = np.concatenate(done_place), np.concatenate(done_ids)
        order = np.argsort(place, kind="stable")
        ends = np.cumsum(np.bincount(word[place], minlength=len(raw))) * 4
        data, begin = ids[order].astype(np.uint32).tobytes(), 0
        for w, end in zip(words, ends.tolist(), strict=True):
            self.kept[w] = data[begin:end]
            begin = end

    def encode_all(self, rows: list[str | None]) -> list[bytes]:
        """The ids of some texts, the words new to the store learnt together."""
        if len(self.kept) >= KEPT_WORDS:
            self.kept.clear()
        cut = [[p if isinstance(p, int) else _words(p) for p in self._pieces(t)] if t else [] for t in rows]
        met: set[str] = set()
        for pieces in cut:
            met.update(*(p for p in pieces if not isinstance(p, int)))
        self.learn([w for w in met if w not in self.kept and len(w) <= LONG_WORD])
        return [b"".join([x for p in pieces for x in ([np.uint32(p).tobytes()] if isinstance(p, int) else self._known(p))]) for pieces in cut]

    def _known(self, words: list[str]) -> list[bytes]:
        known = [*map(self.kept.get, words)]
        return [self.word(w) if k is None else k for w, k in zip(words, known, strict=True)] if None in known else known

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian 32-bit integers."""
        return self.encode_all([text])[0]

    def _pieces(self, text: str) -> list[str | int]:
        pieces: list[str | int] = [text]
        for token, i in sorted(self.special.items(), key=lambda t: -len(t[0])):
            if token in text:
                cut = []
                for piece in pieces:
                    if isinstance(piece, int):
                        cut.append(piece)
                        continue
                    for n, part in enumerate(piece.split(token)):
                        cut += ([i] if n else []) + ([part] if part else [])
                pieces = cut
        return pieces

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.tokens[i] for i in ids]).decode("utf-8", "replace")


#: Up to here the word pattern is compiled with its classes spelt out, which is faster; beyond it
#: two libraries may follow different Unicode versions, and the pre-tokeniser's own classes decide.
_PLAIN_END = 0x500


def _plain_pattern() -> re.Pattern:
    """``PATTERN`` for texts below ``_PLAIN_END``, its classes written as ranges."""
    def ranges(test: str) -> str:
        inside = [c for c in range(_PLAIN_END) if regex.match(test, chr(c))]
        runs = [i for i, c in enumerate(inside) if i == 0 or c != inside[i - 1] + 1]
        return "".join(f"\\u{inside[a]:04x}-\\u{inside[b - 1]:04x}" for a, b in zip(runs, [*runs[1:], len(inside)], strict=True))

    letters, numbers, blanks = ranges(r"\p{L}"), ranges(r"\p{N}"), ranges(r"\s")
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{blanks}{letters}{numbers}]+|[{blanks}]+(?![^{blanks}])|[{blanks}]+")


_plain_words = _plain_pattern()
_beyond = re.compile(f"[^\\x00-\\u{_PLAIN_END - 1:04x}]")
_VOCABULARIES: dict[int, Vocabulary] = {}


def _words(text: str) -> list[str]:
    if text.isascii() or _beyond.search(text) is None:
        return _plain_words.findall(text)
    from tokenizers import pre_tokenizers

    return [text[a:b] for _, (a, b) in pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str(text)]


def _loaded(shared) -> Vocabulary:
    """The worker's own copy of a broadcast vocabulary file, kept between tasks."""
    content = shared.value
    key = hash(content)
    if key not in _VOCABULARIES:
        _VOCABULARIES.clear()
        _VOCABULARIES[key] = Vocabulary.parse(content)
    return _VOCABULARIES[key]


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``docs`` with ``ids``, the token ids of ``text`` as array<int>, and with ``decoded``, if that is a name, the text that the ids stand for.

    Ids are those of the tokenizers library for the file at ``path`` (read once, on the driver)
    without special tokens added; a special token's own string in a text is that token. Null
    and empty texts have an empty array. All other columns pass through, repeated rows too; a
    column that already has the name ``ids`` is replaced. A very long text is encoded whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_read(path))
    rest = [c for c in docs.columns if c not in (ids, decoded)]
    source = docs.select(*(F.col(f"`{c}`") for c in rest), F.col(f"`{text}`").cast("string").alias(_INPUT))
    added = [StructField(ids, ArrayType(IntegerType()))] + ([StructField(decoded, StringType())] if decoded else [])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _loaded(shared)
        for batch in batches:
            for a, b, _, _ in texts.chunks(batch.column(len(rest)), texts.SMALL_CHUNK):
                part = batch.slice(a, b - a)
                found = vocabulary.encode_all(part.column(len(rest)).to_pylist())
                at = np.concatenate([[0], np.cumsum([len(f) // 4 for f in found])]).astype(np.int32)
                new = pa.ListArray.from_arrays(pa.array(at), pa.array(np.frombuffer(b"".join(found), np.int32)))
                # In the same pass: a pass of its own would take one more worker per core.
                back = [pa.array([vocabulary.decode(np.frombuffer(f, np.uint32).tolist()) for f in found], pa.string())] if decoded else []
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], new, *back], names=[*rest, *(c.name for c in added)])

    # A chunk at a time, not a column at a time: what a task holds stays small.
    return source.mapInArrow(work, StructType([*(docs.schema[c] for c in rest), *added]))


def decode(encoded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``encoded`` with ``text``, the text of the array ``ids``, special tokens included; bytes
    that are no UTF-8 become the replacement character. Null arrays have the empty text, null and
    unknown ids none."""
    shared = encoded.sparkSession.sparkContext.broadcast(_read(path))
    rest = [c for c in encoded.columns if c != text]
    source = encoded.select(*(F.col(f"`{c}`") for c in rest), F.col(f"`{ids}`").alias(_INPUT))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _loaded(shared)
        n = len(vocabulary.tokens)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                out = []
                for row in part.column(len(rest)):
                    values = row.values
                    if values is None or len(values) == 0:
                        out.append("")
                        continue
                    values = values.drop_null().to_numpy(zero_copy_only=False)
                    out.append(vocabulary.decode(values[(values >= 0) & (values < n)].tolist()))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(out, pa.string())], names=[*rest, text])

    return source.mapInArrow(work, StructType([*(encoded.schema[c] for c in rest), StructField(text, StringType())]))
