"""Token ids of whole texts by a tokenizer whose pre-tokeniser drops blanks: array work over the words.

What stands between blanks is encoded by the library once per worker and kept; a stretch of texts is then cut,
hashed, looked up and put together without a step per word.
"""

from __future__ import annotations

import json
import os

import numpy as np

from riskloom.llm import texts

#: Words kept by one worker, a few dozen bytes each; above it the store is begun anew.
KEPT_WORDS = 2_000_000
#: Words that the library encodes at a time.
TOGETHER = 8192
#: Fixed value: the published pattern of the pre-tokenisers this module can cut at blanks for. No match holds a blank.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def check(content: str) -> int:
    """The number of ids of a tokenizer file, after a look whether texts may be cut at blanks: normalisation must not look over a
    blank, matches of the pre-tokeniser and added tokens must not hold or take one. Other files are refused."""
    data = json.loads(content)
    steps = [s["type"] for s in (data["normalizer"] or {}).get("normalizers", [])]
    split = (data["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    byte = split[-1]
    sound = (
        steps == ["NFC", "Replace", "Lowercase"] and data["normalizer"]["normalizers"][1]["pattern"] == {"Regex": r"\s+"}
        and [s.get("type") for s in split] == ["Split", "ByteLevel"] and split[0]["pattern"] == {"Regex": PATTERN}
        and split[0]["behavior"] == "Removed" and split[0]["invert"] and not byte["add_prefix_space"] and not byte["use_regex"]
        and data["model"]["type"] == "BPE" and not data["model"]["dropout"] and data["post_processor"] is None
        and not any(t["lstrip"] or t["rstrip"] or t["normalized"] or set(t["content"]) & set(" \t\n\x0b\x0c\r") for t in data["added_tokens"]))
    if not sound:
        raise ValueError("texts cannot be cut at blanks for this tokenizer file")
    return 1 + max([*data["model"]["vocab"].values(), *(t["id"] for t in data["added_tokens"])])


class WordIds:
    """The words met so far, by their 64-bit hash, and their ids end to end."""

    def __init__(self, content: str):
        from tokenizers import Tokenizer

        self.size = check(content)
        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self._clear()

    def _clear(self) -> None:
        self.hashes, self.start, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def learn(self, hashes: np.ndarray, words: list[str]) -> None:
        """Keeps the ids of ``words``, whose ascending ``hashes`` are not there yet."""
        counts, found = np.zeros(len(words), np.int64), []
        for a in range(0, len(words), TOGETHER):
            for i, one in enumerate(self.tokenizer.encode_batch_fast(words[a:a + TOGETHER], add_special_tokens=False), a):
                ids = one.ids
                counts[i] = len(ids)
                found.extend(ids)
        ends = np.cumsum(counts) + len(self.ids)
        at = np.searchsorted(self.hashes, hashes)
        self.hashes = np.insert(self.hashes, at, hashes)
        self.start = np.insert(self.start, at, ends - counts)
        self.count = np.insert(self.count, at, counts)
        self.ids = np.concatenate([self.ids, np.array(found, np.uint32)])

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some texts, end to end, and their n + 1 offsets."""
        starts, ends, at = texts.words(raw, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        met, first, which = np.unique(texts.span_hash(texts.prefix_hash(raw), starts, ends), return_index=True, return_inverse=True)
        if len(self.hashes) > KEPT_WORDS:
            self._clear()
        slot = np.searchsorted(self.hashes, met)
        new = np.flatnonzero(self.hashes[np.minimum(slot, len(self.hashes) - 1)] != met) if len(self.hashes) else np.arange(len(met))
        if len(new):
            data, where = raw.tobytes(), first[new]
            self.learn(met[new], [data[a:b].decode("utf-8", "replace") for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)])
            slot = np.searchsorted(self.hashes, met)
        begin, count = self.start[slot][which], self.count[slot][which]
        bounds = np.concatenate([[0], np.cumsum(count)])
        return self.ids[np.repeat(begin - bounds[:-1], count) + np.arange(bounds[-1])], bounds[at]


_LOADED: dict[int, WordIds] = {}


def loaded(shared) -> WordIds:
    """The worker's own copy of a broadcast tokenizer file, kept between tasks."""
    content = shared.value
    key = hash(content)
    if key not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _LOADED.clear()
        _LOADED[key] = WordIds(content)
    return _LOADED[key]
