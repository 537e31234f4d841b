"""Line deduplication against a plain version, both ways of probing, and the perfect hash alone."""

import re

import numpy as np
import pytest
from cases import documents, frame

from riskloom.llm import lines

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def plain(rows, min_documents=3, min_chars=20):
    def key(line):
        return re.sub("[A-Z]", lambda m: m.group().lower(), line.strip(BLANKS))

    below = -2 ** 63
    cut = [(below if r[0] is None else r[0], (r[1] or "").split("\n")) for r in rows]
    holders: dict[str, set] = {}
    for n, (i, ls) in enumerate(cut):
        for line in ls:
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add((i, n))
    out = []
    for r, (i, ls) in zip(rows, cut, strict=True):
        kept = [x for x in ls if len(holders.get(key(x), ())) < min_documents or max(holders[key(x)])[0] == i]
        out.append((r[0], len(ls), len(ls) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def rows():
    a, b, c = "A line that many documents Hold", "  another line, é ünd ß, of 20 and more\t", "日" * 20
    short = "nineteen letters ab"
    own = [
        (1, f"{a}\nfirst\n{b}\n{a}", "", "", 0), (2, a.lower() + "\r\nsecond", "", "", 0), (3, f"third\n\n \n{a} ", "", "", 0),
        (4, f"{b}\n{c}", "", "", 0), (5, f"{b.strip()}\n{c}\n", "", "", 0), (None, f"{a}\n{c}\ntail", "", "", 0), (None, a, "", "", 0),
        (6, f"{short}\n{short}x", "", "", 0), (7, f"{short}\n{short}x", "", "", 0), (8, f"{short}\n{short}x", "", "", 0), (8, f"{short}\n{short}x", "", "", 0),
        (9, "\n", "", "", 0), (10, "\n\n" + a + "\n\n", "", "", 0), (11, "x" * 300_000 + "\n" + a, "", "", 0), (12, a + "\n" + b, "", "", 0)]
    return documents() + own


@pytest.mark.parametrize("shared", [1 << 26, 0])
def test_lines(spark, shared):
    got = lines.drop_repeated_lines(frame(spark, rows()), shared_bytes=shared)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept"]
    want = plain(rows())
    assert sorted(map(tuple, got.collect()), key=str) == want and sum(w[2] for w in want) > 8


@pytest.mark.parametrize("shared", [1 << 26, 0])
def test_lines_odd_tables(spark, shared):
    assert lines.drop_repeated_lines(frame(spark, []), shared_bytes=shared).collect() == []
    line = "a line that nobody's id can keep"
    nobody = [(None, line, "", "", 0)] * 4 + [(2, None, "", "", 0), (2, "", "", "", 0)]
    got = lines.drop_repeated_lines(frame(spark, nobody), shared_bytes=shared, min_documents=1).collect()
    assert sorted(map(tuple, got), key=str) == [(2, 1, 0, "")] * 2 + [(None, 1, 0, line)] * 4


def test_many_shards(spark, monkeypatch):
    monkeypatch.setattr(lines, "SHARD_KEYS", 3)
    docs = [(i, "\n".join(f"line number {j} of the common ones" for j in range(i % 7, 40 + i % 5)), "", "", 0) for i in range(30)]
    for shared in (1 << 26, 0):
        got = lines.drop_repeated_lines(frame(spark, docs), shared_bytes=shared).collect()
        assert sorted(map(tuple, got), key=str) == plain(docs)


def test_perfect_hash():
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 2 ** 64, 20_000, np.uint64))
    shards = 5
    owner = lines.shard_of(keys, shards)
    made = [lines.shard_row(s, keys[owner == s], np.full((owner == s).sum(), 3), np.flatnonzero(owner == s)) for s in range(shards) if s != 2]
    index = lines.LineIndex.of(made, shards)
    slot = index.slots(keys)
    known = owner != 2
    assert sorted(slot[known].tolist()) == list(range(known.sum())) and (slot[~known] == -1).all()
    assert (index.last[slot[known]] == np.flatnonzero(known)).all()
    assert (index.slots(rng.integers(0, 2 ** 64, 200_000, np.uint64)) == -1).all()
    assert sum(len(m["words"]) for m in made) * 8 < 5 * known.sum()  # bits a key
    assert len(lines.perfect_hash(np.zeros(0, np.uint64))[1]) == 0
