"""Repeats, fingerprints, mixing, quality, tokens, licences and fixity against plain versions."""

import hashlib
import re
import time
import zlib
from collections import Counter

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import documents, frame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskloom.llm import bpe, fingerprints, fixity, huffman, licences, mixing, quality, queries, texts, wordids
from riskloom.llm.repeats import common_prefix_intervals, repeated_spans

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def cut(rows, length):
    raw = [(r[1] or "").encode() for r in rows]
    seen = Counter(b[s:s + length] for b in raw for s in range(len(b) - length + 1))
    out = []
    for r, b in zip(rows, raw, strict=True):
        gone = [False] * len(b)
        for s in range(len(b) - length + 1):
            if seen[b[s:s + length]] > 1:
                gone[s:s + length] = [True] * length
        spans, start = [], None
        for i, g in enumerate([*gone, False]):
            if g and start is None:
                start = i
            elif not g and start is not None:
                spans.append((start, i))
                start = None
        out.append((r[0], len(b), bytes(x for x, g in zip(b, gone, strict=True) if not g), tuple(spans)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("length", "gram", "group"), [(200, 48, 20_000), (60, 16, 20_000), (60, 16, 1), (9, 9, 20_000)])
def test_repeated_spans(spark, length, gram, group):
    rows = documents() + [(9001, documents()[3][1], None, None, 0)] * 2
    got = repeated_spans(frame(spark, rows), length=length, gram=gram, group_rows=group).collect()
    assert sorted(((r["doc_id"], r["n_bytes"], bytes(r["kept"]), tuple((s["start"], s["end"]) for s in r["spans"])) for r in got), key=str) == cut(rows, length)


def test_repeats_odd_tables(spark):
    assert repeated_spans(frame(spark, [])).collect() == []
    rows = [(None, "é" * 150, "en", "s", 0), (None, "x" + "é" * 150, "en", "s", 0), (1, "ab" + "é" * 99 + "z", "en", "s", 0)]
    got = repeated_spans(frame(spark, rows), whole_characters=True, carry=("lang", "id")).collect()
    assert got[0].asDict().keys() == {"doc_id", "lang", "id", "n_bytes", "kept", "spans"}
    assert sorted(bytes(r["kept"]).decode() for r in got) == sorted(["", "x", "ab" + "é" * 99 + "z"])


def test_texts_travel_compressed(spark, monkeypatch):
    """Texts come back in the same chunks as before, null as empty, and no exchange has a plain one."""
    column = pa.array(["", None, "é" * 700, "plain " * 100, "x", None, "yz"])
    small, sizes = texts.compressed(column)
    assert sizes.to_pylist() == [0, 0, 1400, 600, 1, 0, 2] and sum(len(s) for s in small.to_pylist()) < 200
    for size in (1, 3, 1000, 5000):
        plain, back = list(texts.chunks(column, size)), list(texts.restored(small, sizes, size))
        assert [(a, b, bytes(raw), offsets.tolist()) for a, b, raw, offsets in plain] == [(a, b, bytes(raw), offsets.tolist()) for a, b, raw, offsets in back]
    carried = []
    monkeypatch.setattr(corpus_pipeline, "repeated_spans", lambda *a, **b: (carried.extend(b["carry"]), repeated_spans(*a, **b))[1])
    rows = [(1, "ab" * 150, "en", "s", 0), (2, "ab" * 150, "en", "s", 0), (3, None, "en", "s", 0), (4, "", "en", "s", 0), (5, "c" * 30, "en", "s", 0)]
    out = corpus_pipeline.cut_repeats(spark, frame(spark, rows), "")
    assert "text" not in carried
    assert sorted((r["doc_id"], r["text"], r["n_chars"]) for r in out.where("text is not null").collect()) == [(1, "", 0), (2, "", 0), (4, "", 0), (5, "c" * 30, 30)]
    assert [tuple(r) for r in out.where("text is null").select("doc_id", "lang", "source").collect()] == [(3, "en", "s")]


def test_grams_whose_contexts_all_recur(spark):
    """Contexts that occur again are not compared; one that does not still finds its repeat among them."""
    rng = np.random.default_rng(5)
    one, other, side = ("".join(chr(c) for c in rng.integers(97, 123, n)) for n in (700, 700, 300))
    rows = [(1, one, None, None, 0), (2, one, None, None, 0), (3, other, None, None, 0), (4, other, None, None, 0),
            (5, side + other[200:450], None, None, 0), (6, side[:100] + one[600:], None, None, 0)]
    for group in (1, 20_000):
        got = repeated_spans(frame(spark, rows), group_rows=group).collect()
        assert sorted(((r["doc_id"], r["n_bytes"], bytes(r["kept"]), tuple((s["start"], s["end"]) for s in r["spans"])) for r in got), key=str) == cut(rows, 200)


def test_contexts_of_a_gram_stay_together(spark):
    """With crowded grams in the table, all contexts of any other gram still meet in one task, also where Spark turns joins
    into broadcasts while it runs."""
    rng = np.random.default_rng(6)
    def some(n):
        return "".join(chr(c) for c in rng.integers(97, 123, n))

    passage = some(260)
    rows = [(i, some(90) + passage + some(90), None, None, 0) for i in range(9)]
    for i in range(40):
        both = some(230)
        rows += [(1000 + i, some(120) + both + some(80), None, None, 0), (2000 + i, some(60) + both + some(150), None, None, 0)]
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
                "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "4k"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = repeated_spans(frame(spark, rows).repartition(8), group_rows=4).collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sorted(((r["doc_id"], r["n_bytes"], bytes(r["kept"]), tuple((s["start"], s["end"]) for s in r["spans"])) for r in got), key=str) == cut(rows, 200)


def test_what_a_worker_holds(spark, monkeypatch):
    """Tables for short chunks are short, and the pipeline's stages send Python small batches, but do not raise a smaller setting."""
    monkeypatch.setattr(texts, "_POWERS", {})
    texts.prefix_hash(np.zeros(texts.SMALL_CHUNK, np.uint8))
    assert sum(p.nbytes for p in texts._POWERS.values()) <= 4 << 20
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for was, then in (("10000", 2000), ("0", 2000), ("500", 500)):
            spark.conf.set(key, was)
            out = corpus_pipeline.tokenise(spark, frame(spark, documents()), "")
            assert int(spark.conf.get(key)) == then and out.count() == len(documents())
    finally:
        spark.conf.set(key, before)


def test_interval_tree():
    text = "mississippi$banana"
    sa = sorted(range(len(text)), key=lambda i: text[i:])
    lcp = [next(k for k in range(len(text) + 1) if text[a + k:a + k + 1] != text[b + k:b + k + 1] or not text[a + k:a + k + 1]) for a, b in zip(sa, sa[1:], strict=False)]
    found = {(text[sa[a]:sa[a] + n], b - a + 1) for a, b, n in common_prefix_intervals(lcp)}
    assert ("issi", 2) in found and ("ana", 2) in found and ("a", 3) in found
    assert all(sum(text.startswith(s, i) for i in range(len(text))) == n for s, n in found)


def test_fingerprints(spark):
    rows = documents()
    got = {r["doc_id"]: r for r in fingerprints.edited_fingerprints(frame(spark)).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    errors = []
    for n, r in enumerate(order):
        text, after = r[1] or "", order[(n + 1) % len(order)][1] or ""
        third = len(text) // 3
        edited = text[:len(text) - third] + after[:third]
        one = got[r[0]]
        assert (one["n_chars"], one["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= one["near_next"] <= 1
        bags = [Counter(w for w in re.split(r"[ \t\n\x0b\x0c\r]+", t.lower()) if w) for t in (text, edited)]
        total = sum((bags[0] | bags[1]).values())
        errors.append(one["near_edited"] - (sum((bags[0] & bags[1]).values()) / total if total else 1))
        if text == edited:
            assert one["fingerprint"] == one["edited_fingerprint"] and one["near_edited"] == 1
    assert abs(np.mean(errors)) < 0.05 and np.std(errors) < 0.15
    same = {}
    for r in rows:
        assert same.setdefault(r[1] or "", got[r[0]]["fingerprint"]) == got[r[0]]["fingerprint"]
    assert got[[r[0] for r in rows if r[1] is None][0]]["fingerprint"] == fingerprints.EMPTY * fingerprints.SAMPLES
    assert fingerprints.edited_fingerprints(frame(spark, [])).collect() == []


def test_fingerprints_of_repeated_and_null_ids(spark):
    texts_ = {(1, "one two three four"): 2, (1, "five six seven"): 1, (2 ** 62, "eight nine"): 1, (-2 ** 62, "one two three four"): 1,
              (None, "ten eleven twelve"): 3, (None, None): 2, (None, "thirteen"): 1, (-2 ** 62, ""): 1}
    rows = [(*k, "", "", 0) for k, n in texts_.items() for _ in range(n)]
    got = fingerprints.edited_fingerprints(frame(spark, rows)).collect()
    plain = {(i, t or ""): n for (i, t), n in texts_.items()}
    ids = sorted({i for i, _ in plain if i is not None}, reverse=True) + [None]

    def edited(text, after):
        third = len(text) // 3
        return hashlib.sha256((text[:len(text) - third] + after[:third]).encode()).hexdigest()

    left = Counter({(i, len(t)): n for (i, t), n in plain.items()})
    prints = {}
    for r in got:
        left[r["doc_id"], r["n_chars"]] -= 1
        text, = [t for i, t in plain if i == r["doc_id"] and len(t) == r["n_chars"]]
        # The next text has the same id, or the next one.
        following = {r["doc_id"], ids[(ids.index(r["doc_id"]) + 1) % len(ids)]}
        assert r["edited_sha256"] in {edited(text, t) for i, t in plain if i in following and (i, t) != (r["doc_id"], text)}
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"] and 0 <= r["near_next"] <= 1
    assert not any(left.values()) and len(got) == len(rows)
    # Of one document alone the next is itself.
    alone = fingerprints.edited_fingerprints(frame(spark, rows[:2])).collect()
    assert [(r["doc_id"], r["near_next"], r["edited_sha256"]) for r in alone] == [(1, 1.0, edited(rows[0][1], rows[0][1]))] * 2


def test_mixing(spark):
    rows = [(i, "w " * (i % 23), None, [None, "a", "b", "é", "z"][i % 5] if i % 3 else "a", 0) for i in range(3000)] + [(1, "w", None, "a", 0)] * 2
    one, two = ({tuple(r) for r in mixing.mix(frame(spark, rows), part_rows=p).collect()} for p in (100, 100))
    assert one == two and len(one) >= 3000
    got = mixing.mix(frame(spark, rows), part_rows=100)
    size, total = Counter(), 0
    for r in rows:
        size[r[3]] += len((r[1] or "").split())
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, left, open_ = {}, sum(size.values()), set(order)
    while True:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 3 * size[s]}
        if not full:
            break
        for s in full:
            target[s] = 3 * size[s]
            left -= target[s]
        open_ -= full
    target |= {s: weight[s] * level for s in open_}
    taken, by_id = Counter(), {r[0]: r[3] for r in rows}
    for r in got.collect():
        assert r["target"] == pytest.approx(target[by_id[r["doc_id"]]]) and r["source_size"] == size[by_id[r["doc_id"]]]
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        taken[by_id[r["doc_id"]]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 30 for s in order) and sum(taken.values()) <= sum(size.values())
    assert mixing.mix(frame(spark, [])).collect() == []
    assert [r["taken"] for r in mixing.mix(frame(spark, [(1, None, None, None, 0), (2, " ", None, "a", 0)])).collect()] == [0, 0]


def test_statistics_of_odd_texts():
    for text in ["", " ", "a", "\n\n", "a\n\nb", "é" * 5, "A B !! $$", "x " * 50]:
        raw = np.frombuffer(text.encode(), np.uint8)
        alone = quality.statistics(raw, np.array([0, len(raw)]))
        assert alone.shape == (1, len(quality.STATISTICS)) and np.isfinite(alone).all()
        both = quality.statistics(np.concatenate([raw, raw]), np.array([0, len(raw), len(raw), 2 * len(raw)]))
        assert np.allclose(both[[0, 2]], alone) and np.isfinite(both).all()
    assert quality.statistics(np.zeros(0, np.uint8), np.zeros(1, np.int64)).shape == (0, len(quality.STATISTICS))


def test_quality_held_out(spark, tables):
    docs = spark.read.parquet(f"{tables.replace('0.001', '0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{tables.replace('0.001', '0.01')}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = quality.fit(docs, labels.where(~held))
    scored = docs.join(labels.where(held), "doc_id").select("quality", quality.score(model, F.col("text")).alias("p")).toPandas()
    assert ((scored.p >= 0.5) == (scored.quality == 1)).mean() > 0.95
    mine = quality.fit(frame(spark), frame(spark).selectExpr("doc_id", "cast(doc_id % 2 as int) as quality"))
    got = frame(spark).select(quality.score(mine, F.col("text")).alias("p")).collect()
    assert len(got) == len(documents()) and all(0 <= r["p"] <= 1 for r in got)


def test_quality_without_classes(spark):
    docs = frame(spark)
    none = docs.selectExpr("doc_id", "cast(null as int) as quality")
    assert quality.fit(docs, none).constant == 0.5
    assert quality.fit(docs, docs.selectExpr("doc_id", "1 as quality")).constant == 1
    assert quality.fit(frame(spark, []), none).constant == 0.5


def test_bpe_equals_the_library(spark):
    library = Tokenizer.from_file(BYTE)
    rows = documents() + [(None, "日本語 🙂 é́x\x1c\x85", None, None, 0)] * 2
    got = bpe.decode(bpe.encode(frame(spark, rows), BYTE), BYTE).collect()
    want = sorted(((r[0], tuple(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows), key=str)
    assert sorted(((r["doc_id"], tuple(r["ids"])) for r in got), key=str) == want
    assert all(r["decoded"] == (r["text"] or "") for r in got)
    assert bpe.encode(frame(spark, []), BYTE).collect() == []
    odd = bpe.decode(spark.createDataFrame([(None,), ([],), ([0, None, -1, 99999, 255],)], "ids array<int>"), BYTE).collect()
    assert [r["decoded"] for r in odd][:2] == ["", ""]


def test_huffman_store(spark, tmp_path):
    library = Tokenizer.from_file(WORD)
    rows = documents()
    huffman.write(frame(spark), WORD, str(tmp_path / "a"), end_id=1, block_ids=500)
    got = {r["doc_id"]: tuple(r)[1:] for r in huffman.read(spark, str(tmp_path / "a")).collect()}
    start = 0
    for r in sorted(rows):
        ids = np.array([*library.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")
        assert got.pop(r[0]) == (start, len(ids), ids.tobytes())
        start += len(ids)
    assert not got
    huffman.write(frame(spark, []), WORD, str(tmp_path / "b"), end_id=1)
    assert huffman.read(spark, str(tmp_path / "b")).collect() == []
    huffman.write(frame(spark, [(None, None, "", "", 0), (None, "a", "", "", 0), (3, "a", "", "", 0), (3, "a", "", "", 0)]), WORD, str(tmp_path / "c"), end_id=1)
    assert [(r["doc_id"], r["start"], r["n_tokens"]) for r in huffman.read(spark, str(tmp_path / "c")).orderBy("start").collect()] == [(None, 0, 1), (None, 1, 2), (3, 3, 2), (3, 5, 2)]


def test_word_ids_equal_the_library(monkeypatch):
    """Odd blanks, marks, special tokens, scripts and a very long word, with a store that is begun anew in between."""
    rng = np.random.default_rng(4)
    library = Tokenizer.from_file(WORD)
    with open(WORD, encoding="utf-8") as file:
        content = file.read()
    monkeypatch.setattr(wordids, "KEPT_WORDS", 400)
    words = wordids.WordIds(content)
    letters = list("aAbÉé 's'T'll12٣ß日本語ΣσİI\u0301\u0345.,!?;:-_\t\n\x0b\x0c\r\x1c\x1f\x85\xa0\u2003\u200b\U0001f600") + ["<|endoftext|>", "<|startoftext|>", "<|", "The "]
    for _ in range(40):
        rows = ["".join(rng.choice(letters, rng.integers(0, 60))) for _ in range(50)] + ["", "x" * 5000 + ".", None]
        raw, offsets = texts.flat(pa.array(rows, pa.string()))
        ids, bounds = words.encode(raw, offsets)
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == [library.encode(r or "", add_special_tokens=False).ids for r in rows]


def test_word_ids_refuse_other_files():
    with open(BYTE, encoding="utf-8") as file, pytest.raises(ValueError, match="cut at blanks"):
        wordids.check(file.read())


def test_op10_query_columns(spark, tables):
    library, start = Tokenizer.from_file(WORD), 0
    got = {r["doc_id"]: r for r in queries.op10_huffman_ids(spark, tables).collect()}
    for r in spark.read.parquet(f"{tables}/documents.parquet").orderBy("doc_id").collect():
        ids = np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        assert (got[r["doc_id"]]["start"], got[r["doc_id"]]["n_tokens"], got[r["doc_id"]]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_copies_by_place_equal_the_mix(spark):
    """Also where a round ends among rows that are equal, and for null sources, ids and texts."""
    rows = [(i % 40, "w " * (i % 5), None, [None, "a", "b"][i % 3], 0) for i in range(400)] + [(None, "one two", None, "a", 0)] * 30 + [(None, None, None, None, 0)] * 9
    rows += [(900 + i, "word " * 40, None, "c", 0) for i in range(40)]
    df = frame(spark, rows)
    for seed in range(3):
        mixed = Counter()
        for r in mixing.mix(df.withColumn("all", F.struct("doc_id", "text", "source")), seed=seed, part_rows=50, carry="all").collect():
            mixed[tuple(r["all"])] += r["copies"]
        placed = mixing.with_copies(df, seed=seed, part_rows=50)
        assert placed.columns == [*df.columns, "copies"]
        got = Counter()
        for r in placed.collect():
            got[r["doc_id"], r["text"], r["source"]] += r["copies"]
        assert placed.count() == len(rows) and +got == +mixed and len(set(mixed.values())) > 3
    assert mixing.with_copies(frame(spark, [])).collect() == []
    assert [r["copies"] for r in mixing.with_copies(frame(spark, [(1, None, None, "a", 0)] * 2)).collect()] == [0, 0]


def test_bpe_of_long_unbroken_runs():
    library = Tokenizer.from_file(BYTE)
    with open(BYTE, encoding="utf-8") as file:
        vocabulary = bpe.Vocabulary.parse(file.read())
    rng = np.random.default_rng(6)
    for letters, n in (("etaoinshrdlu", 200_000), ("x", 100_000), ("ab", 50_001), ("é日ß", 20_000)):
        text = "".join(rng.choice(list(letters), n))
        start = time.perf_counter()
        ids = np.frombuffer(vocabulary.encode(text), np.uint32).tolist()
        assert time.perf_counter() - start < 20 and ids == library.encode(text, add_special_tokens=False).ids


def test_huffman_codes():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 40, 3000):
        counts = (rng.pareto(0.5, n) * 3 + 1).astype(np.int64)
        for limit in (12, 20):
            lengths = huffman.code_lengths(counts, limit)
            assert lengths.max() <= limit and (2.0 ** -lengths).sum() <= 1
            ids = rng.integers(0, n, 5000)
            bits, checkpoints = huffman.pack(ids, huffman.canonical(lengths), lengths)
            assert (huffman.unpack([bits], [checkpoints], [5000], huffman.decoding_table(lengths)) == ids).all()
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(5), 2)


def test_licences(spark):
    lines = ["Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
             "Intro. Released under the MIT License.\nAll rights reserved.", "Licensed under CC BY-NC 4.0.", "nothing", None, "", "All rights reserved. " * 5000]
    rows = [(i, t, "", "", 0) for i, t in enumerate(lines)] + [(None, lines[1], "", "", 0)] * 2
    got = {r["doc_id"]: r for r in licences.scan(frame(spark, rows)).collect()}
    assert [got[i]["licences"] for i in range(6)] == ["Apache-2.0", "MIT LicenseRef-all-rights-reserved", "CC-BY-NC-4.0", "", "", ""]
    assert got[6]["n_sentences"] == 5000 and got[None]["sentences"] == "MitRelease AllRights" and got[4]["unmatched"] == ""
    con = duckdb.connect()
    documents_ = frame(spark, rows, clash=False).toPandas()  # noqa: F841
    want = con.sql(f"SELECT * REPLACE (CAST(doc_id AS BIGINT) AS doc_id) FROM ({licences.SQL.replace('FROM documents', 'FROM documents_')})").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in licences.scan(frame(spark, rows)).collect())


MIT_TEXT = """The MIT License (MIT)

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS BE LIABLE."""
BSD_TEXT = """Copyright (c) 2020, Some One
All rights reserved.
Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
GPL_TEXT = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
APACHE_TEXT = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""


def test_wrapped_notices(spark):
    plain = [MIT_TEXT, BSD_TEXT, GPL_TEXT, APACHE_TEXT]
    marked = [re.sub("(?m)^", mark, t) for mark in (" * ", "// ", "# ", ";; ", "rem ") for t in plain]
    texts_ = plain + marked + [t.replace("\n", "\r\n") for t in plain]
    names = ["MIT", "BSD-3-Clause LicenseRef-all-rights-reserved", "GPL-2.0-or-later", "Apache-2.0"]
    got = {r["doc_id"]: r for r in licences.scan(frame(spark, [(i, t, "", "", 0) for i, t in enumerate(texts_)])).collect()}
    for i in range(len(texts_)):
        assert got[i]["licences"] == names[i % 4] and got[i]["unmatched"] == "", (i, got[i])
    assert got[0]["sentences"] == "MitTitle MitGrant MitKeep MitAsIs" and got[3]["n_sentences"] == 5
    assert licences.scan(frame(spark, [(1, "Released under\n\nthe MIT License", "", "", 0)])).first()["licences"] == ""
    own = licences.scan(frame(spark, [(0, "Under the\nISC licence", "", "", 0)]), sentences={"Isc": "under the isc licence"}, rules=[("ISC", ("Isc",))]).collect()
    assert [(r["licences"], r["sentences"]) for r in own] == [("ISC", "Isc")]


def test_fixity(spark):
    pages = spark.createDataFrame([(i, f"http://x/{i}", "<p>é" * (i % 40)) for i in range(3000)] + [(None, None, None)] * 2, "page_id long, url string, html string")
    archive = fixity.volumes(pages.selectExpr("*", "1 as volume", "2 as node"), rows=64).cache()
    assert archive.count() == 3002
    assert fixity.audit(fixity.leaves(archive), fixity.leaves(archive)).collect() == []
    rows = archive.where("volume >= 0").orderBy("volume", "offset").collect()
    ends = {}
    for r in rows:
        assert r["offset"] == ends.get(r["volume"], 0) and r["length"] == len(r["record"].encode())
        ends[r["volume"]] = r["offset"] + r["length"]
    spoilt = F.when(F.col("id").isin(5, 700), F.regexp_replace("record", "http", "HTTP")).otherwise(F.col("record"))
    replica = archive.where("id is null or id not in (64, 1999)").withColumn("record", spoilt)
    extra = spark.createDataFrame([(3, 10**9, 4, 77, "lost")], archive.schema)
    got = fixity.audit(fixity.leaves(archive), fixity.leaves(replica.unionByName(extra))).collect()
    assert sorted((r["id"], r["state"]) for r in got) == [(5, "altered"), (64, "missing"), (77, "extra"), (700, "altered"), (1999, "missing")]
    empty = fixity.leaves(archive.limit(0))
    assert fixity.audit(empty, empty).count() == 0
    assert fixity.audit(fixity.leaves(archive), empty).count() == 3002


def test_words_and_hashes():
    import pyarrow as pa

    column = pa.array(["a b", None, "", "  x\x0by ", "日本 a"])
    raw, offsets = texts.flat(column)
    starts, ends, at = texts.words(raw, offsets)
    assert np.diff(at).tolist() == [2, 0, 0, 2, 2]
    h = texts.span_hash(texts.prefix_hash(raw), starts, ends)
    assert h[0] == h[5] and len(set(h.tolist())) == 5
    assert [(a, b) for a, b, _, _ in texts.chunks(column, 3)] == [(0, 3), (3, 4), (4, 5)]
    assert zlib.crc32(b"") == 0
