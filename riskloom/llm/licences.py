"""Licences in texts by sentence rules.

A text is cut into sentences, each is normalised to lower-case words and digits, and a sentence
that is known becomes its identifier. A sentence may be wrapped: it can run over lines of a
paragraph, from the start of one line to the end of another, also in a comment block, and over
semicolons. The catalogue
below is small (29 sentences, 22 rules: no LGPL, AGPL, MPL, ISC or Unlicense); ``scan`` takes others. The identifiers in order are matched against the licence
rules, first rule first; identifiers that a rule has matched are used up, so a later rule for a
part of the same notice does not report it again.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterable, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Identifiers of licence sentences and their normalised words.
SENTENCES = {
    "ApacheNotice2": "licensed under the apache license version 2 0",
    "ApacheNoticeFile2": "licensed under the apache license version 2 0 the license",
    "ApacheComply": "you may not use this file except in compliance with the license",
    "ApacheCopy": "you may obtain a copy of the license at",
    "ApacheCopyUrl2": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "ApacheAsIs": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "ApacheSee": "see the license for the specific language governing permissions and limitations under the license",
    "MitRelease": "released under the mit license",
    "MitLicensed": "licensed under the mit license",
    "MitTitle": "the mit license mit",
    "MitGrant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "MitKeep": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "MitAsIs": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "GplWork3": "this work is licensed under the gnu general public license version 3",
    "GplWork2": "this work is licensed under the gnu general public license version 2",
    "GplFree3Plus": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "GplFree2Plus": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "GplHope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "GplDetails": "see the gnu general public license for more details",
    "BsdUse": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "BsdSource": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "BsdBinary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "BsdEndorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "CcBy4": "licensed under cc by 4 0",
    "CcBySa4": "licensed under cc by sa 4 0",
    "CcByNc4": "licensed under cc by nc 4 0",
    "CcByNcNd4": "licensed under cc by nc nd 4 0",
    "Cc0": "dedicated to the public domain under cc0 1 0",
    "AllRights": "all rights reserved",
}

# Licence rules in the order they are tried, each a sequence of sentence identifiers.
RULES = (
    ("Apache-2.0", ("ApacheNoticeFile2", "ApacheComply", "ApacheCopyUrl2", "ApacheAsIs", "ApacheSee")),
    ("Apache-2.0", ("ApacheNoticeFile2", "ApacheComply", "ApacheCopy", "ApacheAsIs", "ApacheSee")),
    ("Apache-2.0", ("ApacheNoticeFile2", "ApacheComply")),
    ("Apache-2.0", ("ApacheNotice2",)),
    ("MIT", ("MitTitle", "MitGrant", "MitKeep", "MitAsIs")),
    ("MIT", ("MitGrant", "MitKeep", "MitAsIs")),
    ("MIT", ("MitRelease",)),
    ("MIT", ("MitLicensed",)),
    ("GPL-3.0-or-later", ("GplFree3Plus", "GplHope", "GplDetails")),
    ("GPL-2.0-or-later", ("GplFree2Plus", "GplHope", "GplDetails")),
    ("GPL-3.0-or-later", ("GplFree3Plus",)),
    ("GPL-2.0-or-later", ("GplFree2Plus",)),
    ("GPL-3.0-only", ("GplWork3",)),
    ("GPL-2.0-only", ("GplWork2",)),
    ("BSD-3-Clause", ("BsdUse", "BsdSource", "BsdBinary", "BsdEndorse")),
    ("BSD-2-Clause", ("BsdUse", "BsdSource", "BsdBinary")),
    ("CC-BY-NC-ND-4.0", ("CcByNcNd4",)),
    ("CC-BY-NC-4.0", ("CcByNc4",)),
    ("CC-BY-SA-4.0", ("CcBySa4",)),
    ("CC-BY-4.0", ("CcBy4",)),
    ("CC0-1.0", ("Cc0",)),
    ("LicenseRef-all-rights-reserved", ("AllRights",)),
)

NOT_WORD = "[^a-z0-9]+"

_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
_NOT_WORD = re.compile(NOT_WORD)
#: Comment marks before a line that would count as the end of a sentence or as words.
_LEADER = re.compile(r"(?:(?<=[\r\n])|\A)[ \t]*(?:;+|dnl|rem)[ \t]+")
#: Where a sentence certainly ends: a mark followed by a blank.
_MARK = re.compile(r"[.!?][ \t\r\n]+")
#: Where it may end or go on: a line end or semicolon.
_LINE = re.compile(r"(?:;[ \t]*)?(?:\r\n|\r|\n)|;[ \t]+")


def starts_of(sentences: Mapping[str, str]) -> frozenset[str]:
    """Every run of words that a known sentence starts with."""
    out = set()
    for known in sentences.values():
        listed = known.split()
        out.update(" ".join(listed[:n + 1]) for n in range(len(listed)))
    return frozenset(out)


def recognised(text: str, names: Mapping[str, str], starts: frozenset[str]) -> list[str]:
    """The identifiers of the known sentences of a text, in order; ``names`` has them by their words.

    From each line on, the longest known sentence made of whole lines counts. A line without words
    ends a paragraph, and no sentence goes on beyond it."""
    out = []
    for piece in _MARK.split(_LEADER.sub("", text.translate(_LOWER))):
        lines = [_NOT_WORD.sub(" ", line).strip(" ") for line in _LINE.split(piece)]
        i = 0
        while i < len(lines):
            run, best, after = lines[i], None, i + 1
            j = i + 1
            while run in starts:
                if run in names:
                    best, after = names[run], j
                if j == len(lines) or not lines[j]:
                    break
                run += " " + lines[j]
                j += 1
            if best is not None:
                out.append(best)
            i = after
    return out


def scan(docs: DataFrame, text: str = "text", key: str = "doc_id", sentences: Mapping[str, str] = SENTENCES,
         rules: Iterable[tuple[str, tuple[str, ...]]] = RULES) -> DataFrame:
    """``key``, n_sentences, sentences, licences, unmatched of every row.

    ``sentences`` are the identifiers found, in order; ``licences`` the rules' names that match, in
    the order of the rules, each once; ``unmatched`` the identifiers no rule used; all joined by
    blanks. Null and empty texts have none of them (empty strings, 0). Rows are independent:
    repeated rows and null keys stay as they are, long texts are scanned whole, an empty table gives an empty one, other columns are
    not read. Nothing is shuffled. The arguments ``sentences`` (identifier to words, lower-case words and
    digits with single blanks) and ``rules`` (licence, identifiers) stand for the catalogue; identifiers are
    without blanks and angle brackets.
    """
    ids = _sentences(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), dict(sentences))
    found = docs.select(F.col(f"`{key}`").alias(key), ids.alias("sentences"))
    count = F.when(F.col("sentences") == "", 0).otherwise(F.size(F.split("sentences", " "))).cast("long")
    found = found.select(key, count.alias("n_sentences"), "sentences")
    return found.withColumn("match", _rules(F.col("sentences"), tuple(rules))).select(key, "n_sentences", "sentences", "match.licences", "match.unmatched")


def _sentences(text: Column, sentences: dict[str, str]) -> Column:
    names, starts = {words: name for name, words in sentences.items()}, starts_of(sentences)

    @F.arrow_udf("string")
    def find(column: pa.Array) -> pa.Array:
        return pa.array([" ".join(recognised(t.as_py(), names, starts)) for t in column], pa.string())

    return find(text)


def match_rules(sentences: str, rules: Iterable[tuple[str, tuple[str, ...]]] = RULES) -> tuple[str, str]:
    """(licences, identifiers left over) of identifiers joined by blanks."""
    rest, names = "".join(f"<{s}>" for s in sentences.split()), []
    for name, sequence in rules:
        pattern = "".join(f"<{s}>" for s in sequence)
        if pattern in rest:
            rest = rest.replace(pattern, "#")
            if name not in names:
                names.append(name)
    order = list(dict.fromkeys(name for name, _ in rules))
    return " ".join(sorted(names, key=order.index)), " ".join(rest.replace("#", " ").replace("<", " ").replace(">", " ").split())


def _rules(sentences: Column, rules: tuple[tuple[str, tuple[str, ...]], ...]) -> Column:
    @F.arrow_udf("struct<licences: string, unmatched: string>")
    def match(column: pa.Array) -> pa.Array:
        coded = column.dictionary_encode()  # few different sequences in many rows
        each = [match_rules(s, rules) for s in coded.dictionary.to_pylist()]
        parts = [pa.array([e[i] for e in each], pa.string()).take(coded.indices) for i in (0, 1)]
        return pa.StructArray.from_arrays(parts, names=["licences", "unmatched"])

    return match(sentences)


def _sql() -> str:
    """The same in SQL."""
    names = ", ".join(f"'{words}': '{name}'" for name, words in SENTENCES.items())
    rest, steps, hits = "r0", [], {}
    for i, (name, sequence) in enumerate(RULES):
        pattern = "".join(f"<{s}>" for s in sequence)
        hits.setdefault(name, []).append(f"contains(r{i}, '{pattern}')")
        steps.append(f"s{i + 1} AS MATERIALIZED (SELECT *, replace(r{i}, '{pattern}', '#') AS r{i + 1} FROM s{i})")
        rest = f"r{i + 1}"
    listed = ", ".join(f"CASE WHEN {' OR '.join(h)} THEN '{n}' END" for n, h in hits.items())
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    return f"""
WITH known AS (SELECT MAP {{{names}}} AS k),
parts AS (
  SELECT doc_id, string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.!?;][ \\t\\r\\n]+|[\\r\\n]+') AS p FROM documents),
ids AS (
  SELECT doc_id, list_filter(list_transform(p, lambda s: k[trim(regexp_replace(s, '{NOT_WORD}', ' ', 'g'))]), lambda n: n IS NOT NULL) AS ids
  FROM parts, known),
s0 AS MATERIALIZED (SELECT doc_id, ids, '<' || array_to_string(ids, '><') || '>' AS r0 FROM ids),
{", ".join(steps)}
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_sentences, coalesce(array_to_string(ids, ' '), '') AS sentences,
  CASE WHEN len(ids) > 0 THEN concat_ws(' ', {listed}) ELSE '' END AS licences,
  CASE WHEN len(ids) > 0 THEN trim(regexp_replace({rest}, '[<>#]+', ' ', 'g')) ELSE '' END AS unmatched
FROM s{len(RULES)}"""


SQL = _sql()
