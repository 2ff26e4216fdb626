"""Licenses in texts: an exact set-similarity join of their blocks of words with notices."""

from array import array
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsalpha.llm.common import columns_added

# Phrases that name a license wherever their words stand one behind the other, with their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Wordings of public licenses and of the usual notices of them, with their labels.
NOTICES = (
    ("Released under the MIT License", "mit"),
    ("Licensed under the MIT License", "mit"),
    ("SPDX-License-Identifier: MIT", "mit"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"
     " files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy,"
     " modify, merge, publish, distribute, sublicense, and/or sell copies of the Software", "mit"),
    ("Licensed under the Apache License, Version 2.0", "apache-2.0"),
    ("SPDX-License-Identifier: Apache-2.0", "apache-2.0"),
    ("you may not use this file except in compliance with the License. You may obtain a copy of the License at"
     " http://www.apache.org/licenses/LICENSE-2.0", "apache-2.0"),
    ("licensed under the GNU General Public License, version 2", "gpl-2.0"),
    ("licensed under the GNU General Public License, version 3", "gpl-3.0"),
    ("SPDX-License-Identifier: GPL-2.0", "gpl-2.0"),
    ("SPDX-License-Identifier: GPL-3.0", "gpl-3.0"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as"
     " published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version", "gpl-3.0-or-later"),
    ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of"
     " MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details", "gpl"),
    ("GNU Lesser General Public License", "lgpl"),
    ("GNU Affero General Public License", "agpl"),
    ("Licensed under CC BY 4.0", "cc-by-4.0"),
    ("Licensed under CC BY-SA 4.0", "cc-by-sa-4.0"),
    ("Licensed under CC BY-NC 4.0", "cc-by-nc-4.0"),
    ("Licensed under CC BY-ND 4.0", "cc-by-nd-4.0"),
    ("Licensed under CC BY-NC-SA 4.0", "cc-by-nc-sa-4.0"),
    ("licensed under a Creative Commons Attribution 4.0 International License", "cc-by-4.0"),
    ("licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa-4.0"),
    ("licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "cc-by-nc-4.0"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "mpl-2.0"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following"
     " conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the"
     " following disclaimer", "bsd"),
    ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived"
     " from this software without specific prior written permission", "bsd-3-clause"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,"
     " provided that the above copyright notice and this permission notice appear in all copies", "isc"),
    ("This is free and unencumbered software released into the public domain", "unlicense"),
    ("Distributed under the Boost Software License, Version 1.0", "bsl-1.0"),
    ("all rights reserved. no part of this publication may be reproduced, distributed, or transmitted in any form or by any means", "all-rights-reserved"),
)

# Bytes that are split into words at once; words are never cut.
PART = 1 << 20
# ASCII letters are lowered, digits and all bytes of other characters stay, all else becomes a space.
_plain = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> Iterator[list[bytes]]:
    """Words of a text, by parts."""
    raw = (text or "").encode().translate(_plain)
    at = 0
    while at < len(raw):
        cut = raw.find(b" ", min(len(raw), at + PART))
        end = len(raw) if cut < 0 else cut
        yield raw[at:end].split()
        at = end


def width(words: int) -> int:
    """Words by which the blocks for a notice of ``words`` words move on; a block is twice as long.

    So each run of words as long as the notice lies in one block as a whole.
    """
    return 1 << max(0, words - 1).bit_length()


class Notice(NamedTuple):
    """A notice: the ranks of its distinct words, rarest first, and how many of them a block must have."""

    label: str
    width: int
    ranks: np.ndarray
    least: int


def parsed(text: str) -> list[bytes]:
    return [word for part in words_of(text) for word in part]


def vocabulary(notices: Sequence[tuple[str, str]], phrases: Sequence[tuple[str, str]]) -> list[bytes]:
    """Distinct words of all notices and phrases."""
    return sorted({word for text, _ in (*notices, *phrases) for word in parsed(text)})


def ranked(text: str | None, rank: dict[bytes, int]) -> np.ndarray:
    """Ranks of the words of a whole text, -1 for words without one: four bytes a word."""
    made = array("i")
    for part in words_of(text):
        made.extend([rank.get(word, -1) for word in part])
    return np.frombuffer(made, dtype=np.int32) if made else np.empty(0, dtype=np.int32)


class Index:
    """Prefixes of notices and phrases: words in the order of their frequency in the whole corpus, rarest first.

    A block that has ``least`` of the words of a notice has one of its ``size - least + 1`` rarest; a phrase must be there
    as a whole, so its rarest word is its prefix. Other words need not be looked up.
    """

    def __init__(self, notices: Sequence[tuple[str, str]], phrases: Sequence[tuple[str, str]], counts: dict[bytes, int], percent: int):
        self.rank = {word: i for i, word in enumerate(sorted(counts, key=lambda w: (counts[w], w)))}
        # One place more, for words without a rank.
        self.prefix = np.zeros(len(self.rank) + 1, dtype=bool)
        self.notices, self.phrases = [], []
        for text, label in notices:
            words = parsed(text)
            ranks = np.array(sorted({self.rank[w] for w in words}), dtype=np.int32)
            least = -(-percent * len(ranks) // 100)
            self.prefix[ranks[: len(ranks) - least + 1]] = True
            self.notices.append(Notice(label, width(len(words)), ranks, least))
        for text, label in phrases:
            ranks = np.array([self.rank[w] for w in parsed(text)], dtype=np.int32)
            self.prefix[ranks.min()] = True
            self.phrases.append((label, ranks, int(ranks.argmin())))

    def scan(self, text: str | None) -> dict:
        """Number of words, places of phrases and blocks of notices of a whole text."""
        words = ranked(text, self.rank)
        hits = np.flatnonzero(self.prefix[words])
        found: dict = {"n_words": len(words), "phrases": [], "notices": []}
        if len(hits):
            of = words[hits]
            for label, ranks, anchor in self.phrases:
                starts = hits[of == ranks[anchor]] - anchor
                for start in starts[(starts >= 0) & (starts + len(ranks) <= len(words))].tolist():
                    if (words[start : start + len(ranks)] == ranks).all():
                        found["phrases"].append({"label": label, "start": start})
            for notice in self.notices:
                found["notices"] += self._blocks(notice, words, hits, of)
        return found

    def _blocks(self, notice: Notice, words: np.ndarray, hits: np.ndarray, of: np.ndarray) -> list[dict]:
        """Blocks that have enough of the notice's words, among those that have a word of its prefix."""
        size, made = len(notice.ranks), []
        near = hits[np.isin(of, notice.ranks[: size - notice.least + 1])] // notice.width
        for k in np.unique(np.concatenate([near, near - 1])).tolist():
            if k < 0:
                continue
            start, end = k * notice.width, min(len(words), (k + 2) * notice.width)
            block = np.unique(words[start:end])
            block = block[np.searchsorted(block, 0) :]
            # By length, and by the place of the first common word on both sides, too few others may be left.
            if len(block) < notice.least:
                continue
            common = np.flatnonzero(np.isin(notice.ranks[: size - notice.least + 1], block))
            if not len(common) or min(size - common[0], len(block) - np.searchsorted(block, notice.ranks[common[0]])) < notice.least:
                continue
            shared = int(np.isin(notice.ranks, block).sum())
            if shared >= notice.least:
                made.append({"label": notice.label, "start": start, "end": end, "share": shared / size})
        return made


def frequencies(df: DataFrame, words: list[bytes], text_column: str = "text") -> dict[bytes, int]:
    """How often some words stand in all texts. Each task sends one count per word."""
    rank = {word: i for i, word in enumerate(words)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(len(words) + 1, dtype=np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                totals += np.bincount(ranked(text, rank) + 1, minlength=len(totals))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(words)), pa.int32()), pa.array(totals[1:])], names=["word", "n"])

    counted = df.select(F.col(text_column).alias("text")).mapInArrow(count, "word int, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {words[row["word"]]: row["n"] for row in counted.collect()}
    return {word: found.get(word, 0) for word in words}


PLACE = "struct<label: string, start: long>"
BLOCK = "struct<label: string, start: long, end: long, share: double>"


def licenses(
    df: DataFrame, notices: Sequence[tuple[str, str]] = NOTICES, phrases: Sequence[tuple[str, str]] = PHRASES, percent: int = 90,
    text_column: str = "text", keep: list[str] | None = None,
) -> DataFrame:
    """Phrases and notices of licenses in every whole text.

    Words are runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z lowered. A phrase is found
    wherever its words stand one behind the other. A notice is found in a block if the block has ``percent`` per
    cent of its distinct words. The blocks for a notice are twice as long as a power of two that is no less than its
    words, and overlap by half, so any run of words as long as the notice lies in one of them. The join is exact: words are
    ordered by their frequency in all texts, rarest first; only blocks with a word of a notice's prefix are met, and
    length and place of the first common word bound the overlap before it is counted.

    The notices and phrases are parameters of a few kilobytes and go into the task closure with their words' ranks.
    Texts are read twice and never shuffled: once for the frequencies, once for the join. Memory is four bytes a word of a
    text besides the text itself.

    Null and empty texts have no words and nothing is found. Repeated rows give repeated rows. Returns the columns in
    ``keep`` (all by default) and ``n_words, phrases`` (label, start) and ``notices`` (label, start, end of the block, share of the
    notice), all in words from 0, ends exclusive; input columns of these three names are replaced.
    """
    counts = frequencies(df, vocabulary(notices, phrases), text_column)
    index = Index(notices, phrases, counts, percent)

    def work(texts: list) -> dict[str, list]:
        found = [index.scan(text) for text in texts]
        return {name: [f[name] for f in found] for name in ("n_words", "phrases", "notices")}

    return columns_added(df, text_column, work, f"n_words long, phrases array<{PLACE}>, notices array<{BLOCK}>", keep)


def summary(found: DataFrame) -> DataFrame:
    """Counts, labels and a score of the results of ``licenses``: the largest share of a notice, 1 with a phrase, else 0."""
    starts = F.transform("phrases", lambda p: p["start"])
    listed = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    base, more = F.transform("phrases", lambda p: p["label"]), F.transform("notices", lambda b: b["label"])
    shares = F.transform("notices", lambda b: b["share"])
    return found.withColumns({
        "n_base": F.size("phrases").cast("long"), "first_word": F.array_min(starts), "last_word": F.array_max(starts),
        "base_labels": listed(base), "labels": listed(F.concat(base, more)),
        "score": F.when(F.size("phrases") > 0, 1.0).otherwise(F.coalesce(F.array_max(shares), F.lit(0.0))),
    }).drop("phrases", "notices")
