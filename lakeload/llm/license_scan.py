"""License scans: phrases at word level, and an exact set-similarity join of text blocks with templates.

A block is any run of words twice as long as the template, wherever lines end. A template matches a block that
contains at least ``threshold`` of the template's distinct words, and in which the template's telling words stand (those that its kin among the licences
lack), as a pattern over consecutive words. All words that occur in templates are ordered by the number of documents holding
them, counted over the whole table. With overlap ``need = ceil(threshold * |template|)``:

* prefix filter: one of the first ``|template| - need + 1`` words of the template is in the block;
* length filter: the block has at least ``need`` distinct words;
* positional filter: from the first common word on, enough words are left on both sides.

The filters run on the words of the whole document first, which hold those of every block; templates that pass are
counted exactly in all blocks by one pass over the places of their words. Templates are a fixed list, so they travel with the function; documents are
read twice (counts, scan) and never shuffled.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases whose words stand consecutively, and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
_GPL = r"gnu (?:general public license|gpl)|gpl"
# The first version named after the licence is 3, or 3 beside 2.
_GPL_3 = (r"gnu (?:general public license|gpl) (?:(?:(?!version |v\d)\S+ ){0,8}?(?:(?:version |v)2 or )?(?:version |v)3"
          r"|(?:2 or )?3)")
_MIT_GRANT = r"any person obtaining a copy of this software"
_BSD = r"(?:redistribution|use) (?:\S+ ){0,14}?(?<!not )permitted"
_APACHE_2 = r"apache (?:software )?license (?:(?!version |v?\d)\S+ ){0,2}?(?:version |v)?2|apache (?:version |v)?2 (?:0 )?license"
_MPL_2 = r"mozilla public license(?! (?:version |v )?1 )"
_ISC = r"distribute this software for any purpose"
# Label, notice by which a licence is declared, and the pattern of words that tell it from its kin. The
# pattern must stand in every block that matches. First short declarations, then whole notices.
NOTICES = (
    ("mit", "released under the mit license", r"mit (?:\S+ ){0,2}?license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", _MIT_GRANT),
    ("apache-2", "licensed under the apache license version 2 0", _APACHE_2),
    ("cc-by-nc", "licensed under cc by nc 4 0", r"cc (?:\S+ ){0,2}?nc"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3", _GPL_3),
    ("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license", _GPL),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", _BSD),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license", _MPL_2),
    ("isc", "permission to use copy modify and or distribute this software for any purpose is hereby granted", _ISC),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction including without limitation the "
     "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
     "persons to whom the software is furnished to do so subject to the following conditions the above copyright notice "
     "and this permission notice shall be included in all copies or substantial portions of the software the software is "
     "provided as is without warranty of any kind express or implied including but not limited to the warranties of "
     "merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright "
     "holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise "
     "arising from out of or in connection with the software or the use or other dealings in the software",
     _MIT_GRANT + r"|sublicense and or sell"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
     "with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required "
     "by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
     "without warranties or conditions of any kind either express or implied see the license for the specific language "
     "governing permissions and limitations under the license", _APACHE_2 + r"|apache org licenses license 2"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
     r"attribution non ?commercial"),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation either version 3 of the license or at your option any "
     "later version this program is distributed in the hope that it will be useful but without any warranty without even "
     "the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for "
     "more details", _GPL_3),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met redistributions of source code must retain the above copyright notice this list of "
     "conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice "
     "this list of conditions and the following disclaimer in the documentation and or other materials provided with the "
     "distribution", _BSD + r"|redistributions in binary form must reproduce"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was "
     "not distributed with this file you can obtain one at http mozilla org mpl 2 0", _MPL_2 + r"|mozilla org mpl 2"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
     "granted provided that the above copyright notice and this permission notice appear in all copies the software is "
     "provided as is and the author disclaims all warranties with regard to this software including all implied "
     "warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or "
     "consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of "
     "contract negligence or other tortious action arising out of or in connection with the use or performance of this "
     "software", _ISC),
)
TEMPLATES = tuple((label, text) for label, text, _ in NOTICES)
TELLING = {text: pattern for _, text, pattern in NOTICES}
# Bytes that separate words: every ASCII character but digits and (lower-cased) letters.
_SEPARATE = bytes(b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(_SEPARATE).split()


def phrase_places(words: list[bytes], phrases: dict[str, str]) -> list[tuple[int, str]]:
    """(first word, label) of all places where a phrase stands, overlapping ones included."""
    joined = b" " + b" ".join(words) + b" "
    found = []
    for phrase, label in phrases.items():
        wanted = b" " + phrase.encode() + b" "
        at, seen, counted = joined.find(wanted), 0, 0
        while at >= 0:
            counted += joined.count(b" ", seen, at)
            seen = at
            found.append((counted, label))
            at = joined.find(wanted, at + 1)
    return found


def telling_places(pattern: re.Pattern, joined: bytes) -> list[tuple[int, int]]:
    """(first word, last word) of all places of a pattern in words joined by blanks, with one before and after."""
    found, seen, first = [], 0, -1
    for m in pattern.finditer(joined):
        first += joined.count(b" ", seen, m.start())
        seen = m.start()
        found.append((first, first + m.group().count(b" ")))
    return found


class TemplateIndex:
    """Prefix index over the templates for one global order of words."""

    def __init__(self, templates, counts: dict[str, int], threshold: float, telling: dict[str, str] | None = None):
        vocabulary = sorted({w for _, text in templates for w in text.split()}, key=lambda w: (counts.get(w, 0), w))
        self.rank = {w.encode(): i for i, w in enumerate(vocabulary)}
        self.templates, self.widths, self.telling, self.prefix = [], [], [], {}
        for label, text in templates:
            ranks = sorted({self.rank[w.encode()] for w in text.split()})
            need = max(1, math.ceil(Fraction(str(threshold)) * len(ranks)))
            for place, word in enumerate(ranks[: len(ranks) - need + 1]):
                self.prefix.setdefault(word, []).append((len(self.templates), place))
            self.templates.append((label, frozenset(ranks), need, len(ranks)))
            self.widths.append(2 * len(text.split()))
            pattern = (telling or {}).get(text)
            self.telling.append(pattern and re.compile(rb"(?<= )(?:" + pattern.encode() + rb")(?= )"))
        self.rare = frozenset(w for w, i in self.rank.items() if i in self.prefix)

    def matches(self, words: list[bytes]) -> list[tuple[str, float]]:
        """(label, share of the template found) of all templates that the block contains."""
        return [(self.templates[n][0], overlap / self.templates[n][3]) for n, overlap in self._contained(words)]

    def matches_in_blocks(self, words: list[bytes]) -> list[tuple[str, float]]:
        """(label, largest share found) of all templates that some block of the text contains."""
        passed = self._contained(words)
        joined = b" " + b" ".join(words) + b" " if passed else b""
        known = [(at, self.rank[w]) for at, w in enumerate(words) if w in self.rank] if passed else []
        found = []
        for number, _ in passed:
            label, _, need, size = self.templates[number]
            told = self.telling[number] and telling_places(self.telling[number], joined)
            overlap = self._largest(number, known, told)
            if overlap >= need:
                found.append((label, overlap / size))
        return found

    def _largest(self, number: int, known: list[tuple[int, int]], told: list[tuple[int, int]] | None) -> int:
        """The most distinct words of a template that one block holds.

        ``known`` has (place, rank) in order. ``told`` has (first, last) place of the telling words in order, and
        only blocks with one of them whole count; None counts all.
        """
        _, ranks, _, size = self.templates[number]
        if told is not None and not told:
            return 0
        width, own = self.widths[number], [k for k in known if k[1] in ranks]
        # A block may end with a word of the template or with the last telling word.
        ends = sorted([(at, 0, rank) for at, rank in own] + [(last, 1, first) for first, last in told or ()])
        held: Counter = Counter()
        best = gone = 0
        newest = -1
        for at, kind, value in ends:
            if kind:
                newest = max(newest, value)
            else:
                held[value] += 1
            while gone < len(own) and own[gone][0] <= at - width:
                rank = own[gone][1]
                held[rank] -= 1
                if not held[rank]:
                    del held[rank]
                gone += 1
            if told is None or newest > at - width:
                best = max(best, len(held))
                if best == size:
                    break
        return best

    def _contained(self, words: list[bytes]) -> list[tuple[int, int]]:
        """(number, overlap) of all templates that the words contain."""
        distinct = set(words)
        block = sorted(self.rank[w] for w in distinct if w in self.rank)
        found, tried = [], set()
        for place, word in enumerate(block):
            for number, template_place in self.prefix.get(word, ()):
                if number in tried:
                    continue
                tried.add(number)
                _, ranks, need, size = self.templates[number]
                left = min(len(block) - place, size - template_place)
                if len(distinct) < need or left < need:
                    continue
                overlap = len(ranks.intersection(block))
                if overlap >= need:
                    found.append((number, overlap))
        return found


def template_word_counts(docs: DataFrame, templates=TEMPLATES, text: str = "text") -> dict[str, int]:
    """Documents holding each template word; as many rows as the templates have words."""
    vocabulary = frozenset(w.encode() for _, t in templates for w in t.split())

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for batch in batches:
            for body in batch["text"]:
                if body:
                    seen.update(vocabulary.intersection(words_of(body)))
        if seen:
            yield pd.DataFrame({"word": [w.decode() for w in seen], "n": list(seen.values())}, columns=["word", "n"])

    counted = docs.select(F.col(f"`{text}`").cast("binary").alias("text")).mapInPandas(count, "word string, n long")
    return {r["word"]: r["n"] for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def scan_licenses(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates=TEMPLATES, threshold: float = 0.8,
                  text: str = "text", telling: dict[str, str] = TELLING) -> DataFrame:
    """All documents with ``n_words, n_base, first_word, last_word, base_labels, labels, score``.

    Words are runs of characters other than ASCII ones that are neither letters nor digits, A-Z lower-cased.
    ``n_base`` counts the places of ``phrases``; ``first_word`` and ``last_word`` are their smallest and
    largest first word, null without any. ``labels`` adds the labels of matching templates. ``telling`` maps
    a template to the pattern that each of its blocks must hold; a template without one needs none. ``score`` is 1
    with a phrase, else the largest share of a matching template, else 0. Null and empty text have no
    words. Repeated rows stay, no rows give no rows.
    """
    index = TemplateIndex(templates, template_word_counts(docs, templates, text), threshold, telling)

    def scan(body: bytes | None) -> tuple:
        words = words_of(body) if body else []
        places = phrase_places(words, phrases)
        base = {label for _, label in places}
        labels, score = set(base), 1.0 if places else 0.0
        if not index.rare.isdisjoint(words):
            for label, share in index.matches_in_blocks(words):
                labels.add(label)
                score = max(score, share)
        starts = [at for at, _ in places]
        return (len(words), len(places), min(starts, default=None), max(starts, default=None),
                ",".join(sorted(base)), ",".join(sorted(labels)), score)

    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

    @F.pandas_udf("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")
    def scanned(bodies: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([scan(b) for b in bodies], columns=names, dtype=object)

    out = docs.withColumn("score", scanned(F.col(f"`{text}`").cast("binary")))
    return out.withColumns({name: F.col("score")[name] for name in names})
