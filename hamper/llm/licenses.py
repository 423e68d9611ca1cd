"""Licence scans with a positional rare-token index.

The index holds the words of licence templates with their positions. How rare a word is
(inverse document frequency) is counted over all files. Each template is entered under its
rarest words, so many that a file without any of them in place cannot hold the share of the
template asked for; for a file, its highest-IDF licence words are looked up first, each lookup
giving (template, position of the word in it). A word at place p of the file and place q of
a template proposes that the template starts at p - q; proposals are intersected by relative
position: the share of the template's words, weighted by IDF, that stand where that start
puts them. A proposal with enough of them counts if the template's mandatory key phrases
also stand near, word by word.

Base phrases are templates that need every word in place; since each is entered under its
rarest word, every place where it stands is found.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")  # of lower-cased UTF-8 bytes: any non-ASCII character is part of a word
MIN_COVERAGE = 0.6   # IDF share of a template that must stand in place
SLACK = 12           # words by which a key phrase may lie outside the aligned template

# Base phrases and their labels.
BASE = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]

# Wording of common licence notices, their labels and mandatory key phrases.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files to deal in the software without restriction", ["permission is hereby granted",
                                                                                "without restriction"]),
    ("apache-2", "licensed under the apache license version 2 0 you may not use this file except in compliance with the "
                 "license", ["apache license version 2"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation", ["gnu general public license"]),
    ("gpl", "this work is licensed under the gnu general public license version", ["gnu general public license"]),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
             "general public license", ["gnu lesser general public license"]),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ["mozilla public license v 2"]),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
     ["creative commons attribution noncommercial"]),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license",
     ["creative commons attribution sharealike"]),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
     ["creative commons attribution 4"]),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to "
            "this work", ["waived all copyright and related or neighboring rights"]),
]


def words_of(text: bytes) -> list[bytes]:
    return WORDS.findall(text.lower())  # bytes.lower changes A-Z alone


class Index:
    """Positional index of templates under their rarest words."""

    def __init__(self, base: list[tuple[str, str]], templates: list[tuple[str, str, list[str]]],
                 document_frequency: dict[bytes, int], n_docs: int):
        split = lambda s: s.encode().split()
        self.entries = [(label, split(p), [], True) for p, label in base]
        self.entries += [(label, split(t), [split(k) for k in keys], False) for label, t, keys in templates]
        vocabulary = sorted({w for _, ws, keys, _ in self.entries for w in ws + [x for k in keys for x in k]})
        self.idf = {w: math.log((n_docs + 1) / (document_frequency.get(w, 0) + 1)) + 1e-9 for w in vocabulary}
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        for e, (_, ws, _, exact) in enumerate(self.entries):
            for w in self._anchors(ws, exact):
                self.postings.setdefault(w, []).extend((e, q) for q, x in enumerate(ws) if x == w)
        self.weight = [sum(self.idf[w] for w in ws) for _, ws, _, _ in self.entries]
        self.keys = frozenset(self.postings)

    def _anchors(self, words: list[bytes], exact: bool) -> list[bytes]:
        """The rarest words of a template. A phrase goes under one, which all its places hold; a notice
        may miss words, so it goes under so many that the others' IDF is below MIN_COVERAGE of all."""
        count = Counter(words)
        rare = sorted(count, key=lambda w: (-self.idf[w], w))
        if exact:
            return rare[:1]
        left = total = sum(self.idf[w] * n for w, n in count.items())
        out = []
        for w in rare:
            if left < MIN_COVERAGE * total * (1 - 1e-9):
                break
            out.append(w)
            left -= self.idf[w] * count[w]
        return out

    def coverage(self, entry: int, words: list[bytes], start: int) -> float:
        """IDF share of the template's words that stand in place if it starts at ``start``."""
        template, n = self.entries[entry][1], len(words)
        here = sum(self.idf[w] for i, w in enumerate(template) if 0 <= start + i < n and words[start + i] == w)
        return here / self.weight[entry]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, str]], list[tuple[int, int, str, float]]]:
        """Base places (start, label), and matches (start, end, label, coverage) of notices."""
        if self.keys.isdisjoint(words):
            return [], []
        at: dict[bytes, list[int]] = {}
        for p, w in enumerate(words):
            if w in self.keys:
                at.setdefault(w, []).append(p)
        base, matches, tried = [], [], set()
        for w in sorted(at, key=lambda w: (-self.idf[w], w)):  # the file's highest-IDF licence words first
            for entry, q in self.postings[w]:
                label, template, keys, exact = self.entries[entry]
                for p in at[w]:
                    start = p - q
                    if (entry, start) in tried:
                        continue
                    tried.add((entry, start))
                    if exact:
                        if start >= 0 and words[start:start + len(template)] == template:
                            base.append((start, label))
                        continue
                    share = self.coverage(entry, words, start)
                    if share >= MIN_COVERAGE:
                        near = words[max(0, start - SLACK):max(0, start + len(template) + SLACK)]
                        if all(_stands(k, near) for k in keys):
                            matches.append((max(0, start), min(len(words), start + len(template)), label, share))
        return sorted(base), sorted(matches)


def _stands(phrase: list[bytes], words: list[bytes]) -> bool:
    n = len(phrase)
    return any(words[i] == phrase[0] and words[i:i + n] == phrase for i in range(len(words) - n + 1))


def vocabulary(base=BASE, templates=TEMPLATES) -> list[bytes]:
    texts = [p for p, _ in base] + [t for _, t, _ in templates] + [k for *_, ks in templates for k in ks]
    return sorted({w for t in texts for w in t.encode().split()})


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    for t in batch.column(batch.num_columns - 1):
        yield t.as_buffer().to_pybytes() if t.is_valid else b""


def document_frequency(docs: DataFrame, words: list[bytes], text_col: str = "text") -> tuple[dict[bytes, int], int]:
    """In how many files each licence word stands, over all files; and the number of files.

    One row per licence word comes to the driver.
    """
    wanted = frozenset(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = Counter(), 0
        for batch in batches:
            for text in _texts(batch):
                n += 1
                counts.update(wanted.intersection(words_of(text)))
        counts[b""] = n
        yield pa.RecordBatch.from_pydict({"word": [w.decode() for w in counts], "n": list(counts.values())})
    rows = (docs.select(F.col(text_col).alias("text")).mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).collect())
    found = {r["word"].encode(): r["n"] for r in rows}
    return found, found.pop(b"", 0)


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, matches array<struct<start:bigint,end:bigint,label:string,coverage:double>>")


def scan_licenses(docs: DataFrame, base=BASE, templates=TEMPLATES, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per file: words, base places and labels, all labels, score, and the notices found.

    score is the best share found: 1 where a base phrase stands, else the best notice's
    coverage, else 0.

    Defined cases: a null or empty text has no words and no labels (empty strings, null
    places, score 0); overlapping places of a phrase all count; a text of any length is scanned
    whole; repeated rows and null ids each get a row; other columns take no part, whatever
    their names; an empty table gives an empty result.
    """
    frequency, n_docs = document_frequency(docs, vocabulary(base, templates), text_col)
    index = Index(base, templates, frequency, n_docs)
    match = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("coverage", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[] for _ in range(8)]
            for text in _texts(batch):
                words = words_of(text)
                places, notices = index.scan(words)
                labels = {label for _, label in places}
                row = (len(words), len(places), places[0][0] if places else None, places[-1][0] if places else None,
                       ",".join(sorted(labels)), ",".join(sorted(labels | {m[2] for m in notices})),
                       1.0 if places else max((m[3] for m in notices), default=0.0),
                       [dict(zip(("start", "end", "label", "coverage"), m)) for m in notices])
                for c, v in zip(cols, row):
                    c.append(v)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(match)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
                       "matches"])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, SCHEMA)
