"""License scans: MinHash bands over overlapping text windows.

Texts and templates are lower-cased words of letters and digits, as sets of five-word shingles.
Windows have 1, 2, 4, ... shingles and begin every quarter of their length; a template is looked
for in windows of the next such length that holds it. Every window gets ``BANDS`` MinHash values,
one to a band, and retrieves the templates that share one. A template whose shingles are there
to 80% has a Jaccard similarity of at least 0.8 / 2.2 = 0.36 with a window that holds them, and
collides with a probability of at least 1 - 0.64 ** 24 = 0.99997. Then the exact containment is
computed, and 0.8 or more is a match.

Equal MinHash values mean equal shingles, so a text that has no shingle of any template has no
collision and is left at that. Templates are a parameter, checked to be at most
``MOST_TEMPLATES``; they go to every task, and no text is shuffled.

Nulls: a null text is empty and has no match; a null doc_id stays null. Several matches of one
template in a text are rows of their own unless they overlap, of which the fullest (then the
first) counts; a template that overlaps another one's fuller match (another version) is none. Repeated rows match each time. Templates without five words match nothing.
"""

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

SHINGLE = 5
BANDS = 24
LEAST = 0.8
MOST_TEMPLATES = 100_000
WORDS = re.compile(rb"[a-z0-9]+")

# Public license notices, as their licenses recommend them.
NOTICES = {
    "MIT": "Released under the MIT License.",
    "MIT-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
    "compliance with the License. You may obtain a copy of the License at",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
CC_PARTS = {"BY": "Attribution", "NC": "NonCommercial", "ND": "NoDerivatives", "SA": "ShareAlike"}


def templates() -> list[tuple[str, str]]:
    """(license, text) of the notices, and of every Creative Commons license and version."""
    out = list(NOTICES.items())
    for parts in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        name = "-".join(CC_PARTS[p] for p in parts.split("-"))
        for version in ("2.0", "2.5", "3.0", "4.0"):
            out.append((f"CC-{parts}-{version}", f"Licensed under CC {parts} {version}."))
            out.append((f"CC-{parts}-{version}", f"Licensed under a Creative Commons {name} {version} license"))
    return out


_rng = np.random.default_rng(9)
_A = _rng.integers(1, 1 << 62, BANDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 62, BANDS, dtype=np.uint64)
_M = np.uint64(0x9E3779B97F4A7C15)


def shingles(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    h = np.array([digest(w) for w in words], np.uint64)
    n = max(len(h) - SHINGLE + 1, 0)
    out = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        out = (out + h[k : n + k]) * _M
    return out ^ (out >> np.uint64(29))


def banded(values: np.ndarray) -> np.ndarray:
    """Each shingle's value for each band."""
    h = values[None, :] * _A[:, None] + _B[:, None]
    return h ^ (h >> np.uint64(32))


class Templates:
    """Templates by the MinHash values of their bands, for each window length."""

    def __init__(self, rows: list[tuple[str, str]]):
        if len(rows) > MOST_TEMPLATES:
            raise ValueError(f"at most {MOST_TEMPLATES} templates, as every task holds them")
        self.names = [n for n, _ in rows]
        self.sets = [np.unique(shingles(WORDS.findall(t.lower().encode()))) for _, t in rows]
        self.any = np.unique(np.concatenate([*self.sets, np.zeros(0, np.uint64)]))
        self.by_width: dict[int, dict[tuple[int, int], list[int]]] = {}
        for k, s in enumerate(self.sets):
            if len(s):
                width = 1 << (len(s) - 1).bit_length()
                table = self.by_width.setdefault(width, {})
                for band, v in enumerate(banded(s).min(axis=1).tolist()):
                    table.setdefault((band, v), []).append(k)

    def candidates(self, values: np.ndarray):
        """(template, first shingle, shingles in the window) of the colliding windows."""
        least, width = banded(values), 1
        while True:
            table = self.by_width.get(width)
            if table:
                step = max(1, width // 4)
                # The last window is cut short by the text's end; later starts add nothing.
                for start in range(0, max(len(values) - width, 0) + step, step):
                    if start < len(values):
                        found = {k for key in enumerate(least[:, start].tolist()) for k in table.get(key, ())}
                        for k in found:
                            yield k, start, min(width + step, len(values) - start)
            width *= 2
            if width > max(self.by_width, default=0):
                return
            half = width // 2
            longer = least.copy()
            if least.shape[1] > half:
                np.minimum(longer[:, :-half], least[:, half:], out=longer[:, :-half])
            least = longer

    def matches(self, text: bytes) -> list[tuple[str, int, int, float]]:
        """(license, first word, number of words, containment) of a text."""
        words = WORDS.findall(text.lower())
        values = shingles(words)
        near = np.flatnonzero(np.isin(values, self.any))
        if not len(near):
            return []
        reach = 2 * max(self.by_width)
        found = []
        # Stretches of the text within reach of some template's shingle.
        for part in np.split(near, np.flatnonzero(np.diff(near) > 2 * reach) + 1):
            a, b = max(0, part[0] - reach), min(len(values), part[-1] + reach + 1)
            for k, start, length in set(self.candidates(values[a:b])):
                at = a + start + np.flatnonzero(np.isin(values[a + start : a + start + length], self.sets[k]))
                share = len(np.unique(values[at])) / len(self.sets[k])
                if share >= LEAST:
                    found.append((-share, int(at[0]), int(at[-1]) + SHINGLE, self.names[k]))
        out: list[tuple[str, int, int, float]] = []
        for share, first, last, name in sorted(found):
            if not any((name == o[0] or -share < o[3]) and first < o[1] + o[2] and o[1] < last for o in out):
                out.append((name, first, last - first, -share))
        return sorted(out)


def licenses(docs: DataFrame, rows: list[tuple[str, str]] | None = None) -> DataFrame:
    """One row per match: doc_id, license, first_word, n_words, containment."""
    rows = templates() if rows is None else rows
    Templates(rows)  # checks the bound before anything runs
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "license", "first_word", "n_words", "containment"]

    def run(batches):
        known = Templates(rows)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            found = [(k, *m) for k, t in enumerate(texts) if t for m in known.matches(t.encode())]
            at, license, first, size, share = zip(*found, strict=True) if found else ((),) * 5
            columns = [batch.column("doc_id").take(pa.array(at, pa.int64())), pa.array(license, pa.string())]
            columns += [pa.array(first, pa.int64()), pa.array(size, pa.int64()), pa.array(share, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"doc_id {id_type}, license string, first_word bigint, n_words bigint, containment double"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
