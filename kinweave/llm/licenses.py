"""License scans: normalised text against license templates by Dice coefficient over word bigrams.

A text's units are its lines, the text as a whole, and of each template every run of as many words as it
has, so a notice on a line, one wrapped over lines or within one, and a document that is a license are
found. Runs are compared only where enough of the template's bigrams stand close together. A unit is compared with a template only if their numbers of distinct
bigrams allow a coefficient of `least`: t * m / (2 - t) <= n <= m * (2 - t) / t. Templates are sorted
by size, so a unit's candidates are one run of them, found by bisection; most lines have none.

Normalised: A-Z in lower case, every other character but letters and digits a space. A unit of one word
has that word as its only bigram. Null or empty text: no license, 0. Ties between templates: the one
whose name comes first. Very long texts: whole; their bigrams are made only while their size may fit.
Repeated rows: each alike. Extra columns pass through; own columns of the same names are replaced.
Empty table: no rows.
"""

from __future__ import annotations

import bisect
import itertools
import math
import re
from collections import Counter, defaultdict
from importlib.resources import files

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from kinweave.llm.common import small_batches, table

LEAST = 0.7
#: Names and notices of public licenses.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "mit": "Released under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}
# Whole licenses, by the file's name.
TEMPLATES |= {x.name.removesuffix(".txt"): x.read_text("utf-8") for x in files("kinweave.llm").joinpath("license_texts").iterdir() if x.name.endswith(".txt")}
_OTHER = re.compile(r"[\W_]+")
_FOLD = {c: c + 32 for c in range(65, 91)}


def words(text: str) -> list[str]:
    return _OTHER.sub(" ", text.translate(_FOLD)).split()


def bigrams(w: list[str]) -> frozenset:
    return frozenset(zip(w, w[1:], strict=False)) if len(w) != 1 else frozenset([(w[0],)])


class Templates:
    def __init__(self, templates: dict[str, str], least: float):
        self.least = least
        made = sorted((len(b), name, b) for name, t in templates.items() if (b := bigrams(words(t))))
        self.sizes = [m for m, _, _ in made]
        self.made = made
        self.most = max(self.sizes, default=0) * (2 - least) / least
        self.smallest = min(self.sizes, default=1) * least / (2 - least)
        # Of each template its number of words and how many of its bigrams a run must hold; of each bigram its templates.
        self.length = [len(words(templates[name])) for _, name, _ in made]
        self.need = [max(1, math.ceil(m * least / (2 - least) - 1e-9)) for m in self.sizes]
        self.of: dict[tuple, list[int]] = defaultdict(list)
        for k, (_, _, b) in enumerate(made):
            if self.length[k] > 1:
                for x in b:
                    self.of[x].append(k)

    def best(self, unit: str) -> tuple[float, str | None]:
        # A word takes two characters at least, and a unit of few words has few bigrams.
        if len(unit) < self.smallest:
            return 0.0, None
        w = words(unit)
        # Repeats make a unit's bigrams fewer than its words, never more.
        if len(w) - 1 < self.smallest and len(w) != 1:
            return 0.0, None
        b = bigrams(w)
        n = len(b)
        if not self.smallest <= n <= self.most:
            return 0.0, None
        t, out = self.least, (0.0, None)
        for k in range(bisect.bisect_left(self.sizes, n * t / (2 - t) - 1e-9), bisect.bisect_right(self.sizes, n * (2 - t) / t + 1e-9)):
            m, name, other = self.made[k]
            dice = 2 * len(b & other) / (n + m)
            if dice >= t and (dice > out[0] or dice == out[0] and name < out[1]):
                out = dice, name
        return out

    def runs(self, w: list[str]) -> list[tuple[float, str, int, int, int]]:
        """(coefficient, name, first word, end, weight) of the runs of words that match, none overlapping a heavier one: the weight is the bigrams in common less those that either has alone."""
        pairs = list(zip(w, w[1:], strict=False))
        places: dict[int, list[int]] = defaultdict(list)
        for i, x in enumerate(pairs):
            if x in self.of:
                for k in self.of[x]:
                    places[k].append(i)
        found = []
        for k, at in places.items():
            size, need, (m, name, other) = self.length[k], self.need[k], self.made[k]
            near = [i for i, j in zip(at, at[need - 1 :], strict=False) if j - i <= size - 2]
            if len(w) < size or not near:
                continue
            begin, most = 0, len(w) - size
            while begin < len(near):
                # Runs that may hold enough, as one stretch of first words.
                end = begin
                while end + 1 < len(near) and near[end + 1] - near[end] < size:
                    end += 1
                low, high = min(most, max(0, near[begin] - size + 2)), min(most, near[end])
                begin = end + 1
                held = Counter(pairs[low : low + size - 1])
                both = sum(x in other for x in held)
                for i in range(low, high + 1):
                    dice = 2 * both / (len(held) + m)
                    if dice >= self.least:
                        found.append((len(held) + m - 3 * both, -dice, name, i, i + size))
                    if i < high:
                        x = pairs[i]
                        held[x] -= 1
                        if not held[x]:
                            del held[x]
                            both -= x in other
                        x = pairs[i + size - 1]
                        if x not in held:
                            both += x in other
                        held[x] += 1
        out: list[tuple[float, str, int, int, int]] = []
        for less, dice, name, i, j in sorted(found):
            if all(j <= a or b <= i for _, _, a, b, _ in out):
                out.append((-dice, name, i, j, -less))
        return out


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST) -> DataFrame:
    """docs, all columns, with license (the best match of a document, else null), dice and n_notices (lines that match and are no part of a longer notice, and runs of words that don't lie half or more in such lines)."""
    small_batches(docs.sparkSession)
    held = Templates(TEMPLATES if templates is None else templates, least)
    own = [f for f in docs.schema if f.name not in ("license", "dice", "n_notices")]

    def run(batches):
        memo: dict[str, tuple] = {}
        for batch in batches:
            name, dice, notices = [], [], []
            for text in batch.column(batch.schema.get_field_index("text")).to_pylist():
                best, found, n = 0.0, None, 0
                lines = (text or "").split("\n")
                matched: dict[int, tuple] = {}
                for at, line in enumerate(lines + [text] * (len(lines) > 1)):
                    got = memo.get(line)
                    if got is None:
                        got = held.best(line)
                        if got[1] is not None and len(memo) < 10_000:
                            memo[line] = got
                    if got[1] is not None:
                        matched[at] = got
                runs = held.runs(words(text or ""))
                ends = list(itertools.accumulate((len(words(x)) for x in lines), initial=0)) if runs else []
                for score, license, i, j, weight in runs:
                    inside = {k: min(j, ends[k + 1]) - max(i, ends[k]) for k in matched if k < len(lines) and ends[k] < j and i < ends[k + 1]}
                    # A line of a longer notice is no notice of its own.
                    for k in [k for k, many in inside.items() if 1 < len(lines) and many == ends[k + 1] - ends[k] < j - i and weight > many]:
                        del matched[k], inside[k]
                    n += 2 * sum(inside.values()) < j - i
                    if (-score, license) < (-best, found or "~"):
                        best, found = score, license
                for at, got in matched.items():
                    n += at < len(lines)
                    if (-got[0], got[1]) < (-best, found or "~"):
                        best, found = got
                name.append(found)
                dice.append(best)
                notices.append(n)
            columns = {f.name: batch.column(batch.schema.get_field_index(f.name)) for f in own}
            columns |= {"license": pa.array(name, pa.string()), "dice": pa.array(dice, pa.float64()), "n_notices": pa.array(notices, pa.int64())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return docs.mapInArrow(run, ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in own] + ["license string", "dice double", "n_notices long"]))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "license", "dice", "n_notices")
