"""License scan of a tree of files, and inheritance from the nearest directory with a licence file.

**Scan.** Each line of a file, each run of lines and the file as a whole are sparse TF-IDF vectors; so is each
template. A notice wrapped over lines is a run, wherever it stands in a header, with or without blank lines and
comment marks. The inverse document frequencies are those of the templates, with the value of an unseen term for all
others, so a vector does not depend on which files are scanned together. A file has the license of the template with
the largest cosine among its lines, runs and whole text, if that is at least ``THRESHOLD``. Only templates that share
a term are compared.

A run ends with the line that brings it to twice the terms of the longest template. The square of a run's cosine is at
most the sum of the squares of its lines' cosines, as no weight is negative; runs which that keeps below the threshold
are not computed, so a cosine below the threshold is that of a line or of the whole text.

**Inheritance.** A file without a license of its own takes that of the nearest directory above it, its own first, that
holds a licence file. Directories are joined by path: distinct directories first, each with its ancestors, so the
number of files in a directory does not matter until the last join.

Cases: a null text has no license; a null path is in no directory and inherits nothing; of several licence files of a
directory the largest cosine counts, then the least path; ties between templates go to the least name; repeated
rows are answered one by one; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_slice, column, files_for, in_files, mapped, stored

THRESHOLD = 0.75
LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)([._-].*)?$"

# Notices by which files state their license.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in'
        " compliance with the License.",
        "Apache License Version 2.0, January 2004",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "The MIT License (MIT)",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        ' associated documentation files (the "Software"), to deal in the Software without restriction',
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "GNU General Public License Version 3, 29 June 2007",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU"
        " General Public License as published by the Free Software Foundation, either version 3 of the License,"
        " or (at your option) any later version.",
    ),
    "BSD-3-Clause": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided"
        " that the following conditions are met",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Mozilla Public License Version 2.0",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
}
TERM = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")
# Comment marks that would read as terms; all others hold no letter.
COMMENT_WORD = re.compile(r"^(?:c(?=\s)|\s*(?:@?rem|dnl)(?=\s))")
# A term broken at its hyphen by a line's end.
BROKEN_TERM = re.compile(rf"({TERM.pattern}-)\r?\n([^a-z0-9\n]*)({TERM.pattern})")
# Rounding of the sums of squares.
SLACK = 1e-9


class Templates:
    """TF-IDF vectors of the templates, and cosines to them."""

    def __init__(self, templates: Mapping[str, Sequence[str]]) -> None:
        named = [(name, Counter(TERM.findall(text.lower()))) for name in sorted(templates) for text in templates[name]]
        frequency = Counter(term for _, terms in named for term in terms)
        self.unseen = math.log(1 + len(named)) + 1
        self.idf = {term: math.log((1 + len(named)) / (1 + n)) + 1 for term, n in frequency.items()}
        self.names = [name for name, _ in named]
        self.most_terms = 2 * max((terms.total() for _, terms in named), default=0)
        self.postings: dict[str, list[tuple[int, float]]] = defaultdict(list)
        for place, (_, terms) in enumerate(named):
            norm = math.sqrt(sum((n * self.idf[term]) ** 2 for term, n in terms.items()))
            for term, n in terms.items():
                self.postings[term].append((place, n * self.idf[term] / norm))

    def cosines(self, terms: Counter[str]) -> dict[int, float]:
        """Cosines to the templates that share a term."""
        shared = terms.keys() & self.postings.keys()
        if not shared:
            return {}
        products: dict[int, float] = defaultdict(float)
        for term in sorted(shared):
            weight = terms[term] * self.idf[term]
            for place, share in self.postings[term]:
                products[place] += weight * share
        norm = math.sqrt(sum((n * self.idf.get(term, self.unseen)) ** 2 for term, n in terms.items()))
        return {place: product / norm for place, product in products.items()}

    def best(self, cosines: Mapping[int, float]) -> tuple[float, str | None]:
        """The largest cosine to a template, and its license."""
        if not cosines:
            return 0.0, None
        place = min(cosines, key=lambda one: (-cosines[one], one))
        return cosines[place], self.names[place]

    def lines_of(self, text: str) -> list[str]:
        """Lines in lower case without comment words; a term of the templates that is broken stands on the first."""

        def whole(broken: re.Match[str]) -> str:
            head, mark, tail = broken.groups()
            return f"{head}{tail}\n{mark}" if head + tail in self.idf else broken[0]

        return [COMMENT_WORD.sub("", line) for line in BROKEN_TERM.sub(whole, text.lower()).split("\n")]

    def license_of(self, text: str, threshold: float = THRESHOLD) -> tuple[float, str | None]:
        whole: Counter[str] = Counter()
        best: tuple[float, str | None] = (0.0, None)
        lines: list[tuple[Counter[str], int, dict[int, float]]] = []
        for line in self.lines_of(text):
            terms = Counter(TERM.findall(line))
            if not terms:
                continue
            whole.update(terms)
            cosines = self.cosines(terms)
            lines.append((terms, terms.total(), cosines))
            found = self.best(cosines)
            if found[0] > best[0]:
                best = found
        if len(lines) > 1:
            found = self.best(self.cosines(whole))
            best = found if found[0] > best[0] else best
        return self.best_run(lines, threshold, best)

    def best_run(
        self,
        lines: Sequence[tuple[Counter[str], int, dict[int, float]]],
        threshold: float,
        best: tuple[float, str | None],
    ) -> tuple[float, str | None]:
        """The best of what is found already and of the runs of two lines and more that reach the threshold."""
        squares: dict[int, float] = defaultdict(float)
        end, n_terms = 0, 0
        for start, (first, n_first, cosines) in enumerate(lines):
            while end < len(lines) and (n_terms < self.most_terms or end <= start):
                n_terms += lines[end][1]
                for place, cosine in lines[end][2].items():
                    squares[place] += cosine * cosine
                end += 1
            # A run that starts with a line of no cosine is worse than the rest of it.
            if cosines and end - start > 1 and max(squares.values()) + SLACK >= max(threshold, best[0]) ** 2:
                terms = Counter(first)
                for more, _, shared in lines[start + 1 : end]:
                    terms.update(more)
                    if shared:
                        found = self.best(self.cosines(terms))
                        if found[0] >= threshold and found[0] > best[0]:
                            best = found
            n_terms -= n_first
            for place, cosine in cosines.items():
                squares[place] -= cosine * cosine
        return best


def scanned(
    files: DataFrame, templates: Mapping[str, Sequence[str]] = TEMPLATES, threshold: float = THRESHOLD
) -> DataFrame:
    """``path`` and ``text`` to ``path``, ``own`` (a license or null) and ``cosine`` of the best template."""

    def scan(frame: pd.DataFrame) -> pd.DataFrame:
        known = Templates(templates)
        found = [known.license_of(text, threshold) for text in frame["text"]]
        return pd.DataFrame(
            {
                "path": frame["path"],
                "own": [name if cosine >= threshold else None for cosine, name in found],
                "cosine": [cosine for cosine, _ in found],
            }
        )

    return mapped(files, by_slice(scan), T.StructType.fromDDL("path string, own string, cosine double"))


def directory_of(path: Column) -> Column:
    """The path without its last part; the root is the empty path."""
    return F.regexp_replace(path, r"(^|/)[^/]*$", "")


def ancestors(directory: Column) -> Column:
    """A directory and those above it, the root included, as structs of depth and path."""
    parts = F.array_remove(F.split(directory, "/"), "")
    return F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda depth: F.struct(
            depth.alias("depth"), F.array_join(F.slice(parts, F.lit(1), depth), "/").alias("path")
        ),
    )


def licenses(
    files: DataFrame,
    path: str = "path",
    text: str = "text",
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Per file: ``path``, ``license``, ``origin`` (``own``, ``inherited`` or ``none``), ``cosine`` and
    ``licensed_by``, the licence file it inherits from.

    Where Spark does not merge small partitions, the result has as many as its rows need, whatever the joins have.
    """
    read = files.select(
        column(path).cast("string").alias("path"),
        F.coalesce(column(text).cast("string"), F.lit("")).alias("text"),
    )
    parts = files_for(read)
    found = stored(scanned(read, templates, threshold), "scanned", parts).withColumn(
        "directory", F.array_join(F.array_remove(F.split(directory_of(F.col("path")), "/"), ""), "/")
    )
    # The largest cosine first, then the least path; a path alone cannot tie.
    stated = (
        found.filter(F.col("own").isNotNull() & F.element_at(F.split("path", "/"), -1).rlike(LICENCE_FILE))
        .groupBy("directory")
        .agg(F.min(F.struct((-F.col("cosine")).alias("order"), "path", "own")).alias("stated"))
        .select(F.col("directory").alias("above"), "stated")
    )
    above = found.filter("directory is not null").select("directory").distinct()
    above = above.select("directory", F.explode(ancestors(F.col("directory"))).alias("up"))
    nearest = (
        above.select("directory", "up.depth", F.col("up.path").alias("above"))
        .join(stated, "above")
        .groupBy("directory")
        .agg(F.max_by("stated", "depth").alias("stated"))
    )
    joined = found.join(nearest, "directory", "left")
    inherited = F.col("own").isNull() & F.col("stated").isNotNull()
    answers = joined.select(
        "path",
        F.when(inherited, F.col("stated.own")).otherwise(F.col("own")).alias("license"),
        F.when(F.col("own").isNotNull(), "own").when(inherited, "inherited").otherwise("none").alias("origin"),
        "cosine",
        F.when(inherited, F.col("stated.path")).alias("licensed_by"),
    )
    return in_files(answers, parts)


def files_of_documents(docs: DataFrame) -> DataFrame:
    """The test documents as files: a folder per source and language, and one in it for every fifty ids.

    A document that speaks of a license is a licence file of its source and language. Those without an id are
    files named ``none``.
    """
    number = F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))
    licence = F.lower(F.coalesce("text", F.lit(""))).contains("license")
    folder = F.coalesce(F.floor(F.col("doc_id") / 50).cast("string"), F.lit("none"))
    name = F.when(licence, F.concat(F.lit("LICENSE-"), number)).otherwise(
        F.concat(folder, F.lit("/"), number, F.lit(".txt"))
    )
    top = [F.coalesce(part, F.lit("unknown")) for part in ("source", "lang")]
    return docs.select("doc_id", F.concat_ws("/", *top, name).alias("path"), "text")
