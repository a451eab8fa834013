"""License scans: sparse TF-IDF cosine of headers (runs of lines) and licence files (whole texts) to templates, then inheritance.

Document frequencies of all words are counted over the whole corpus. Those of common words, whose number is bounded, go
to the scanning tasks; rare words that bear on a decision get theirs by a join. A run of lines, of up to the longest notice's length, at ``HEADER`` or more to a notice gives its
document that licence; a text at ``FILE`` or more as a whole to a notice or a licence's whole text is
a licence file, and gives it to its directory. A document without a licence of its own takes that of the nearest
ancestor directory with a file, by a join on paths.

Defined results: null or wordless text has no licence and score 0; ties (scores that agree in nine digits) go to the first template; of several files in a
directory the best score (to six digits) counts, then the least path; a null path inherits nothing; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Cut, cut, spread_join

# Licence notices, as their authors ask for them to be given.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
)
WORD = re.compile(r"[^\W_]+(?:\.[0-9]+)*(?:-(?:sa|nc|nd)\b)?")
#: Whole licence files, named after their licence.
TEXTS = tuple((p.stem, p.read_text("utf-8")) for p in sorted((Path(__file__).parent / "licence_texts").glob("*.txt")))
# The AGPL's text differs from the GPL's by its name and one section; a stand-in made from the GPL's keeps the two apart.
TEXTS += tuple(("AGPL-3.0", re.sub("(?i)gnu general public", "GNU Affero General Public", t)) for n, t in TEXTS if n == "GPL-3.0")
HEADER, FILE = 0.75, 0.6
#: Words in more than this share of the documents are common.
SHARE = 0.001


def tokens(text: str) -> list[str]:
    return WORD.findall(text.lower())


def word_hash(word: str) -> int:
    return int.from_bytes(xxhash.xxh64_digest(word.encode("utf-8", "replace")), "big", signed=True)


class Scanner:
    """Template vectors under given document frequencies, by word; ``common`` has further ones by the word's hash. Any other word stands in at most ``rare`` documents."""

    def __init__(self, df: dict[str, int], total: int, templates=TEMPLATES, common: dict[int, int] | None = None, rare: float = 0, texts=TEXTS):
        self.templates = (*templates, *texts)
        self.longest = max((len(tokens(t)) for _, t in templates), default=0)
        idf = lambda n: math.log((1 + total) / (1 + n)) + 1
        self.unseen = idf(0)
        # the square of a rare word's weight lies between these
        self.low, self.high = idf(rare) ** 2, idf(min(rare, 1)) ** 2
        self.idf = {w: idf(n) for w, n in df.items()}
        self.common = {h: idf(n) for h, n in (common or {}).items()}
        # by word, of the headers' templates and of all
        self.postings, self.of_all = defaultdict(list), defaultdict(list)
        for k, (_, t) in enumerate(self.templates):
            counts = Counter(tokens(t))
            for w in counts:
                self.idf.setdefault(w, self.unseen)
            v = {w: n * self.idf[w] for w, n in counts.items()}
            norm = math.sqrt(sum(x * x for x in v.values()))
            for w, x in v.items():
                self.of_all[w].append((k, x / norm))
                if k < len(templates):
                    self.postings[w].append((k, x / norm))

    def parts(self, counts: Counter, least: float = 0.0, files: bool = False) -> tuple[float, int, float, list[tuple[int, int]]]:
        """(greatest dot product, its template's number or -1, squared norm of the words whose weight is known, hashes and counts of the others); -1 also if ``least`` is out of reach, as every word weighs 1 at least."""
        norm, idf, dots, others = 0.0, self.idf, defaultdict(float), []
        postings = self.of_all if files else self.postings
        for w, n in counts.items():
            if (x := idf.get(w)) is None:
                others.append((w, n))
                continue
            norm += (n * x) ** 2
            for k, y in postings.get(w, ()):
                dots[k] += n * x * y
        k = min(dots, key=lambda k: (-dots[k], k)) if dots else -1
        if k < 0 or dots[k] < least * math.sqrt(norm + sum(n * n for _, n in others)) * (1 - 1e-12):
            return 0.0, -1, norm, []
        rest = []
        for w, n in others:
            if (x := self.common.get(h := word_hash(w))) is None:
                rest.append((h, n))
            else:
                norm += (n * x) ** 2
        return dots[k], k, norm, rest

    def cosine(self, counts: Counter) -> tuple[float, int]:
        """(best cosine, its template's number or -1); a word without a weight counts as never seen."""
        dot, k, norm, rest = self.parts(counts)
        return (dot / math.sqrt(norm + sum((n * self.unseen) ** 2 for _, n in rest)), k) if k >= 0 else (0.0, -1)

    def windows(self, lines: list[Counter], whole: Counter):
        """Word counts of the runs of lines that can be a header: the first line with as many more as reach the longest template's length.

        A cosine is at most the root of the squared weights of a template's words that are there, so most texts have none.
        Lines with no word of a template within reach neither begin nor end a run, as they only make it longer.
        """
        there = defaultdict(float)
        for w in whole:
            for k, y in self.postings.get(w, ()):
                there[k] += y * y
        near = {k for k, x in there.items() if x >= HEADER * HEADER * (1 - 1e-12)}
        if not near:
            return
        use = {w for w in whole if any(k in near for k, _ in self.postings.get(w, ()))}
        bears, sizes = [not use.isdisjoint(c) for c in lines], [c.total() for c in lines]
        for i in range(len(lines)):
            if not bears[i]:
                continue
            run, size = Counter(), 0
            for j in range(i, len(lines)):
                if j > i and size >= self.longest:
                    break
                run.update(lines[j])
                size += sizes[j]
                if bears[j]:
                    yield run

    def units(self, text: str | None) -> list[tuple[int, float, int, float, list[tuple[int, int]]]]:
        """(0 for a run of lines or 1 for the whole text, *parts) of what can be the best header or file at its threshold, whatever its rare words weigh."""
        lines = [c for line in (text or "").split("\n") if (c := Counter(tokens(line)))]
        whole = Counter()
        for c in lines:
            whole.update(c)
        found = ([self.parts(c, HEADER) for c in self.windows(lines, whole)], [self.parts(whole, FILE, True)])
        out = []
        for kind, least in enumerate((HEADER, FILE)):
            spans = []
            for p in found[kind]:
                squares = sum(n * n for _, n in p[3])
                if p[1] >= 0 and p[0] >= least * math.sqrt(p[2] + squares * self.low) * (1 - 1e-12):
                    spans.append((p[0] / math.sqrt(p[2] + squares * self.low), p[0] / math.sqrt(p[2] + squares * self.high), p))
            best = max((s[1] for s in spans), default=0) * (1 - 1e-12)
            out += [(kind, *p[:3], list(p[3])) for p in sorted({(*p[:3], tuple(p[3])) for high, _, p in spans if high >= best})]
        return out


def frequencies(docs: DataFrame, text_col: str = "text", hold: int = 200_000) -> tuple[Cut, int]:
    """(h, n), documents with each word by its 64-bit hash, of all words over all documents; and the number of documents.

    Words are counted in tasks first, ``hold`` at a time, and go in sorted blocks, by a share of the hashes, to where blocks are merged.
    """
    shares = max(64, 8 * docs.rdd.getNumPartitions())
    item = np.dtype([("h", "<i8"), ("n", "<i8")])

    def blocks(found: Counter) -> pa.RecordBatch:
        x = np.fromiter(((word_hash(w), n) for w, n in found.items()), item, len(found))
        share = x["h"] % shares
        x, share = x[order := np.argsort(share, kind="stable")], share[order]
        at = np.flatnonzero(np.diff(share, prepend=-1))
        return pa.RecordBatch.from_arrays([pa.array(share[at]), pa.array([part.tobytes() for part in np.split(x, at[1:])], pa.binary())], ["share", "block"])

    def run(batches):
        found = Counter()
        total = 0
        for b in batches:
            total += len(b)
            for t in b.column("t"):
                found.update(set(tokens(t.as_py() or "")))
                if len(found) >= hold:
                    yield blocks(found)
                    found = Counter()
        if found:
            yield blocks(found)
        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), pa.array([np.array([(0, total)], item).tobytes()], pa.binary())], ["share", "block"])

    def merge(group: pa.Table) -> pa.Table:
        x = np.frombuffer(b"".join(group.column("block").to_pylist()), item)
        h, place = np.unique(x["h"], return_inverse=True)
        n = np.zeros(len(h), np.int64)
        np.add.at(n, place, x["n"])
        return pa.table({"share": pa.array(np.full(len(h), group.column("share")[0].as_py(), np.int64)), "h": pa.array(h), "n": pa.array(n)})

    counts = Cut(docs.select(F.col(text_col).alias("t")).mapInArrow(run, "share long, block binary").groupBy("share").applyInArrow(merge, "share long, h long, n long"))
    total = counts.df.where("share = -1").agg(F.sum("n").alias("n")).first()["n"] or 0
    counts.df = counts.df.where("share >= 0").select("h", "n")
    return counts, total


def weights(counts: DataFrame, total: int, templates=(*TEMPLATES, *TEXTS), share: float = SHARE) -> tuple[dict[str, int], dict[int, int]]:
    """Frequencies of the templates' words; and, by hash, of those in more than ``share`` of the documents, at most a document's mean number of distinct words over ``share``."""
    words = {word_hash(w): w for _, t in templates for w in tokens(t)}
    vocabulary = counts.sparkSession.createDataFrame(sorted((h,) for h in words), "h long")
    df = {words[r["h"]]: r["n"] for r in counts.join(F.broadcast(vocabulary), "h").collect()}
    return df, {r["h"]: r["n"] for r in counts.where(F.col("n") > share * total).collect()}


def scan(docs: DataFrame, scanner: Scanner, counts: DataFrame, total: int, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text") -> DataFrame:
    """(id, path, header, header_score, file, file_score) of every document; a score below its threshold is given as 0.

    Weights of rare words come by a join: only of runs of lines and texts that can reach their threshold.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    unit = "struct<kind:int,dot:double,k:int,norm:double,rest:array<struct<h:long,c:long>>>"
    form = pa.list_(pa.struct([("kind", pa.int32()), ("dot", pa.float64()), ("k", pa.int32()), ("norm", pa.float64()), ("rest", pa.list_(pa.struct([("h", pa.int64()), ("c", pa.int64())])))]))

    def run(batches):
        for b in batches:
            batch = uuid.uuid4().bytes
            rows = [batch + k.to_bytes(4, "big") for k in range(len(b))]
            units = [[{"kind": u[0], "dot": u[1], "k": u[2], "norm": u[3], "rest": [{"h": h, "c": c} for h, c in u[4]]} for u in scanner.units(t.as_py())] or None for t in b.column("t")]
            yield pa.RecordBatch.from_arrays([b.column("i"), b.column("p"), pa.array(rows, pa.binary()), pa.array(units, form)], [id_col, "path", "row", "units"])

    seen = Cut(docs.select(F.col(id_col).alias("i"), F.col(path_col).alias("p"), F.col(text_col).alias("t")).mapInArrow(run, f"`{id_col}` {kind}, path string, row binary, units array<{unit}>")).df
    units = seen.where(F.col("units").isNotNull()).select("row", F.posexplode("units").alias("at", "u"))
    words = units.select("row", "at", F.explode("u.rest").alias("x")).select("row", "at", "x.h", "x.c")
    weight = F.log((1.0 + total) / (1.0 + F.col("n"))) + 1
    rest = words.join(counts, "h").groupBy("row", "at").agg(F.sum((F.col("c") * weight) ** 2).alias("more"))
    score = F.col("u.dot") / F.sqrt(F.col("u.norm") + F.coalesce("more", F.lit(0.0)))
    scored = units.join(rest, ["row", "at"], "left").select("row", "u.kind", "u.k", F.round(score, 9).alias("score"))
    reached = scored.where(F.col("score") >= F.when(F.col("kind") == 0, HEADER).otherwise(FILE))
    best = lambda k: F.max(F.when(F.col("kind") == k, F.struct("score", (-F.col("k")).alias("k"))))
    per_row = reached.groupBy("row").agg(best(0).alias("h"), best(1).alias("f"))
    names = F.array(*[F.lit(name) for name, _ in scanner.templates])
    name = lambda c: F.when(F.col(c).isNotNull(), names[-F.col(f"{c}.k")])
    return seen.join(per_row, "row", "left").select(id_col, "path", name("h").alias("header"), F.coalesce("h.score", F.lit(0.0)).alias("header_score"), name("f").alias("file"), F.coalesce("f.score", F.lit(0.0)).alias("file_score"))


def inherit(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Adds license, basis (header, file, inherited, none) and inherited_from: the nearest ancestor directory with a licence file."""
    folder = lambda c: F.regexp_replace(c, "/?[^/]*$", "")
    files = scanned.where(F.col("file").isNotNull() & F.col("path").isNotNull()).select(folder("path").alias("dir"), "file", "file_score", "path")
    dirs = cut(files.groupBy("dir").agg(F.min_by("file", F.struct((-F.round("file_score", 6)).alias("s"), "path")).alias("dir_license")))
    # directories first: each is resolved once, however many documents it holds
    parts = F.split("own_dir", "/")
    own = scanned.where(F.col("path").isNotNull()).select(folder("path").alias("own_dir")).distinct()
    above = own.select("own_dir", F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))).alias("dir"))
    # a root stands above all directories of its tree, a flat directory holds many documents: both joins spread such keys
    nearest = cut(spread_join(above, dirs, ["dir"], dirs.count(), ["own_dir"]).groupBy("own_dir").agg(F.max_by(F.struct("dir", "dir_license"), F.length("dir")).alias("up")))
    rows = spread_join(scanned.withColumn("own_dir", folder("path")), nearest, ["own_dir"], nearest.count(), [id_col], "left")
    own_license = F.coalesce("header", "file")
    basis = F.when(F.col("header").isNotNull(), "header").when(F.col("file").isNotNull(), "file").when(F.col("up").isNotNull(), "inherited").otherwise("none")
    return rows.select(id_col, "path", "header", F.round("header_score", 6).alias("header_score"), "file", F.round("file_score", 6).alias("file_score"), F.coalesce(own_license, F.col("up.dir_license")).alias("license"), basis.alias("basis"), F.when(own_license.isNull(), F.col("up.dir")).alias("inherited_from"))


def license_scan(docs: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text", share: float = SHARE) -> DataFrame:
    counts, total = frequencies(docs, text_col)
    df, common = weights(counts.df, total, share=share)
    scanner = Scanner(df, total, common=common, rare=share * total)
    return inherit(cut(scan(docs, scanner, counts.df, total, id_col, path_col, text_col)), id_col)
