"""Licence scan: TF-IDF cosine to licence templates, then inheritance along directories.

A file's notice is what its whole text says about licences: all of it if the file is named
as a licence file, else every line with a cue (licence, copyright, SPDX and the like).  Notice
and templates become sparse TF-IDF vectors; the template of the largest cosine of at least
``threshold`` is the file's licence.  A licence file covers its directory and all below; a
file without a licence of its own takes the one of its nearest such ancestor, by an equality
join of the distinct directories' ancestors with the covered directories.

Templates are notices, headers and whole licence texts (``license_texts``).  A licence file is
compared with all of them as they are, any other file with what its own rule leaves of
them, their lines with a cue; so is a licence file that resembles none as a whole.  Document frequencies are those of all files' notices, counted in
one aggregate: the terms of templates one by one, all others by their mean.  So what the
driver holds follows the templates alone, and a vector is built within its row.

Defined results: null text or path has no notice; a null path inherits nothing.  Equal
cosines go to the first template by name.  Of several licence files in a directory the best
cosine counts, then the first licence by name.  Where the nearest licence file has words but no
known licence, what lies above it ends there: its heirs are ``unknown``.  Repeated rows get equal results; other
columns pass through where ``carry`` names them.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import written

CUES = r"(?i)licen[cs]e|copyright|spdx|all rights reserved|public domain|creative commons|redistribut"
LICENSE_FILE = r"(?i)^(un)?licen[cs]e|^copying|^notice|^copyright"


def _free(work: str, kind: str, version: str) -> str:
    return (
        f"This {work} is free software: you can redistribute it and/or modify\n"
        f"it under the terms of the GNU {kind} Public License as published by\n"
        f"the Free Software Foundation, either version {version} of the License, or\n"
        "(at your option) any later version.\n\n"
        f"This {work} is distributed in the hope that it will be useful,\n"
        "but WITHOUT ANY WARRANTY; without even the implied warranty of\n"
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\n"
        f"GNU {kind} Public License for more details.\n\n"
        f"You should have received a copy of the GNU {kind} Public License\n"
        f"along with this {work}.  If not, see <http://www.gnu.org/licenses/>."
    )


#: Notices of well-known licences, as text.
NOTICES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "You may not use this file except in compliance with the Apache License.",
        "Licensed under the Apache License, Version 2.0 (the \"License\");\n"
        "you may not use this file except in compliance with the License.\n"
        "You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\n"
        "Unless required by applicable law or agreed to in writing, software\n"
        "distributed under the License is distributed on an \"AS IS\" BASIS,\n"
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\n"
        "See the License for the specific language governing permissions and\n"
        "limitations under the License.",
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted.",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "Creative Commons Attribution 4.0 International License"),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.", "Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    "CC0-1.0": ("Dedicated to the public domain under CC0 1.0.",),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.", _free("program", "General", "3"),
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2.", _free("program", "General", "2"),
    ),
    "LGPL-3.0": (
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        _free("library", "Lesser General", "3"),
    ),
    "LGPL-2.1": (
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        _free("library", "Lesser General", "2.1"),
    ),
    "MIT": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public\n"
        "License, v. 2.0. If a copy of the MPL was not distributed with this\n"
        "file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "Proprietary": ("Copyright. All rights reserved.", "Confidential and proprietary."),
}
#: Whole licence texts by file name; no text of the CC BY licences is at hand.
WHOLE = {p.stem: p.read_text("utf-8") for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))}
TEMPLATES = {
    name: (*NOTICES.get(name, ()), *([WHOLE[name]] if name in WHOLE else [])) for name in sorted({*NOTICES, *WHOLE})
}
TERM = "[^a-z0-9.\\-]+"
#: Parts of the table of terms, so that a word is looked up among few.
PARTS = 512
UNKNOWN = "unknown"
#: A notice has a template's name only with this share of the number of its terms at least, so
#: that a sentence of prose is not held against the function words of a whole text.
LEAST = 0.25


def _terms(text: str) -> list[str]:
    return [t for t in (w.strip(".-") for w in re.split(TERM, text.lower())) if t]


def _with_cue(text: str) -> str:
    return "\n".join(line for line in text.split("\n") if re.search(CUES, line)) or text


Vectors = dict[tuple[str, int], dict[str, float]]


def vectors_of(templates: Mapping[str, Sequence[str]], idf: Mapping[str, float]) -> Vectors:
    """Unit vectors of the templates by licence and place."""
    vectors = {}
    for name, texts in templates.items():
        for i, text in enumerate(texts):
            bag = _terms(text)
            raw = {t: bag.count(t) * idf[t] for t in sorted(set(bag))}
            norm = math.sqrt(sum(v * v for v in raw.values()))
            vectors[name, i] = {t: v / norm for t, v in raw.items()}
    return vectors


def weights(templates: Mapping[str, Sequence[str]]) -> tuple[dict[str, float], float, Vectors]:
    """Inverse document frequencies among the templates, that of a word in none, and unit vectors."""
    bags = [set(_terms(text)) for texts in templates.values() for text in texts]
    found = sorted(set().union(*bags))
    idf = {t: math.log((1 + len(bags)) / (1 + sum(t in bag for bag in bags))) + 1 for t in found}
    return idf, math.log(1 + len(bags)) + 1, vectors_of(templates, idf)


def _notice(text: Column, is_file: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(CUES))
    return F.when(is_file, text).otherwise(F.array_join(lines, "\n"))


def _counted(text: Column, column: str, steps: DataFrame) -> DataFrame:
    """``steps`` with the struct ``column``: the distinct terms (kinds) of a text and their times."""
    words = F.transform(F.split(text, TERM), lambda w: F.btrim(w, F.lit(".-")))
    steps = steps.withColumn("_words", F.sort_array(F.filter(words, lambda w: w != "")))
    steps = steps.withColumn("_distinct", F.array_distinct("_words"))
    steps = steps.withColumn("_starts", F.transform("_distinct", lambda w: F.array_position("_words", w)))
    starts = F.col("_starts")
    times = F.transform(starts, lambda p, i: F.coalesce(F.get(starts, i + 1), F.size("_words") + 1) - p)
    return steps.withColumn(column, F.struct(F.col("_distinct").alias("kinds"), times.alias("times"))).drop(
        "_words", "_distinct", "_starts"
    )


def noticed(files: DataFrame) -> DataFrame:
    """``files`` (_path, _text and others) with _is_file and the terms of their notices and lines with a cue."""
    name = F.element_at(F.split(F.coalesce("_path", F.lit("")), "/"), -1)
    text = F.coalesce("_text", F.lit(""))
    steps = files.withColumn("_is_file", name.rlike(LICENSE_FILE))
    steps = steps.withColumn("_lower", F.lower(_notice(text, F.col("_is_file"))))
    steps = _counted(F.col("_lower"), "_notice", steps)
    cues = F.when(F.col("_is_file"), F.lower(_notice(text, F.lit(False)))).otherwise("")
    return _counted(cues, "_cues", steps).drop("_lower")


def frequencies(notices: DataFrame, templates: Mapping[str, Sequence[str]]) -> tuple[dict[str, float], float]:
    """Inverse document frequencies of template terms over all notices, and of the mean other word."""
    vocabulary = sorted({t for texts in templates.values() for text in texts for t in _terms(text)})
    total = notices.where(F.size("_notice.kinds") > 0).count()
    counts = notices.select(F.explode("_notice.kinds").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    known = notices.sparkSession.createDataFrame([(t,) for t in vocabulary], "known string")
    found = counts.join(F.broadcast(known), counts["term"] == known["known"], "left").groupBy("known").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("terms")
    ).collect()
    inverse = lambda n: math.log((1 + total) / (1 + n)) + 1
    seen = {r["known"]: r["n"] for r in found}
    others = next((r["n"] / r["terms"] for r in found if r["known"] is None), 0)
    return {t: inverse(seen.get(t, 0)) for t in vocabulary}, inverse(others)


def _table(idf: Mapping[str, float], vectors: Vectors, names: Sequence[tuple[str, int]]) -> Column:
    """Terms in ``PARTS`` maps by checksum: weight, then the vectors it is in and its value there."""
    inside: dict[str, list[str]] = {t: [] for t in idf}
    for k, name in enumerate(names):
        for t, v in vectors[name].items():
            inside[t].append(f'{{"k":{k},"v":{v!r}}}')
    parts: list[list[str]] = [[] for _ in range(PARTS)]
    for t in sorted(idf):
        entry = f'"{t}":{{"idf":{idf[t]!r},"at":[{",".join(inside[t])}]}}'
        parts[zlib.crc32(t.encode()) % PARTS].append(entry)
    text = "[" + ",".join("{" + ",".join(part) + "}" for part in parts) + "]"
    return F.from_json(F.lit(text), "array<map<string, struct<idf: double, at: array<struct<k: int, v: double>>>>>")


def _best(bag: str, vectors: Vectors, idf: Mapping[str, float], unseen: float, least: float) -> Column:
    """The struct (score, rank, name) of the template of the largest cosine."""
    names = sorted(vectors)
    table = _table(idf, vectors, names)
    large = F.array(*[F.lit(math.ceil(least * len(vectors[n]))) for n in names])
    found = F.zip_with(
        f"{bag}.kinds", f"{bag}.times",
        lambda w, n: F.struct(
            n.cast("double").alias("n"),
            F.element_at(F.get(table, F.pmod(F.crc32(w.cast("binary")), F.lit(PARTS)).cast("int")), w).alias("e"),
        ),
    )
    values = F.transform(
        found,
        lambda f: F.struct((f["n"] * F.coalesce(f["e"]["idf"], F.lit(unseen))).alias("v"), f["e"]["at"].alias("at")),
    )
    squares = F.aggregate(values, F.lit(0.0), lambda a, f: a + f["v"] * f["v"])
    products = F.flatten(F.transform(
        F.filter(values, lambda f: f["at"].isNotNull()),
        lambda f: F.transform(f["at"], lambda e: F.struct(e["k"].alias("k"), (f["v"] * e["v"]).alias("x"))),
    ))
    named = F.array(*[F.lit(n[0]) for n in names])

    def scores(two: Column) -> Column:
        def score(k: Column) -> Column:
            mine = F.filter(two["x"], lambda p: p["k"] == k)
            dot = F.aggregate(mine, F.lit(0.0), lambda a, p: a + p["x"])
            # equal cosines: the first name wins, as its rank is the smallest
            found = F.struct(
                F.round(dot / F.sqrt(two["s"]), 6).alias("score"), (-k).alias("rank"), F.get(named, k).alias("name")
            )
            return F.when(F.size(f"{bag}.kinds") >= F.get(large, k), found)

        return F.array_max(F.transform(F.sequence(F.lit(0), F.lit(len(names) - 1)), score))

    # computed once a row, then used for every template
    return F.get(F.transform(F.array(F.struct(squares.alias("s"), products.alias("x"))), scores), 0)


def judged(
    notices: DataFrame, templates: Mapping[str, Sequence[str]], threshold: float, idf: Mapping[str, float], unseen: float,
    least: float = LEAST,
) -> DataFrame:
    """``notices`` with _license and _score in place of the terms, and whether they have _words.

    A licence file without a licence by its whole text is judged as any other file is.
    """
    cut = {name: [_with_cue(text) for text in texts] for name, texts in templates.items()}
    whole, parts = vectors_of(templates, idf), vectors_of(cut, idf)
    some = lambda bag, best: F.when(F.size(f"{bag}.kinds") > 0, best)
    kept = [c for c in notices.columns if c not in ("_notice", "_cues")]
    steps = notices.withColumn(
        "_whole", F.when(F.col("_is_file"), some("_notice", _best("_notice", whole, idf, unseen, least)))
    )
    lost = F.col("_is_file") & ~F.coalesce(F.col("_whole.score") >= threshold, F.lit(False))
    steps = steps.withColumn(
        "_part",
        F.when(lost, some("_cues", _best("_cues", parts, idf, unseen, least))).when(
            ~F.col("_is_file"), some("_notice", _best("_notice", parts, idf, unseen, least))
        ),
    )
    steps = steps.select(
        *kept, (F.size("_notice.kinds") > 0).alias("_words"), F.array_max(F.array("_whole", "_part")).alias("_best")
    )
    return steps.select(
        *kept, "_words",
        F.when(F.col("_best.score") >= threshold, F.col("_best.name")).alias("_license"),
        F.col("_best.score").alias("_score"),
    )


def scored(files: DataFrame, templates: Mapping[str, Sequence[str]], threshold: float) -> DataFrame:
    """``files`` (_path, _text and others) with _license and _score, by frequencies among the templates; all of these count."""
    idf, unseen, _ = weights(templates)
    return judged(noticed(files), templates, threshold, idf, unseen, 0.0).drop("_words")


def _directory(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan_licenses(
    files: DataFrame,
    *,
    path: str = "path",
    text: str = "text",
    carry: tuple[str, ...] = (),
    templates: Mapping[str, Sequence[str]] = TEMPLATES,
    threshold: float = 0.35,
) -> DataFrame:
    """A row per input row: ``carry``, path, own_license, own_score, license, origin, from_dir.

    ``origin``: file (a licence file), header, inherited or none; ``from_dir``: where an
    inherited licence comes from.
    """
    source = files.select(
        F.struct(F.lit(0).alias("_none"), *carry).alias("_more"), F.col(path).alias("_path"), F.col(text).alias("_text")
    )
    notices = written(noticed(source).drop("_text"), "notices")
    own = judged(notices, templates, threshold, *frequencies(notices, templates))
    own = written(own.withColumn("_dir", _directory(F.col("_path"))), "licences")
    covered = own.where("_is_file and _words and _path is not null").groupBy("_dir").agg(
        F.min(F.when(
            F.col("_license").isNotNull(),
            F.struct((-F.col("_score")).alias("order"), F.col("_license").alias("license")),
        )).alias("_given")
    ).select(F.col("_dir").alias("_above"), F.coalesce("_given.license", F.lit(UNKNOWN)).alias("_given"))
    parts = F.split("_dir", "/")
    above = F.transform(
        F.sequence(F.lit(0), F.size(parts)),
        lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"),
    )
    nearest = (
        own.where("_license is null and _path is not null").select("_dir").distinct()
        .select("_dir", F.explode(F.array_distinct(above)).alias("_above"))
        .join(covered, "_above")
        .groupBy("_dir").agg(
            F.max_by(F.struct("_above", "_given"), F.length("_above")).alias("_near"),
            F.bool_or(F.col("_given") != UNKNOWN).alias("_any"),
        )
        # an unknown licence file with no known one above takes nothing from anybody
        .where("_any").drop("_any")
    )
    joined = own.join(nearest, "_dir", "left")
    mine = F.col("_license").isNotNull()
    heir = ~mine & F.col("_near").isNotNull()
    return joined.select(
        *[F.col("_more")[c].alias(c) for c in carry],
        F.col("_path").alias("path"),
        F.col("_license").alias("own_license"), F.col("_score").alias("own_score"),
        F.coalesce("_license", "_near._given").alias("license"),
        F.when(mine & F.col("_is_file"), "file").when(mine, "header").when(heir, "inherited").otherwise("none").alias("origin"),
        F.when(heir, F.col("_near._above")).alias("from_dir"),
    )


def document_paths(docs: DataFrame) -> DataFrame:
    """doc_id, path, text: documents as files of a tree, source / thousands / hundreds.

    A document whose lines on licences make up a fifth of it is its directory's licence file;
    one in three of them lies at the level of its thousand, one in three at that of its source.
    """
    text = F.coalesce("text", F.lit(""))
    cues = F.filter(F.split(text, "\n"), lambda line: line.rlike(CUES))
    is_file = text.rlike(CUES) & (5 * F.length(F.array_join(cues, "\n")) >= F.length(text))
    source = F.coalesce("source", F.lit("unknown"))
    level = F.pmod("doc_id", F.lit(3))
    thousand, hundred = (F.floor(F.col("doc_id") / n).cast("string") for n in (1000, 100))
    folder = F.when(F.col("_file") & (level == 0), source).when(
        F.col("_file") & (level == 1), F.concat_ws("/", source, thousand)
    ).otherwise(F.concat_ws("/", source, thousand, hundred))
    name = F.concat(F.when(F.col("_file"), "LICENSE-").otherwise("text-"), F.col("doc_id").cast("string"))
    return docs.withColumn("_file", is_file).select("doc_id", F.concat_ws("/", folder, name).alias("path"), "text")
