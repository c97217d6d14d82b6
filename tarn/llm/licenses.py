"""License scan: sparse TF-IDF cosine to templates, then inheritance along directories.

Every line of every file is compared with the templates, and every file as a whole
with the full license texts. Terms are weighted by how rare they are among all lines
of all files. Only lines and files that hold enough of a template's or full text's
squared weight can reach the least cosine; only they are kept for the comparison.

A file that is near a full text, or in which lines near a template hold most of the
words, is a license file and speaks for its directory. A file without a license of its own inherits that of its nearest
ancestor directory that has one. Paths are resolved once per directory, by a join
of each directory's ancestors with the directories that have a license.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarn.llm.common import column, let, small_join, text_of, words
from tarn.session import stage

# fixed values: license and a text that states it
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0."),
)
# words that say nothing about a license
STOP_WORDS = (
    "a an and any are as at be by copy for form forms free from in is of on or person source subject terms the this to under use with "
    "without work"
).split()
TERM = r"[a-z0-9]+(?:[.\-][a-z0-9]+)*"
LEAST_COSINE = 0.6
LEAST_SHARE = 0.5  # of a license file's words


def _terms_of(text: str) -> list[str]:
    return [t for t in re.findall(TERM, text.lower()) if t not in STOP_WORDS]


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def full_texts() -> tuple[tuple[str, str], ...]:
    """License and its full text; read on the driver."""
    folder = Path(__file__).resolve().parent / "license_texts"
    return tuple((file.stem, file.read_text(encoding="utf-8")) for file in sorted(folder.glob("*.txt")))


def _all_terms(text: Column) -> Column:
    return F.regexp_extract_all(_lower(text), F.lit(TERM), F.lit(0))


def _frequencies(files: DataFrame) -> DataFrame:
    """In how many lines of all files each term is: ``term`` and ``n``; counted before the shuffle."""
    lines = files.select(F.explode(F.split("_text", "\n")).alias("line"))
    terms = lines.select(F.explode(F.array_distinct(_all_terms(F.col("line")))).alias("term"))
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def _vectors(texts, idf: dict[str, float]) -> list[tuple[str, dict[str, float]]]:
    """License and unit vector of each text."""
    out = []
    for name, text in texts:
        vector = {t: n * idf[t] for t, n in sorted(Counter(_terms_of(text)).items())}
        size = math.sqrt(sum(v * v for v in vector.values()))
        out.append((name, {t: v / size for t, v in vector.items()}))
    return out


def _reaches(vectors, least_cosine: float):
    """Whether an array of terms can have the least cosine with any of the vectors.

    A cosine is at most the root of the squared weight of those terms of the other unit
    vector that are held.
    """
    least = least_cosine**2 - 1e-9
    masses = [{t: v * v for t, v in vector.items()} for _, vector in vectors]
    # one literal each, which the optimizer splits once; a literal per term takes long to plan
    known = F.split(F.lit(" ".join(sorted({t for mass in masses for t in mass}))), " ")
    fewest = []
    for mass in masses:
        total, n = 0.0, 0
        for m in sorted(mass.values(), reverse=True):
            if total >= least:
                break
            total, n = total + m, n + 1
        fewest.append(n)

    def near(held: Column) -> Column:
        enough = F.lit(False)
        for mass, n in zip(masses, fewest):
            numbers = F.split(F.lit(" ".join(repr(m) for m in mass.values())), " ").cast("array<double>")
            along = F.map_from_arrays(F.split(F.lit(" ".join(mass)), " "), numbers)
            parts = F.transform(held, lambda t: F.coalesce(F.try_element_at(along, t), F.lit(0.0)))  # noqa: B023
            total = F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)
            enough = enough | ((F.size(held) >= n) & (total >= F.lit(least)))
        return (F.size(held) >= min(fewest)) & enough

    return lambda terms: let(F.array_intersect(terms, known), near)


def _whole(text: Column, vectors, least_cosine: float) -> Column:
    """The terms of a file that can reach the least cosine with a full text, else null."""
    if not vectors:
        return F.lit(None).cast("array<string>")
    reaches = _reaches(vectors, least_cosine)
    return let(_all_terms(text), lambda terms: F.when(reaches(terms), terms))


def _hits(files: DataFrame, vocabulary: list[str], whole: Column, near_line) -> DataFrame:
    """Per file: _row, _n_words and _units, its lines that can be near a template, and as line -1 the file itself."""
    known = F.array(*[F.lit(t) for t in vocabulary])
    stop = F.array(*[F.lit(t) for t in STOP_WORDS])

    def telling(terms: Column) -> Column:
        return F.filter(terms, lambda t: ~F.array_contains(stop, t))

    def line_terms(line: Column, number: Column) -> Column:
        return F.struct(number.alias("line"), telling(_all_terms(line)).alias("terms"), F.size(words(line)).cast("long").alias("n_words"))

    # most texts have none of the terms, which one pass of a pattern tells
    any_term = F.col("_text").rlike(r"(?i)(?<![a-z0-9])(?:" + "|".join(t.replace(".", r"\.") for t in vocabulary) + r")(?![a-z0-9])")
    none = F.array().cast("array<struct<line:int,terms:array<string>,n_words:bigint>>")
    lines = F.filter(
        F.transform(F.split("_text", "\n"), line_terms),
        lambda x: F.arrays_overlap(x.getField("terms"), known) & near_line(x.getField("terms")),
    )

    def as_unit(terms: Column) -> Column:
        return F.when(terms.isNull(), none).otherwise(F.array(F.struct(F.lit(-1).alias("line"), telling(terms).alias("terms"), F.lit(0).cast("long").alias("n_words"))))

    return files.select(
        F.monotonically_increasing_id().alias("_row"), "_id", "_path", F.size(words(F.col("_text"))).cast("long").alias("_n_words"),
        F.concat(F.when(any_term, lines).otherwise(none), let(whole, as_unit)).alias("_units"),
    )


def _best_of_units(scanned: DataFrame, frequencies: DataFrame, n_lines: int, of_lines, of_files) -> DataFrame:
    """Per _row and line: n_words and the best template, as a struct of cosine and license."""
    units = scanned.select("_row", F.explode("_units").alias("_unit")).select("_row", "_unit.line", "_unit.n_words", F.explode("_unit.terms").alias("term"))
    terms = stage(units.groupBy("_row", "line", "n_words", "term").agg(F.count(F.lit(1)).alias("times")), "terms")
    # the weights of the terms that are asked for
    asked = frequencies.join(terms.select("term").distinct(), "term")
    weight = F.log(F.lit(1.0 + n_lines) / (F.col("n") + 1)) + 1
    every = [*of_lines, *of_files]
    held = sorted({t for _, vector in every for t in vector})
    rows = [(t, [vector.get(t, 0.0) for _, vector in every]) for t in held]
    along = scanned.sparkSession.createDataFrame(rows, "term string, along array<double>")
    weights = stage(asked.join(F.broadcast(along), "term", "left").select("term", weight.alias("weight"), "along"), "weights")
    value = F.col("times") * F.col("weight")
    products = [F.sum(value * F.coalesce(F.get("along", F.lit(k)), F.lit(0.0))).alias(f"_{k}") for k in range(len(every))]
    scored = small_join(terms, weights, ["term"]).groupBy("_row", "line", "n_words").agg(F.sqrt(F.sum(value * value)).alias("norm"), *products)

    def best(first: int, vectors) -> Column:
        # of equal cosines the last license by name
        return F.array_max(
            F.array(*[F.struct(F.round(F.col(f"_{first + k}") / F.col("norm"), 6).alias("cosine"), F.lit(name).alias("license")) for k, (name, _) in enumerate(vectors)])
        )

    chosen = best(0, of_lines)
    if of_files:
        chosen = F.when(F.col("line") < 0, best(len(of_lines), of_files)).otherwise(chosen)
    return scored.select("_row", "line", "n_words", chosen.alias("best"))


def _ancestors(directory: Column) -> Column:
    """The directory itself and all above it, the root ("") included."""
    names = F.filter(F.split(directory, "/"), lambda name: name != "")
    return F.when(directory == "", F.array(F.lit(""))).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(names)), lambda n: F.array_join(F.slice(names, F.lit(1), n), "/"))
    )


def scan_licenses(
    files: DataFrame, id: str, path: str, text: str, templates=TEMPLATES, least_cosine: float = LEAST_COSINE,
    least_share: float = LEAST_SHARE, texts=None,
) -> DataFrame:
    """One row per file: id, path, license, cosine, origin and directory.

    ``origin`` is "file" (a license file), "header" (a line of the file) or
    "inherited" (then ``directory`` has the license); all are null without a license.
    A file takes its full text, else its best line; a directory the license that most of its license
    files state, the first by name of equally many. Null text is empty; a null path
    lies in no directory, so it inherits nothing. Paths are compared without empty
    parts. Other columns are not read.
    """
    texts = full_texts() if texts is None else texts
    vocabulary = sorted({t for _, template in templates for t in _terms_of(template)})
    asked = sorted({t for _, whole in texts for t in _terms_of(whole)} | set(vocabulary))
    picked = files.select(column(id).alias("_id"), column(path).alias("_path"), text_of(text).alias("_text"))
    frequencies = stage(_frequencies(picked), "frequencies")
    n_lines = picked.agg(F.sum(F.size(F.split("_text", "\n")).cast("long"))).first()[0] or 0
    # one row per term of the templates and texts
    held = {r["term"]: r["n"] for r in frequencies.filter(F.col("term").isin(asked)).collect()}
    idf = {t: math.log((1 + n_lines) / (1 + held.get(t, 0))) + 1 for t in asked}
    of_lines, of_files = _vectors(templates, idf), _vectors(texts, idf)
    scanned = stage(_hits(picked, vocabulary, _whole(F.col("_text"), of_files, least_cosine), _reaches(of_lines, least_cosine)), "lines")

    best = _best_of_units(scanned, frequencies, n_lines, of_lines, of_files).filter(F.col("best.cosine") >= least_cosine)
    is_line = F.col("line") >= 0
    best = best.groupBy("_row").agg(
        F.max(F.when(is_line, F.col("best"))).alias("_line"), F.sum(F.when(is_line, F.col("n_words"))).alias("_stated"),
        F.max(F.when(~is_line, F.col("best"))).alias("_file"),
    )
    found = small_join(scanned.drop("_units"), stage(best, "best"), ["_row"])
    parts = F.filter(F.split("_path", "/"), lambda name: name != "")
    directory = F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))), "/")
    found = found.select(
        "_id", "_path", directory.alias("_directory"), F.coalesce("_file", "_line").alias("_best"),
        (F.col("_file").isNotNull() | F.coalesce(F.col("_stated") / F.col("_n_words") >= least_share, F.lit(False))).alias("_is_file"),
    )
    found = stage(found, "licenses")

    votes = found.filter("_is_file and _best is not null and _directory is not null").groupBy("_directory", F.col("_best.license").alias("_license"))
    votes = votes.agg(F.count(F.lit(1)).alias("_n"))
    speaks = votes.groupBy("_directory").agg(F.min(F.struct(-F.col("_n"), F.col("_license"))).getField("_license").alias("_license"))
    # each directory once, with its ancestors; a path has few parts
    directories = found.filter("_directory is not null").select("_directory").distinct()
    above = directories.select("_directory", F.posexplode(_ancestors(F.col("_directory"))).alias("_depth", "_ancestor"))
    named = above.join(speaks.withColumnRenamed("_directory", "_ancestor"), "_ancestor")
    nearest = named.groupBy("_directory").agg(F.max(F.struct("_depth", "_ancestor", "_license")).alias("_near"))
    judged = small_join(found, stage(nearest, "nearest"), ["_directory"])
    own = F.col("_best").isNotNull()
    return judged.select(
        F.col("_id").alias(id), F.col("_path").alias(path),
        F.when(own, F.col("_best.license")).otherwise(F.col("_near._license")).alias("license"),
        F.when(own, F.col("_best.cosine")).alias("cosine"),
        F.when(own & F.col("_is_file"), "file").when(own, "header").when(F.col("_near").isNotNull(), "inherited").alias("origin"),
        F.when(~own, F.col("_near._ancestor")).alias("directory"),
    )
