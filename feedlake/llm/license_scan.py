"""License notices in texts, by MinHash bands over overlapping windows.  DataFrame functions only.

Texts and templates become sequences of 3-word shingles.  Windows of a text overlap: their
lengths are powers of two, each starts a quarter of its length after the one before, and a
template is looked for in windows so long that one of them holds it wholly.  A window and a
template that share a MinHash band are compared: the template is found where the window
contains at least ``LEAST_CONTAINMENT`` of its shingles.

``bands`` chooses the banding so that a window which contains enough of a template fails to
share a band with a chance below ``MISSED``.  Only windows with at least one shingle of some
template are hashed; any other has a containment of zero.

Texts are scanned once and not shuffled; what moves are the windows around shingles of
templates.  Templates are taken in blocks of at most ``BLOCK_SHINGLES`` shingles, so what is
broadcast has a known size.  A text or a line that a third of the documents share gives each
task its share of windows.

Defined results: null and empty texts contain no notice; a template of fewer than three words
is one shingle, as is such a text; a template without words is found nowhere; templates are
named by ``license``, rows of one name being versions of it; repeated rows are scanned one by
one, each with its own rows in the result; other columns of the documents are not kept.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm.frames import once, quoted

SHINGLE_WORDS = 3
LEAST_CONTAINMENT = 0.8
HASHES = 32
MISSED = 1e-4
BLOCK_SHINGLES = 4_000

# Short notices and the licenses that they name.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This program is free software under the GNU General Public License, version 2.",
    "LGPL-3.0": "Licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "Licensed under the GNU Affero General Public License, version 3.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "All rights reserved": "All rights reserved.",
}

# Passages of the license texts themselves and of the headers that files carry.
# The headers of the GNU licenses differ between versions by one number, so they name none.
TEXTS = {
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of the Software, and to permit persons to whom the Software is furnished to do so""",
    "GPL": "the terms of the GNU General Public License as published by",
    "LGPL": "the terms of the GNU Lesser General Public License as published by",
    "AGPL": "the terms of the GNU Affero General Public License as published by",
    "BSD-2-Clause": """Redistributions of source code must retain the above copyright notice, this list of conditions
        and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with
        the distribution.""",
    "BSD-3-Clause": """may be used to endorse or promote products derived from this software without specific prior
        written permission""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "MPL-2.0": """If a copy of the MPL was not distributed with this file, You can obtain one at""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the
        software and accompanying documentation covered by this license""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the
        authors be held liable for any damages arising from the use of this software.""",
    "CC0-1.0": """the person associating CC0 with this deed has dedicated the work to the public domain by waiving all
        rights to the work worldwide under copyright law""",
    "Unlicense": """Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in
        source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.""",
}


def notices(spark: SparkSession) -> DataFrame:
    """The notices and texts of this module as templates, versions of a license under its name."""
    return spark.createDataFrame([*NOTICES.items(), *TEXTS.items()], "license string, text string")


def bands(least_jaccard: float, hashes: int = HASHES, missed: float = MISSED) -> tuple[int, int]:
    """Number of bands and rows per band, the most selective that keep the promise."""
    for rows in range(hashes, 0, -1):
        count = hashes // rows
        if (1 - least_jaccard**rows) ** count <= missed:
            return count, rows
    raise ValueError(f"{hashes} hashes cannot find a similarity of {least_jaccard}")


def window_length(shingles: int) -> int:
    """Length of windows of which one holds any run of ``shingles`` wholly: W - W/4 + 1 >= shingles."""
    length = 1
    while length - _stride(length) + 1 < shingles:
        length *= 2
    return length


def _stride(length: int) -> int:
    return max(1, length // 4)


def _shingled(frame: DataFrame, text: str, *keep: str) -> DataFrame:
    """``keep`` and the shingle hashes ``h`` of each text, in order."""
    words = f"array_remove(split(lower(coalesce({quoted(text)}, '')), '[^\\\\p{{L}}\\\\p{{N}}]+', -1), '')"
    n = SHINGLE_WORDS
    runs = ", ".join(f"get(w, i + {k})" for k in range(n))
    hashed = (
        f"CASE WHEN size(w) >= {n} THEN transform(sequence(0, size(w) - {n}), i -> xxhash64({runs})) "
        "WHEN size(w) > 0 THEN array(xxhash64(array_join(w, ' '))) ELSE cast(array() AS array<bigint>) END"
    )
    parted = frame.select(*keep, F.expr(once(words)).alias("w"))
    return parted.select(*keep, F.expr(once(hashed)).alias("h"))


def _banded(hashes: str, count: int, rows: int) -> str:
    """SQL: (band, hash of its MinHashes) of an array of shingle hashes."""
    least = [f"array_min(transform({hashes}, x -> xxhash64(x, {i})))" for i in range(count * rows)]
    return "array(" + ", ".join(
        f"struct({b} AS band, xxhash64({', '.join(least[b * rows : (b + 1) * rows])}) AS value)" for b in range(count)
    ) + ")"


def _template_blocks(templates: DataFrame, name: str, text: str, block_shingles: int) -> Iterator[list[tuple]]:
    """Name, distinct shingles, window length and number of each template, block by block."""
    named = F.col(quoted(name)).cast("string").alias("license")
    shingled = _shingled(templates.select(named, F.col(quoted(text)).alias("t")), "t", "license")
    block, size, number = [], 0, 0
    for row in shingled.select("license", F.array_distinct("h").alias("s"), F.size("h").alias("n")).toLocalIterator():
        if not row["n"]:
            continue
        if block and size + row["n"] > block_shingles:
            yield block
            block, size = [], 0
        block.append((number, row["license"], row["s"], window_length(row["n"])))
        size += row["n"]
        number += 1
    if block:
        yield block


def found_notices(
    docs: DataFrame,
    templates: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    name: str = "license",
    template_text: str = "text",
    least_containment: float = LEAST_CONTAINMENT,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """One row per document and license found: ``doc_id``, ``license``, the largest
    ``containment``, ``first_word`` of the first window that has it, and ``n_windows`` found."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], "doc_id long, license string, containment double, first_word long, n_windows long")
    keyed = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(quoted(doc_id)).cast("long").alias("doc_id"),
        F.col(quoted(text)).alias("text"),
    )
    for block in _template_blocks(templates, name, template_text, block_shingles):
        out = out.unionByName(_found_in_block(keyed, block, least_containment))
    return out


def _found_in_block(docs: DataFrame, block: list[tuple], least_containment: float) -> DataFrame:
    spark = docs.sparkSession
    known = spark.createDataFrame(block, "template int, license string, shingles array<long>, length int")
    # A window may be all template but for a quarter of its length, twice over.
    least_jaccard = min(least_containment * len(s) / (length + (1 - least_containment) * len(s)) for _, _, s, length in block)
    count, rows = bands(least_jaccard)
    lengths = sorted({length for *_, length in block})
    known_shingles = sorted({x for _, _, shingles, _ in block for x in shingles})
    wanted = "array(" + ", ".join(f"cast('{x}' AS bigint)" for x in known_shingles) + ")"
    # Within the row: shingles of templates, where they stand, and the windows around them.
    starts = ", ".join(
        f"transform(sequence(greatest(0, (p - {w - 1} + {_stride(w) - 1}) div {_stride(w)} * {_stride(w)}), "
        f"cast(p AS bigint), {_stride(w)}L), s -> struct({w} AS length, s AS start))"
        for w in lengths
    )
    at = "filter(transform(h, (x, i) -> if(array_contains(v, x), i, NULL)), p -> p IS NOT NULL)"
    windows = f"array_distinct(flatten(transform(at, p -> concat({starts}))))"
    pieces = """transform(windows, w -> struct(
        w.length, w.start, slice(h, cast(w.start AS int) + 1, w.length) AS piece))"""
    placed = (
        _shingled(docs, "text", "row", "doc_id")
        .select("row", "doc_id", "h", F.expr(once(f"array_intersect(h, {wanted})")).alias("v"))
        .filter("size(v) > 0")
        .select("row", "doc_id", "h", F.expr(once(at)).alias("at"))
        .select("row", "doc_id", "h", F.expr(once(windows)).alias("windows"))
        .select("row", "doc_id", F.expr(once(pieces)).alias("pieces"))
        .select("row", "doc_id", F.explode("pieces").alias("w"))
        .select("row", "doc_id", "w.*")
    )
    banded = F.broadcast(
        known.select("template", "length", F.explode(F.expr(_banded("shingles", count, rows))).alias("b")).select(
            "template", "length", "b.band", "b.value"
        )
    )
    retrieved = (
        placed.select("*", F.explode(F.expr(_banded("piece", count, rows))).alias("b"))
        .select("row", "doc_id", "length", "start", "piece", "b.band", "b.value")
        .join(banded, ["length", "band", "value"])
        .dropDuplicates(["row", "length", "start", "template"])
        .select("row", "doc_id", "start", "piece", "template")
    )
    share = F.expr("size(array_intersect(piece, shingles)) / size(shingles)")
    verified = (
        retrieved.join(F.broadcast(known.drop("length")), "template")
        .select("row", "doc_id", "license", "start", share.alias("containment"))
        .filter(F.col("containment") >= least_containment)
    )
    return verified.groupBy("row", "doc_id", "license").agg(
        F.max("containment").alias("containment"),
        F.min("start").cast("long").alias("first_word"),
        F.count(F.lit(1)).alias("n_windows"),
    ).drop("row")
