"""Which texts hold passages of reference texts, by winnowed fingerprints and an inverted index of the references.

A text's fingerprints are the smallest digests of every WINDOW neighbouring WIDTH-word shingles. Each window of a
reference that stands in a text unchanged is a window of the text, so an exact copy holds all of the reference's
fingerprints wherever it stands, and an edited one holds those of its unchanged stretches of WIDTH + WINDOW - 1 words.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltmill.functions.licenses import any_license_file
from siltmill.functions.text import once

WIDTH, WINDOW = 3, 3
#: The part of a reference's fingerprints that a text must hold.
LEAST = 0.5
#: Fingerprints of all references up to which the index is broadcast; beyond, it is joined, with the same result.
MOST_BROADCAST = 500_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words: runs of digits, letters and characters beyond ASCII.
WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(WORDS), F.lit(0))


def fingerprints(text: Column, width: int = WIDTH, window: int = WINDOW) -> Column:
    """Distinct fingerprints of a whole text, 16 hexadecimal digits each. Fewer words than a shingle make one, fewer
    shingles than a window have one smallest; a text without words (null, empty) has none."""
    mark = lambda w: F.left(F.md5(w.cast("binary")), F.lit(16))
    shingle = lambda w: lambda x, i: mark(F.concat_ws(" ", x, *[F.get(w, i + k) for k in range(1, width)]))
    cut = lambda a, n: F.slice(a, F.lit(1), F.greatest(F.size(a) - n + 1, F.lit(1)))
    smallest = lambda g: lambda x, i: F.least(x, *[F.get(g, i + k) for k in range(1, window)])  # noqa: E731  least() passes over nulls
    shingles = once(words(text), lambda w: F.transform(cut(w, width), shingle(w)))
    return F.array_distinct(once(shingles, lambda g: F.transform(cut(g, window), smallest(g))))


def held_passages(texts: DataFrame, references: DataFrame, id_col: str, text_col: str, ref_col: str, ref_text_col: str, least: float = LEAST, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """id, reference, shared (fingerprints of the reference in the texts of the id), of (all of the reference): each pair
    with shared / of >= least.

    Rows of one id are one text, a null id is an id too; rows of one reference are its parts, which count together. Texts
    and references without words hold nothing. Only fingerprints that are the index's leave a task while the index is
    broadcast; a passage that very many texts hold costs a row each.
    """
    prints = references.select(F.col(ref_col).alias("__ref"), F.explode(fingerprints(F.col(ref_text_col))).alias("__print")).distinct()
    sizes = prints.groupBy("__ref").agg(F.count(F.lit(1)).alias("of"))
    index = prints.join(sizes, "__ref")
    if prints.count() <= most_broadcast:
        index = F.broadcast(index)
    found = texts.select(F.col(id_col).alias("__id"), F.explode(fingerprints(F.col(text_col))).alias("__print"))
    met = found.join(index, "__print").groupBy("__id", "__ref", "of").agg(F.count_distinct("__print").alias("shared"))
    return met.filter(F.col("shared") >= F.lit(least) * F.col("of")).select(F.col("__id").alias(id_col), F.col("__ref").alias(ref_col), "shared", "of")


def file_licenses(files: DataFrame, references: DataFrame, id_col: str = "blob_id", names_col: str = "filenames", text_col: str = "content", least: float = LEAST) -> DataFrame:
    """id, licenses: the sorted references (columns license, text) whose passages a license file holds, by any of its names;
    empty for other files and for files without one. An id is one row; a null text or list of names has no license."""
    named = files.filter(F.coalesce(any_license_file(names_col), F.lit(False)))
    marked = references.withColumn("__mark", F.md5(F.col("text").cast("binary")))  # a license may have several texts
    held = held_passages(named, marked, id_col, text_col, "__mark", "text", least).join(marked.select("__mark", "license"), "__mark")
    lists = held.groupBy(F.col(id_col).alias("__id")).agg(F.sort_array(F.collect_set("license")).alias("licenses"))
    ids = files.select(id_col).distinct()
    none = F.array().cast("array<string>")
    return ids.join(lists, F.col(id_col).eqNullSafe(F.col("__id")), "left").select(id_col, F.coalesce("licenses", none).alias("licenses"))


# The notices by which files say their license, and the opening of some licenses.
NOTICES: Sequence[tuple[str, str]] = (
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
)
LICENSE_TEXTS: Sequence[tuple[str, str]] = (
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
)
# End of fixed values.
