"""License detection: sparse TF-IDF cosine to templates, inheritance by directory.

Units are the whole file, its lines, its paragraphs (between lines without a
letter or digit) and its runs of comment lines; so a notice is found on one line,
wrapped over many above any amount of source, or as a file of its own. A unit is
a sparse vector of its terms, weighted by their frequency and by how rare they are among the
templates (a term of no template is as rare as can be). The cosine to each
template is a join on terms. The best unit decides on the license of a file.

A file without a license of its own takes that of the license file in its
nearest ancestor directory: directories are joined with the license files
level by level upwards.

Everything here is DataFrame code. Stop words have no weight. A unit that shares
no other term with any template has cosine 0 with all of them, and one with
many other terms cannot reach the threshold; both are dropped before their
terms are counted, without loss.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from incidentia.llm.common import fresh, spread_join
from incidentia.session import written

THRESHOLD = 0.6

# License texts and notices as projects write them.
_BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met: 1. Redistributions of source code "
    "must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other "
    "materials provided with the distribution. "
)
_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY "
    "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
    "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
    "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license. See the LICENSE file in the project root."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in "
        "all copies or substantial portions of the Software.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation; either "
        "version 2 of the License, or (at your option) any later version.",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
    ),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license."),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If "
        "a copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation; "
        "either version 2.1 of the License, or (at your option) any later version.",
    ),
    (
        "LGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU Affero General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version.",
    ),
    ("GPL-2.0", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"),
    ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free "
        "to copy, modify, publish, use, compile, sell, or distribute this software, either in "
        "source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with "
        "or without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE "
        "AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
        "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER "
        "RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
        "PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "MIT",
        "MIT License. Permission is hereby granted, free of charge, to any person obtaining a "
        "copy of this software and associated documentation files (the \"Software\"), to deal in "
        "the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in "
        "all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", "
        "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN "
        "NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
        "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    ("BSD-2-Clause", _BSD_CONDITIONS + _BSD_DISCLAIMER),
    (
        "BSD-3-Clause",
        _BSD_CONDITIONS + "3. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission. " + _BSD_DISCLAIMER,
    ),
    *((name, f"SPDX-License-Identifier: {name}") for name in (
        "MIT", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "ISC",
        "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "CC-BY-4.0", "CC-BY-SA-4.0", "Unlicense",
    )),
)

# Words that are frequent in any English text.
STOP_WORDS = frozenset(
    "a all an and any are as at be by can do either for from has have if in is it its may no not "
    "of on one or other shall so such that the their there this to under use was were which who "
    "whom will with without you your".split()
)

_TERM = "[a-z0-9]+"
# A line that begins like a comment, and what lies between paragraphs.
COMMENT_LINE = r"^[ \t]*([*#;%]|//|/[*]|--|<!--)"
BETWEEN = r"\n[^a-zA-Z0-9]*\n"
_LICENSE_FILE = r"(?i)^(un)?licen[cs]e|^copying|^notice"


def _terms(text: str) -> list[str]:
    return re.findall(_TERM, text.lower())


class Weights:
    """Term weights of the templates."""

    def __init__(self, templates=TEMPLATES):
        counted = [Counter(t for t in _terms(text) if t not in STOP_WORDS) for _, text in templates]
        spread = Counter(term for terms in counted for term in terms)
        rarity = {t: math.log(1 + len(templates) / n) for t, n in spread.items()}
        self.rarest = math.log(1 + len(templates))
        self.terms = sorted(rarity)
        self.rows = []
        for number, ((license_, _), terms) in enumerate(zip(templates, counted)):
            weight = {t: n * rarity[t] for t, n in terms.items()}
            length = math.sqrt(sum(w * w for w in weight.values()))
            self.rows += [(t, number, license_, w / length, rarity[t]) for t, w in weight.items()]

    def table(self, spark) -> DataFrame:
        """One row per term and template: as many as the fixed templates have."""
        schema = "term string, template int, license string, weight double, rarity double"
        return spark.createDataFrame(self.rows, schema)


def _unit_terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_TERM), 0)


def _units(text: Column) -> Column:
    """The whole text, lines, paragraphs and runs of comment lines, each once."""
    lines = F.split(text, "\n")
    comments = F.transform(lines, lambda line: F.when(line.rlike(COMMENT_LINE), line).otherwise(""))
    runs = F.split(F.array_join(comments, "\n"), "\n\n+")
    return F.array_distinct(F.concat(F.array(text), lines, F.split(text, BETWEEN), runs))


def _within_reach(terms: Column, known: list[str], threshold: float) -> Column:
    """Can a unit with these terms reach the threshold?

    With weights K of its template terms and U of the others (sums of squares),
    no cosine is above sqrt(K / (K + U)). Each other term adds at least the
    square of the largest rarity to U, and K is at most that square times the
    square of the number of template terms, repeats included.
    """
    inside = F.size(F.filter(terms, lambda t: t.isin(known))).cast("double")
    weighty = [*known, *STOP_WORDS]
    outside = F.size(F.array_distinct(F.filter(terms, lambda t: ~t.isin(weighty))))
    least = (threshold - 1e-6) ** 2
    return (inside > 0) & (outside * least <= inside * inside * (1 - least))


def own_licenses(
    files: DataFrame,
    path: str = "path",
    text: str = "text",
    *,
    templates=TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(path, license, similarity) of the files with a license of their own.

    Of several units the most similar one counts; ties go to the smaller license
    name. Several rows with one path are one file.
    """
    spark, weights = files.sparkSession, Weights(templates)
    known, stop = weights.terms, sorted(STOP_WORDS)
    lower = F.lower(F.col(text).cast("string"))
    # Without a term of some template every cosine is 0.
    hit = F.exists(F.split(lower, "[^a-z0-9]+"), lambda t: t.isin(known))
    texts = files.select(F.col(path).cast("string").alias("path"), F.col(text).cast("string").alias("text"))
    near = texts.where(hit & F.col("path").isNotNull())
    units = (
        near.select("path", F.explode(_units(F.col("text"))).alias("unit"))
        .select("path", F.xxhash64("unit").alias("unit"), _unit_terms(F.col("unit")).alias("terms"))
        .where(_within_reach(F.col("terms"), known, threshold))
    )
    counted = (
        units.select("path", "unit", F.explode("terms").alias("term"))
        .where(~F.col("term").isin(stop))
        .groupBy("path", "unit", "term")
        .agg(F.count("*").alias("times"))
    )
    table = weights.table(spark)
    rarity = table.select("term", "rarity").distinct()
    weighted = counted.join(F.broadcast(rarity), "term", "left").withColumn(
        "own", F.col("times") * F.coalesce("rarity", F.lit(weights.rarest))
    )
    lengths = weighted.groupBy("path", "unit").agg(F.sqrt(F.sum(F.col("own") * F.col("own"))).alias("length"))
    products = (
        weighted.join(F.broadcast(table.drop("rarity")), "term")
        .groupBy("path", "unit", "template", "license")
        .agg(F.sum(F.col("own") * F.col("weight")).alias("product"))
    )
    close = products.join(lengths, ["path", "unit"]).select(
        "path", "license", F.round(F.col("product") / F.col("length"), 9).alias("similarity")
    )
    best = F.struct((-F.col("similarity")).alias("s"), "license")
    return (
        close.where(F.col("similarity") >= threshold)
        .groupBy("path")
        .agg(F.min(best).alias("best"))
        .select("path", F.col("best.license").alias("license"), (-F.col("best.s")).alias("similarity"))
    )


def _directory(path: Column) -> Column:
    """Path without its last part; the top directory is the empty text."""
    return F.when(path.contains("/"), F.regexp_replace(path, "/[^/]*$", "")).otherwise("")


def _ancestors(directory: Column) -> Column:
    """The directory itself, its parent and so on up to the top."""
    parts = F.split(directory, "/")
    above = F.transform(
        F.sequence(F.size(parts), F.lit(1), F.lit(-1)),
        lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"),
    )
    return F.when(directory == "", F.array(F.lit(""))).otherwise(F.concat(above, F.array(F.lit(""))))


def scan(
    files: DataFrame,
    path: str = "path",
    text: str = "text",
    *,
    templates=TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``files`` with license, similarity, origin (own, inherited or null) and
    license_path (the file that states it).

    Null and empty texts have no license of their own and may inherit one; a
    null path has neither. License files are those named LICENSE, COPYING,
    NOTICE or the like; of several in a directory the most similar one counts,
    then the smaller path. Repeated rows get the same result each. Columns of
    ``files`` with one of the four names are replaced.
    """
    own = written(
        own_licenses(files, path, text, templates=templates, threshold=threshold), "licenses"
    )
    name = F.regexp_extract("path", "[^/]*$", 0)
    stated = (
        own.where(name.rlike(_LICENSE_FILE))
        .groupBy(_directory(F.col("path")).alias("above"))
        .agg(F.min(F.struct((-F.col("similarity")).alias("s"), "path", "license")).alias("best"))
        .select("above", "best.path", "best.license", (-F.col("best.s")).alias("similarity"))
    )
    rest = files.drop("license", "similarity", "origin", "license_path")
    key, directory, stated_here, near = (
        fresh(rest.columns, n) for n in ("file_path", "directory_path", "own_license", "near_license")
    )
    rows = rest.withColumn(key, F.col(path).cast("string"))
    rows = rows.withColumn(directory, _directory(F.col(key)))
    # One row per directory, so a directory with many files costs no more than another here.
    directories = rows.groupBy(F.col(directory).alias("directory")).agg(F.count("*").alias("n"))
    nearest = (
        directories.where("directory IS NOT NULL")
        .select("directory", "n", F.posexplode(_ancestors(F.col("directory"))).alias("up", "above"))
        .join(stated, "above")
        .groupBy("directory")
        .agg(
            F.first("n").alias("n"),
            F.min(F.struct("up", "path", "license", "similarity")).alias("near"),
        )
    )
    count = fresh([*rest.columns, key, directory, stated_here, near], "directory_rows")
    found = nearest.select(
        F.col("directory").alias(directory), F.col("n").alias(count), F.col("near").alias(near)
    )
    inherited = written(found, "inherited")
    stating = own.select(F.col("path").alias(key), F.struct("license", "similarity").alias(stated_here))
    joined = rows.join(stating, key, "left")
    joined = spread_join(joined, inherited, [directory], F.xxhash64(key), count=count, how="left")
    has_own, has_near = F.col(stated_here).isNotNull(), F.col(near).isNotNull()
    return joined.select(
        *rest.columns,
        F.coalesce(f"{stated_here}.license", f"{near}.license").alias("license"),
        F.coalesce(f"{stated_here}.similarity", f"{near}.similarity").alias("similarity"),
        F.when(has_own, "own").when(has_near, "inherited").alias("origin"),
        F.when(has_own, F.col(key)).otherwise(F.col(f"{near}.path")).alias("license_path"),
    )
