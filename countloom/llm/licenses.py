"""Licence scans: TF-IDF cosine of headers and licence files to templates, then inheritance from directories.

A passage is a line with a licence cue, or a window of words around a cue, cut the
way each template lies around its own cues.  Its words are weighed by term frequency
and by how rare they are among all passages, and compared with every template by
the cosine of the sparse vectors, as joins on words.  Whole files are compared with whole
licence texts as well, and SPDX headers are taken at their word.  A file takes the
licence of its best match.  A licence file, by its name or its text, speaks for its
directory, and files without a licence inherit from the nearest directory above.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from countloom.llm.ship import ship
from countloom.llm.store import stored

#: Fixed values: (licence, wording) of the statements that headers and licence files carry.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may not use this file except in compliance with the License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software."),
    ("MPL-2.0", "This file is subject to the terms of the Mozilla Public License, v. 2.0."),
)
CUE = r"(?i)licen[sc]e|licen[sc]ed|copyright|permission is hereby|redistribution and use|spdx"
CUE_TERM = "licen[sc]e|copyright|^permission$|^redistribution$"
TERM = "[^a-z0-9.]+"
SPDX = r"(?i)spdx-license-identifier:[ \t]*\(*([a-z0-9.+-]*[a-z0-9+](?:\)*[ \t]+(?:or|and|with)[ \t]+\(*[a-z0-9.+-]*[a-z0-9+])*)"
NAMED = r"(?i)(^|/)((un)?licen[sc]e|copying)([.-][^/]*)?$"
_WARRANTY = (
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
    "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR "
    "BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution. "
)
_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. "
)
#: Fixed values: (licence, whole text or whole notice).
TEXTS = (
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
     "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or "
     'agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF '
     "ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-2-Clause", _BSD + _AS_IS + _WARRANTY),
    ("BSD-3-Clause", _BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
     "products derived from this software without specific prior written permission. " + _AS_IS + _WARRANTY),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
     "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is "
     "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
     "FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU "
     "General Public License along with this program. If not, see https://www.gnu.org/licenses/."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
     'that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR '
     "DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT "
     "SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS "
     "OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH "
     "THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("MIT", "MIT License Copyright (c) Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     'associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights '
     "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
     "Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
     'included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, '
     "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
     "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN "
     "AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
)


def plain_terms(text: str) -> list[str]:
    """What ``_terms`` gives, in Python."""
    return [w for w in (x.rstrip(".") for x in re.split(TERM, text.lower())) if w]


def _shapes() -> list[tuple[int, int]]:
    """(words before the cue, words in all) for every cue of every template."""
    out = set()
    for _, wording in TEMPLATES:
        words = plain_terms(wording)
        out |= {(i, len(words)) for i, w in enumerate(words) if re.search(CUE_TERM, w)}
    return sorted(out)


def _terms(text):
    """Lower-case words and version numbers, without a full stop at the end."""
    words = F.split(F.lower(text), TERM)
    return F.filter(F.transform(words, lambda w: F.rtrim(w, F.lit("."))), lambda w: w != "")


def passages(files: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """(path, passage, words of the file, words of the passage, line) for every line with a cue and every window around one."""
    lines = F.filter(F.split(F.col(text), "\n"), lambda x: x.rlike(CUE))
    held = files.where(F.col(text).rlike(CUE)).select(F.col(path).alias("path"), _terms(F.col(text)).alias("t"), lines.alias("l"))
    held = held.withColumn("file_words", F.size("t"))
    whole = held.select("path", "file_words", F.explode(F.array_distinct("l")).alias("passage"), F.lit(True).alias("line"))
    cues = F.filter(F.transform("t", lambda w, i: F.when(w.rlike(CUE_TERM), i)), lambda i: i.isNotNull())
    shapes = F.array(*[F.struct(F.lit(b).alias("b"), F.lit(n).alias("n")) for b, n in _shapes()])
    cut = lambda i: F.transform(shapes, lambda s: F.array_join(F.slice("t", F.greatest(i - s["b"], F.lit(0)) + 1, s["n"]), " "))
    windows = F.array_distinct(F.flatten(F.transform(cues, cut)))
    around = held.select("path", "file_words", F.explode(windows).alias("passage"), F.lit(False).alias("line"))
    return whole.unionByName(around).distinct().withColumn("passage_words", F.size(_terms(F.col("passage"))))


def _whole_texts(min_cosine: float):
    """Files whose whole text has the cosine with a whole licence text; rarity is that among the licence texts."""
    known = [(name, Counter(plain_terms(text))) for name, text in TEXTS]
    holding = Counter(w for _, words in known for w in words)
    rare = lambda w: math.log((len(known) + 1.0) / (holding[w] + 1.0)) + 1.0
    weighed = [(name, {w: n * rare(w) for w, n in words.items()}) for name, words in known]
    length = lambda v: math.sqrt(sum(x * x for x in v.values()))
    lengths = [length(v) for _, v in weighed]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path, text in zip(batch["path"], batch["text"]):
                ours = {w: n * rare(w) for w, n in Counter(plain_terms(text)).items()}
                size = length(ours) or 1.0
                for (name, theirs), other in zip(weighed, lengths):
                    cosine = round(sum(x * ours.get(w, 0.0) for w, x in theirs.items()) / (size * other), 6)
                    if cosine >= min_cosine:
                        out.append((path, name, cosine))
            yield pd.DataFrame(out, columns=["path", "license", "cosine"])

    return compare


def match(found: DataFrame, min_cosine: float) -> DataFrame:
    """Best template of each distinct passage: passage, license, cosine.

    Passages repeat a lot, so each wording is scored once; rarity counts the
    distinct lines and the templates together.
    """
    spark = found.sparkSession
    rows = [(name, i, wording) for i, (name, wording) in enumerate(TEMPLATES)]
    templates = spark.createDataFrame(rows, "license string, template int, wording string")
    wordings = found.groupBy(F.col("passage").alias("text")).agg(F.max("line").alias("line"))
    both = wordings.select("text", F.lit(-1).alias("template"), "line").unionByName(
        templates.select(F.col("wording").alias("text"), "template", F.lit(True).alias("line"))
    )
    terms = both.select("text", "template", "line", F.explode(_terms(F.col("text"))).alias("term"))
    counts = terms.groupBy("text", "template", "line", "term").agg(F.count(F.lit(1)).alias("tf"))
    # Template words are few and fixed; passage words only matter through the length of the vector.
    documents = both.where("line").count()
    rarity = counts.groupBy("term").agg((F.log((documents + 1.0) / (F.count_if("line") + 1.0)) + 1.0).alias("idf"))
    weighed = stored(counts.join(rarity, "term").withColumn("w", F.col("tf") * F.col("idf")), "weights")
    lengths = weighed.groupBy("text", "template").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("len"))
    ours = weighed.where(F.col("template") < 0).select("text", "term", "w")
    theirs = weighed.where(F.col("template") >= 0).select(F.col("template").alias("t"), "term", F.col("w").alias("v"))
    dots = ours.join(F.broadcast(theirs), "term").groupBy("text", "t").agg(F.sum(F.col("w") * F.col("v")).alias("dot"))
    scored = dots.join(lengths.where(F.col("template") < 0).select("text", F.col("len").alias("a")), "text")
    known = lengths.where(F.col("template") >= 0).select(F.col("template").alias("t"), F.col("len").alias("b"))
    scored = scored.join(F.broadcast(known), "t").withColumn("cosine", F.round(F.col("dot") / (F.col("a") * F.col("b")), 6))
    named = scored.where(F.col("cosine") >= min_cosine).join(
        F.broadcast(templates.select(F.col("template").alias("t"), "license")), "t"
    )
    best = named.groupBy("text").agg(F.min(F.struct((-F.col("cosine")).alias("c"), "license")).alias("m"))
    return best.select(F.col("text").alias("passage"), F.col("m.license").alias("license"), (-F.col("m.c")).alias("cosine"))


def license_scan(files: DataFrame, path: str = "path", text: str = "text", min_cosine: float = 0.6, file_share: float = 0.5) -> DataFrame:
    """One row per distinct path: path, license, cosine, origin (own, inherited, none) and from_path (file or directory).

    A file with a licence is a licence file if its name says so, if its whole text is
    near a licence's, or if its matched lines hold at least ``file_share`` of its
    words.  An SPDX header counts with a cosine of 1.  Where a directory has several, the best match speaks for it,
    the first licence by name on a tie.  Null and empty texts have no licence of
    their own but inherit; null paths come back as one row without a licence.
    Equal paths count as one file with all their passages.
    """
    found = stored(passages(files, path, text), "passages")
    matched = found.join(match(found, min_cosine), "passage")
    by = F.struct((-F.col("cosine")).alias("c"), "license")
    ship(files.sparkSession)
    cued = files.where(F.col(path).isNotNull() & F.col(text).rlike(CUE)).select(F.col(path).alias("path"), F.col(text).alias("text"))
    texts = cued.mapInPandas(_whole_texts(min_cosine), "path string, license string, cosine double")
    headers = cued.select("path", F.explode(F.regexp_extract_all("text", F.lit(SPDX), F.lit(1))).alias("said"))
    canon = F.create_map(*[F.lit(x) for name in sorted({n for n, _ in (*TEMPLATES, *TEXTS)}) for x in (name.lower(), name)])
    headers = headers.select("path", F.coalesce(canon[F.lower("said")], "said").alias("license"), F.lit(1.0).alias("cosine"))
    none, no = F.lit(0), F.lit(False)
    every = matched.select("path", "license", "cosine", F.when(F.col("line"), F.col("passage_words")).otherwise(0).alias("p"), F.col("file_words").alias("w"), no.alias("whole"))
    every = every.unionByName(texts.select("path", "license", "cosine", none.alias("p"), none.alias("w"), F.lit(True).alias("whole")))
    every = every.unionByName(headers.select("path", "license", "cosine", none.alias("p"), none.alias("w"), no.alias("whole")))
    own = every.groupBy("path").agg(
        F.min(by).alias("m"), F.sum("p").alias("p"), F.max("w").alias("w"), F.max("whole").alias("whole")
    )
    much = (F.col("w") > 0) & (F.col("p") >= file_share * F.col("w"))
    speaks = F.col("whole") | F.col("path").rlike(NAMED) | much
    own = stored(own.select("path", F.col("m.license").alias("license"), (-F.col("m.c")).alias("cosine"), speaks.alias("speaks")), "own")
    up = lambda c: F.when(F.instr(c, "/") > 0, F.regexp_replace(c, "/[^/]*$", "")).otherwise(F.lit(""))
    spoken = own.where("speaks").withColumn("dir", up(F.col("path"))).groupBy("dir").agg(F.min(by).alias("s"))

    paths = files.select(F.col(path).alias("path")).distinct()
    paths = paths.withColumn("dir", up(F.col("path")))
    # Ancestors of each directory, worked out once per directory, not per file.
    dirs = paths.where(F.col("path").isNotNull()).select("dir").distinct()
    parts = F.split("dir", "/")
    above = dirs.withColumn("n", F.explode(F.sequence(F.lit(0), F.size(parts))))
    above = above.withColumn("above", F.array_join(F.slice(parts, 1, F.col("n")), "/"))
    reach = above.join(spoken.withColumnRenamed("dir", "above"), "above")
    nearest = reach.groupBy("dir").agg(F.max_by(F.struct("above", "s"), F.col("n")).alias("near"))
    joined = paths.join(own.select("path", "license", "cosine"), "path", "left").join(nearest, "dir", "left")
    origin = F.when(F.col("license").isNotNull(), "own").when(F.col("near").isNotNull(), "inherited").otherwise("none")
    return joined.select(
        "path",
        F.coalesce("license", "near.s.license").alias("license"),
        F.coalesce("cosine", -F.col("near.s.c")).alias("cosine"),
        origin.alias("origin"),
        F.when(F.col("license").isNotNull(), F.col("path")).otherwise(F.col("near.above")).alias("from_path"),
    )
