"""License scans: similarity of headers and licence files to templates, then inheritance along paths.

Every line of every text, and every block of lines, is compared; of a file that is named as a
licence file also the whole text. A block ends at a blank line and where comment lines begin or
end; a comment of several blocks is compared as a whole, too. Units and templates become sparse TF-IDF vectors, and a unit declares the template of the
largest cosine. Terms are words and numbers, so an SPDX id is several terms; ``2.0`` and ``v2``
are ``2``, and years are no terms.

The weight of a term falls with the mean of two logarithms: its share of the headers and its share
of the licences, both at least one licence's share. Two checks stand beside the cosine: a unit
shares two terms with the template, and one of the template's rarest, so the wording of a notice
alone names no licence. A header is a unit that passes them for some template and could reach
the threshold if the shared terms were as rare as they can be among headers, and all others as
common. That is known from the unit and the templates alone, so no declaration is lost, and prose
is neither shuffled nor counted. Weights do not depend on the table's size.

Of the declarations in a file, that
of a whole text or comment comes first, then the most similar. A reservation of rights counts only where
nothing else is declared, since licence texts contain one. A file without a declaration of its own
takes that of the licence file in the nearest directory above it.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator, Sequence
from hashlib import blake2b
from itertools import chain, groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusgraph.sources.scratch import materialize

THRESHOLD = 0.6  # cosine
LICENSE_FILE = r"(?i)^(un)?licen[sc]e|^copying|[.-]licen[sc]e$"
RESERVED = "Proprietary"

# Names of licences and the wording of their notices and texts.
_IDS = (
    ("Apache-2.0", ("Apache-2.0",)),
    ("MIT", ("MIT",)),
    ("BSD-3-Clause", ("BSD-3-Clause",)),
    ("BSD-2-Clause", ("BSD-2-Clause",)),
    ("ISC", ("ISC",)),
    ("GPL-3.0", ("GPL-3.0-only", "GPL-3.0-or-later")),
    ("GPL-2.0", ("GPL-2.0-only", "GPL-2.0-or-later")),
    ("LGPL-3.0", ("LGPL-3.0-only", "LGPL-3.0-or-later")),
    ("AGPL-3.0", ("AGPL-3.0-only", "AGPL-3.0-or-later")),
    ("MPL-2.0", ("MPL-2.0",)),
    ("Unlicense", ("Unlicense",)),
    ("CC0-1.0", ("CC0-1.0",)),
    ("CC-BY-4.0", ("CC-BY-4.0",)),
    ("CC-BY-NC-4.0", ("CC-BY-NC-4.0",)),
    ("CC-BY-SA-4.0", ("CC-BY-SA-4.0",)),
)
_PERMIT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    'associated documentation files (the "Software"), to deal in the Software without restriction, including '
    "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
    "following conditions:"
)
_PERMIT_NOTICE = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial "
    "portions of the Software."
)
_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
    "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
    "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
    "USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_REDISTRIBUTE = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met: 1. Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must "
    "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution."
)
_ENDORSE = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission."
)
_HOLDERS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
    "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
    "DAMAGE."
)
_APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
    "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"
)
_APACHE_REST = (
    "Unless required by applicable law or agreed to in writing, software distributed under the License is "
    'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
    "See the License for the specific language governing permissions and limitations under the License."
)
_GNU = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} "
    "as published by the Free Software Foundation, either version {} of the License, or (at your option) any "
    "later version."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
)
_UNLICENSE = "This is free and unencumbered software released into the public domain."
_CC = "This work is licensed under a Creative Commons {} 4.0 International License."
_NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", f"{_APACHE} {_APACHE_REST}"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "The MIT License (MIT)"),
    ("MIT", _PERMIT),
    ("MIT", f"{_PERMIT} {_PERMIT_NOTICE} {_AS_IS}"),
    ("BSD-3-Clause", "Redistribution and use permitted under the BSD 3-Clause License."),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-3-Clause", f"{_REDISTRIBUTE} {_ENDORSE}"),
    ("BSD-3-Clause", f"{_REDISTRIBUTE} {_ENDORSE} {_HOLDERS}"),
    ("BSD-2-Clause", "Redistribution and use permitted under the BSD 2-Clause License."),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("BSD-2-Clause", f"{_REDISTRIBUTE} {_HOLDERS}"),
    ("ISC", "Released under the ISC License."),
    ("ISC", _ISC),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("GPL-3.0", "Licensed under the GPL, version 3."),
    ("GPL-3.0", _GNU.format("General Public License", 3)),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-2.0", "Licensed under the GPL, version 2."),
    ("GPL-2.0", _GNU.format("General Public License", 2)),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("LGPL-3.0", _GNU.format("Lesser General Public License", 3)),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
    ("AGPL-3.0", _GNU.format("Affero General Public License", 3)),
    ("MPL-2.0", "Subject to the terms of the Mozilla Public License, version 2.0."),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("Unlicense", _UNLICENSE),
    ("CC0-1.0", "CC0 1.0 Universal public domain dedication"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0, Creative Commons Attribution."),
    ("CC-BY-4.0", _CC.format("Attribution")),
    ("CC-BY-NC-4.0", _CC.format("Attribution-NonCommercial")),
    ("CC-BY-SA-4.0", _CC.format("Attribution-ShareAlike")),
    (RESERVED, "Copyright, all rights reserved."),
)


def _id_templates() -> Iterator[tuple[str, str]]:
    """An id with the tag of headers, and by itself or in a short notice where it has several terms."""
    for license_id, names in _IDS:
        for name in names:
            yield license_id, f"SPDX-License-Identifier: {name}"
            if len(_words(name)) > 1:
                yield license_id, name
                yield license_id, f"Licensed under {name}."
                yield license_id, f"Available under {name}."


_WORD = re.compile(r"[^\W\d_]+|\d+(?:\.\d+)*")
_DIGIT = re.compile(r"\d")
_VERSION = re.compile(r"v\.?(?=\d)")
_YEAR = re.compile(r"(?:19|20)\d\d")
_COMMENT = re.compile(r"\s*(?:#|//|/\*|\*|--|;|%|<!--|\"\"\"|')")


def _words(text: str) -> list[str]:
    """Terms of a text, in order."""
    text = text.lower()
    if not _DIGIT.search(text):
        return _WORD.findall(text)
    found = _WORD.findall(_VERSION.sub(" ", text))
    return [w.removesuffix(".0") if w[0].isdigit() else w for w in found if not _YEAR.fullmatch(w)]


TEMPLATES = (*_id_templates(), *_NOTICES)


def _units(text: str, whole: bool) -> Iterator[tuple[int, list[str]]]:
    """(0, terms) of lines and blocks, (1, terms) of comments of several blocks and, if asked for, of all."""
    lines = [(_words(line), _COMMENT.match(line) is not None) for line in text.split("\n")]
    yield from ((0, words) for words, _ in lines if words)
    for comment, run in groupby(lines, key=lambda line: line[1]):
        blocks = [[w for w, _ in block] for full, block in groupby(run, key=lambda line: bool(line[0])) if full]
        yield from ((0, list(chain(*block))) for block in blocks if len(block) > 1)
        if comment and len(blocks) > 1:
            yield 1, list(chain(*chain(*blocks)))
    if whole:
        yield 1, list(chain(*(words for words, _ in lines)))


def _held(templates: Sequence[tuple[str, str]]) -> dict[str, float]:
    """Share of the licences that have a term in some template."""
    holders = defaultdict(set)
    for name, text in templates:
        for word in _words(text):
            holders[word].add(name)
    total = len({name for name, _ in templates})
    return {word: len(names) / total for word, names in holders.items()}


def _bounds(templates: Sequence[tuple[str, str]], threshold: float) -> Callable[[list[str]], bool]:
    """Whether terms pass the checks of some template, and could have its cosine at the threshold.

    Weights lie between those of a term in all headers and of one in at most a licence's share.
    Over the shared terms, no cosine exceeds the product of their parts of the two lengths.
    """
    held = _held(templates)
    least = 1 / len({name for name, _ in templates})
    low = {word: (1 - math.log(share) / 2) ** 2 for word, share in held.items()}
    high = {word: (1 - (math.log(least) + math.log(share)) / 2) ** 2 for word, share in held.items()}
    other = (1 - math.log(least) / 2) ** 2
    # Templates by their rarest terms: squared counts of terms, and the least squared length.
    models = defaultdict(list)
    for _, text in templates:
        part = {word: (1 + math.log(n)) ** 2 for word, n in Counter(_words(text)).items()}
        model = part, sum(n * low[word] for word, n in part.items())
        fewest = min(held[word] for word in part)
        for word in part:
            if held[word] == fewest:
                models[word].append(model)
    names, square = models.keys(), threshold * threshold

    def passes(words: list[str]) -> bool:
        distinct = set(words)
        found = distinct & names
        if not found:
            return False
        part = {w: (1 + math.log(n)) ** 2 for w, n in Counter(words).items()}
        least_size = sum(n * low.get(w, other) for w, n in part.items())
        for model, model_size in (one for word in found for one in models[word]):
            shared = distinct & model.keys()
            if len(shared) > 1:
                top = sum(part[w] * high[w] for w in shared)
                size = top + least_size - sum(part[w] * low[w] for w in shared)
                model_top = sum(model[w] * high[w] for w in shared)
                size *= model_top + model_size - sum(model[w] * low[w] for w in shared)
                # A little room for rounding.
                if top * model_top * (1 + 1e-6) >= square * size:
                    return True
        return False

    return passes


def _headers(files: DataFrame, templates: Sequence[tuple[str, str]], threshold: float, named: str) -> DataFrame:
    """(path, whole, unit, terms) of the units that could reach the threshold, once per file row.

    ``unit`` is a digest of the terms and their counts; equal vectors are one unit.
    """

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        passes = _bounds(templates, threshold)
        for batch in batches:
            rows = []
            for path, text, whole in zip(batch["path"], batch["text"], batch["whole"], strict=True):
                seen = set()
                for wide, words in _units(text, whole):
                    if not passes(words):
                        continue
                    counts = sorted(Counter(words).items())
                    unit = blake2b(repr(counts).encode(), digest_size=16).digest()
                    if (wide, unit) not in seen:
                        seen.add((wide, unit))
                        terms = [{"term": w, "tf": n} for w, n in counts]
                        rows.append((path, wide, unit, terms))
            yield pd.DataFrame(rows, columns=["path", "whole", "unit", "terms"])

    name = F.element_at(F.split("path", "/"), -1)
    texts = files.filter("path is not null and text is not null")
    texts = texts.select("path", "text", name.rlike(named).alias("whole"))
    return texts.mapInPandas(find, "path string, whole int, unit binary, terms array<struct<term:string,tf:long>>")


def _weighted(terms: DataFrame, weights: DataFrame, key: str) -> DataFrame:
    """(key, term, weight) with unit length per key."""
    raw = terms.join(weights, "term").withColumn("raw", (1 + F.log("tf")) * F.col("idf"))
    size = raw.groupBy(key).agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("size"))
    return raw.join(size, key).select(key, "term", (F.col("raw") / F.col("size")).alias("weight"))


def declared(
    files: DataFrame,
    threshold: float = THRESHOLD,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    license_name: str = LICENSE_FILE,
) -> DataFrame:
    """(path, license, similarity) of files (path, text) with a unit like a template.

    ``templates`` are pairs of a licence and a text; a licence may have several. Equal units
    are scored once, however many files hold them.
    """
    spark = files.sparkSession
    found = materialize(_headers(files, templates, threshold, license_name), "license-headers")
    rows = found.select("path", "whole", "unit").distinct()
    n = F.count(F.lit(1)).alias("n")
    units = found.groupBy("unit").agg(n, F.first("terms").alias("terms"))
    terms = materialize(
        units.select("unit", "n", F.explode("terms").alias("t")).select("unit", "n", "t.term", "t.tf"),
        "license-terms",
    )
    total = max(found.count(), 1)
    held = _held(templates)
    least = 1 / len({name for name, _ in templates})
    # Templates are an argument, so their terms are a small table.
    shares = spark.createDataFrame(list(held.items()), "term string, held double")
    seen = terms.groupBy("term").agg((F.sum("n") / total).alias("seen"))
    log_of = lambda c: F.log(F.greatest(F.coalesce(c, F.lit(least)), F.lit(least)))
    weights = seen.join(shares, "term", "full").select(
        "term", (1 - (log_of(F.col("seen")) + log_of(F.col("held"))) / 2).alias("idf")
    )
    weights = materialize(weights, "license-weights")
    counted, rare = [], []
    for k, (name, text) in enumerate(templates):
        tf = Counter(_words(text))
        fewest = min(held[word] for word in tf)
        counted += [(k, word, count) for word, count in tf.items()]
        rare += [(k, name, word, held[word] == fewest) for word in tf]
    model = _weighted(spark.createDataFrame(counted, "template int, term string, tf long"), weights, "template")
    marks = spark.createDataFrame(rare, "template int, license string, term string, rare boolean")
    model = model.join(F.broadcast(marks), ["template", "term"]).withColumnRenamed("weight", "other")
    own = _weighted(terms, weights, "unit")
    near = own.join(F.broadcast(model), "term").groupBy("unit", "template", "license")
    near = near.agg(
        F.round(F.sum(F.col("weight") * F.col("other")), 9).alias("similarity"),
        F.count(F.lit(1)).alias("shared"),
        F.max("rare").alias("rare"),
    )
    near = near.filter((F.col("similarity") >= threshold) & (F.col("shared") > 1) & F.col("rare"))
    best = near.groupBy("unit").agg(F.max(F.struct("similarity", "license")).alias("near"))
    order = F.struct(
        (F.col("near.license") != RESERVED).alias("named"), "whole", "near.similarity", "near.license"
    )
    best = rows.join(best, "unit").groupBy("path").agg(F.max(order).alias("best"))
    return best.select("path", "best.license", "best.similarity")


def scan_licenses(
    files: DataFrame,
    threshold: float = THRESHOLD,
    license_name: str = LICENSE_FILE,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
) -> DataFrame:
    """(path, license, similarity, declared_in) of every row of ``files`` (path, text).

    A file's own declaration wins. Otherwise the file takes the licence of the licence file in
    its own directory or the nearest one above; of several licence files in a directory
    the most similar, then the last by name, counts. Paths use ``/``; nothing is above
    the first part.

    Null and empty texts declare nothing but inherit; a null path has no licence; rows
    that repeat a path share its declaration; an empty table gives an empty table. Very long
    lines and texts are read whole, one text at a time; only terms of headers leave the task.
    Of equal similarities the last licence by name counts. Other columns play no part.
    """
    files = files.select("path", "text")
    own = materialize(declared(files, threshold, templates, license_name), "license-own")
    parts = F.split("path", "/")
    folder = F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/")
    holders = own.filter(F.element_at(parts, -1).rlike(license_name)).select(
        folder.alias("folder"), F.struct("similarity", "path", "license").alias("held")
    )
    holders = holders.groupBy("folder").agg(F.max("held").alias("held"))
    # Directories meet their ancestors once each, not once per file.
    folders = files.select(folder.alias("own_folder")).filter("own_folder is not null").distinct()
    steps = F.sequence(F.lit(0), F.size(F.split("own_folder", "/")))
    above = folders.select("own_folder", F.explode(steps).alias("depth")).select(
        "own_folder", "depth", F.array_join(F.slice(F.split("own_folder", "/"), 1, F.col("depth")), "/").alias("folder")
    )
    nearest = above.join(holders, "folder").groupBy("own_folder").agg(F.max_by("held", "depth").alias("held"))
    rows = files.select("path", folder.alias("own_folder"))
    joined = rows.join(own, "path", "left").join(nearest, "own_folder", "left")
    return joined.select(
        "path",
        F.coalesce("license", "held.license").alias("license"),
        "similarity",
        F.when(F.col("license").isNotNull(), F.col("path")).otherwise(F.col("held.path")).alias("declared_in"),
    )
