r"""License scan: MinHash bands over overlapping windows retrieve templates, containment confirms.

A text's words are the runs of letters and digits in lower case; its shingles are
five words.  For a template of ``t`` shingles, windows of ``t`` shingles start
every ``max(1, t // 8)`` shingles.  There are ``BANDS`` bands of one MinHash sample
each; a window retrieves the template if any sample agrees.  A window that holds
0.8 of a template's shingles has a Jaccard similarity of 0.58 or more to it even
half a stride off, so it is missed with probability 0.42**16 < 1e-6.

A sample can only agree if the window holds the very shingle that gives the
template its minimum.  So minima are worked out for windows around such shingles
only; texts without one are done after a single hash-set test.

A retrieved window, one stride wider on each side, is confirmed by exact
containment: the share of the template's distinct shingles found in it.  All steps
are SQL expressions.

Versions of a license share most of their words.  So each place of a text belongs
to the confirmed window that holds the most shingles of its template there (then
the best contained, then the last by name), and a window counts if its license
has at least half of its places.  Licenses side by side share no places.

Defined cases: null and empty texts and texts under five words match nothing;
rows that share an id are reported together; templates need five words; an empty
table, or no template, gives no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tumbleweed.llm.common import computed, cut, quoted

SHINGLE = 5
BANDS = 16
CONTAINMENT = 0.8
#: Up to so many anchors, templates are broadcast; past it the planner joins by size.
BROADCAST_ANCHORS = 4096
#: Public notices, a fixed list of (license, text); more are appended below.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
            "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
            "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
                   "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
                "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
                 "License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("CC0-1.0", "has waived all copyright and related or neighboring rights to"),
    ("CC0-1.0", "CC0 1.0 Universal (CC0 1.0) Public Domain Dedication"),
    ("CC0-1.0", "CC0 1.0 Universal Public Domain Dedication"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
             "damages arising from the use of this software."),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
             "redistribute it freely, subject to the following restrictions"),
    ("BSL-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying "
                "documentation covered by this license"),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as "
                  "a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Apache-2.0", "Apache License Version 2.0, January 2004"),
    ("GPL-1.0", "GNU General Public License Version 1, February 1989"),
    ("GPL-2.0", "GNU General Public License Version 2, June 1991"),
    ("GPL-3.0", "GNU General Public License Version 3, 29 June 2007"),
    ("LGPL-2.0", "GNU Library General Public License Version 2, June 1991"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1, February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License Version 3, 29 June 2007"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3, 19 November 2007"),
]

BSD_TERMS = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
             "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
             "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
             "the following disclaimer in the documentation and/or other materials provided with the distribution.")
BSD_NAMES = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
             "this software without specific prior written permission.")
TEMPLATES += [("BSD-2-Clause", f"{BSD_TERMS} THIS SOFTWARE IS PROVIDED BY"), ("BSD-3-Clause", f"{BSD_TERMS} 3. {BSD_NAMES} THIS SOFTWARE IS PROVIDED BY"),
              ("BSD-3-Clause", BSD_NAMES)]

#: Licenses of the Free Software Foundation: (license, name, version).
GNU = [("GPL-1.0", "GNU General Public License", "1"), ("GPL-2.0", "GNU General Public License", "2"), ("GPL-3.0", "GNU General Public License", "3"),
       ("LGPL-2.0", "GNU Library General Public License", "2"), ("LGPL-2.1", "GNU Lesser General Public License", "2.1"),
       ("LGPL-3.0", "GNU Lesser General Public License", "3"), ("AGPL-3.0", "GNU Affero General Public License", "3")]
for _license, _name, _version in GNU:
    _notice = f"is free software; you can redistribute it and/or modify it under the terms of the {_name}"
    TEMPLATES += [(_license, f"{_notice} as published by the Free Software Foundation; either version {_version} of the License, or (at your option) any "
                             "later version."),
                  (_license, f"{_notice} as published by the Free Software Foundation; version {_version} of the License"),
                  (_license, f"{_notice} version {_version} as published by the Free Software Foundation")]
    TEMPLATES.append((_license, f"version {_version} of the {_name}"))

#: Names with a version: (license, name, version); each is looked for as "the <name> <version>" in the usual spellings.
NAMED = GNU + [
    ("Apache-1.1", "Apache Software License", "1.1"), ("Apache-2.0", "Apache License", "2.0"), ("Apache-2.0", "Apache Software License", "2.0"),
    ("MPL-1.1", "Mozilla Public License", "1.1"), ("MPL-2.0", "Mozilla Public License", "2.0"),
    ("EPL-1.0", "Eclipse Public License", "1.0"), ("EPL-2.0", "Eclipse Public License", "2.0"),
    ("CDDL-1.0", "Common Development and Distribution License", "1.0"), ("CDDL-1.1", "Common Development and Distribution License", "1.1"),
    ("EUPL-1.1", "European Union Public Licence", "1.1"), ("EUPL-1.2", "European Union Public Licence", "1.2"),
    ("BSL-1.0", "Boost Software License", "1.0"), ("OFL-1.1", "SIL Open Font License", "1.1"), ("Artistic-2.0", "Artistic License", "2.0")]
TEMPLATES += [(n, f"the {name} {sign}{version}") for n, name, version in NAMED
              for sign in ("", "v", "version ", *(["v "] if name.startswith(("Mozilla", "Eclipse")) else []))]
#: Short names: looked for after a verb.
SHORT = [("MIT", "MIT License"), ("MIT", "Expat License"), ("ISC", "ISC License"), ("Zlib", "zlib License"), ("Unlicense", "Unlicense License"),
         ("0BSD", "Zero Clause BSD License"), ("WTFPL", "WTFPL License"),
         ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-2-Clause", "2-Clause BSD License"), ("BSD-2-Clause", "Simplified BSD License"),
         ("BSD-3-Clause", "BSD 3-Clause License"), ("BSD-3-Clause", "3-Clause BSD License"), ("BSD-3-Clause", "New BSD License"),
         ("BSD-3-Clause", "Modified BSD License"), ("Apache-2.0", "Apache 2.0"), ("Apache-2.0", "Apache 2 License"),
         ("MPL-2.0", "MPL 2.0"), ("MPL-1.1", "MPL 1.1"), ("EPL-1.0", "EPL 1.0"), ("EPL-2.0", "EPL 2.0"), ("CC0-1.0", "CC0 1.0"), ("EUPL-1.2", "EUPL 1.2")]
SHORT += [(f"{n}-{v}", f"{n} {sign}{v.removesuffix('.0')}") for n, v in (("GPL", "1.0"), ("GPL", "2.0"), ("GPL", "3.0"), ("LGPL", "2.1"), ("LGPL", "3.0"), ("AGPL", "3.0"))
          for sign in ("", "v", "version ")]
_LEADS = {2: ("licensed under the", "released under the", "distributed under the", "terms of the"), 3: ("under the",), 4: ("the",)}
TEMPLATES += [(n, f"{lead} {name}") for n, name in SHORT for lead in _LEADS[len(re.findall(r"[^\W_]+", name))]]
TEMPLATES += [(n, f"licensed under {name}") for n, name in SHORT if name[-1].isdigit()]
#: Tags; those of MIT, ISC, Zlib, WTFPL, 0BSD and Unlicense have fewer than five words.
TEMPLATES += [(n, f"SPDX-License-Identifier: {n}") for n in sorted({n for n, _ in TEMPLATES})]

#: Creative Commons, by their long and short names, in each version.
CC = {"BY": ["Attribution"], "BY-SA": ["Attribution-ShareAlike", "Attribution-Share Alike"], "BY-ND": ["Attribution-NoDerivatives", "Attribution-NoDerivs"],
      "BY-NC": ["Attribution-NonCommercial", "Attribution-Non-Commercial"],
      "BY-NC-SA": ["Attribution-NonCommercial-ShareAlike", "Attribution-Non-Commercial-Share Alike"],
      "BY-NC-ND": ["Attribution-NonCommercial-NoDerivatives", "Attribution-NonCommercial-NoDerivs"]}
TEMPLATES += [(f"CC-{k}-{v}", text) for k, names in CC.items() for v in ("1.0", "2.0", "2.5", "3.0", "4.0")
              for text in (*[f"Creative Commons {name} {v}" for name in names], *([f"CC {k} {v}"] if "-" in k else [f"under CC {k} {v}", f"under a CC {k} {v}", f"Identifier: CC-{k}-{v}"]))]
# too short to have a shingle, or the words of an earlier template of the license
_words = [(n, t, " ".join(re.findall(r"[^\W_]+", t.lower()))) for n, t in TEMPLATES]
TEMPLATES = [(n, t) for i, (n, t, w) in enumerate(_words) if w.count(" ") >= SHINGLE - 1 and (n, w) not in {(m, u) for m, _, u in _words[:i]}]


def words(text: Column) -> Column:
    """Runs of letters and digits, in lower case; null for null."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")


def shingle_hashes(w: Column) -> Column:
    """Hashes of the five-word shingles, in order; empty with fewer words."""
    positions = F.when(F.size(w) >= SHINGLE, F.sequence(F.lit(0), F.size(w) - SHINGLE)).otherwise(F.array().cast("array<int>"))
    return F.transform(positions, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE)]))


def seeds() -> Column:
    return F.array(*[F.xxhash64(F.lit(i), F.lit("license band")) for i in range(BANDS)])


def minima(hashes: Column) -> Column:
    """One MinHash sample per band: the least of ``hash XOR seed``."""
    return F.transform(seeds(), lambda s: F.array_min(F.transform(hashes, lambda h: h.bitwiseXOR(s))))


def prepared(templates: DataFrame) -> DataFrame:
    """``(license, t, stride, shingles, minima)`` per template of five words or more."""
    hashed = (templates.select("license", words(F.col("text")).alias("w"))
              .select("license", shingle_hashes(F.col("w")).alias("h")).where(F.size("h") > 0))
    return hashed.select("license", F.size("h").alias("t"), F.greatest(F.lit(1), F.expr("size(h) div 8")).cast("int").alias("stride"),
                         F.array_distinct("h").alias("shingles"), minima(F.col("h")).alias("minima"))


def anchors(ready: DataFrame) -> DataFrame:
    """The shingles that give a template one of its minima, each with its template."""
    at = F.zip_with("minima", seeds(), lambda m, s: m.bitwiseXOR(s))
    return ready.withColumn("anchor", F.explode(F.array_distinct(at)))


def scan(docs: DataFrame, templates: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, license, containment, start)``: the best confirmed window of each document and license.

    ``start`` is the window's first word, counted from 0.  Templates are a curated
    list: their anchors, 16 at most for each, travel as one literal array.
    """
    ready = cut(anchors(prepared(templates)))
    hashes = [r[0] for r in ready.select("anchor").distinct().collect()]
    if not hashes:
        return docs.select(quoted(doc_id).alias("doc_id"), F.lit("").alias("license"), F.lit(0.0).alias("containment"), F.lit(0).cast("long").alias("start")).limit(0)
    wanted = F.array(*[F.lit(h).cast("long") for h in sorted(hashes)])
    if len(hashes) <= BROADCAST_ANCHORS:
        ready = F.broadcast(ready)
    t = quoted(text).cast("string")
    hashed = (docs.select(quoted(doc_id).alias("doc_id"), F.xxhash64(t).alias("text_hash"), computed(words(t)).alias("w"))
              .select("doc_id", "text_hash", computed(shingle_hashes(F.col("w"))).alias("h")))
    hits = F.filter(F.transform("h", lambda h, i: F.struct(i.alias("at"), h.alias("anchor"))), lambda x: x["anchor"].isin(hashes))
    found = (hashed.where(F.arrays_overlap("h", wanted)).select("doc_id", "text_hash", "h", F.explode(hits).alias("hit"))
             .join(ready, F.col("hit.anchor") == F.col("anchor")))
    # the neighbourhood that any window around the anchor can reach
    low = F.greatest(F.lit(0), F.col("hit.at") - F.col("t") - F.col("stride") + 1)
    near = found.select("doc_id", "text_hash", "license", "t", "stride", "shingles", "minima", F.col("hit.at").alias("at"), low.alias("low"),
                        F.slice("h", low + 1, F.col("t") * 2 + F.col("stride") * 2).alias("part"))
    first = (F.ceil(F.greatest(F.lit(0), F.col("at") - F.col("t") + 1) / F.col("stride")) * F.col("stride")).cast("int")
    last = (F.floor(F.col("at") / F.col("stride")) * F.col("stride")).cast("int")
    starts = F.when(first <= last, F.sequence(first, last, F.col("stride"))).otherwise(F.array(last))

    def window(a: Column) -> Column:
        begin = F.greatest(F.col("low"), a - F.col("stride"))
        return F.struct(a.alias("start"), begin.alias("begin"), F.slice("part", a - F.col("low") + 1, F.col("t")).alias("own"),
                        F.slice("part", begin - F.col("low") + 1, a - begin + F.col("t") + F.col("stride")).alias("wide"))

    windows = near.withColumn("window", F.explode(F.transform(starts, window))).select("doc_id", "text_hash", "license", "shingles", "minima", "window.*")
    agrees = F.exists(F.zip_with("minima", seeds(), lambda m, s: m == F.array_min(F.transform("own", lambda h: h.bitwiseXOR(s)))), lambda x: x)
    share = F.round(F.size(F.array_intersect("shingles", "wide")) / F.size("shingles"), 6)
    kept = windows.where(agrees).withColumn("containment", share).where(F.col("containment") >= CONTAINMENT)
    places = F.filter(F.transform("wide", lambda h, i: F.when(F.array_contains("shingles", h), F.col("begin") + i)), lambda x: x.isNotNull())
    matched = F.round(F.col("containment") * F.size("shingles")).cast("int")
    # anchors of one window, and windows of one place, are the same rows: each once
    rows = kept.select("doc_id", "text_hash", "license", "containment", "start", matched.alias("matched"), places.alias("places")).distinct()
    rank = F.struct("matched", "containment", "license")
    owner = F.max(rank).over(Window.partitionBy("doc_id", "text_hash", "place"))["license"]
    owned = (rows.withColumn("window", F.xxhash64("license", "start", "places")).withColumn("place", F.explode("places"))
             .select("doc_id", "text_hash", "license", "containment", "start", "window", (owner == F.col("license")).alias("own"))
             .groupBy("doc_id", "text_hash", "license", "window", "containment", "start").agg(F.avg(F.col("own").cast("int")).alias("share")))
    best = owned.where(F.col("share") >= 0.5).withColumn("best", F.struct("containment", (-F.col("start")).cast("long").alias("minus")))
    return (best.groupBy("doc_id", "license").agg(F.max("best").alias("best"))
            .select("doc_id", "license", F.col("best.containment").alias("containment"), (-F.col("best.minus")).alias("start")))
