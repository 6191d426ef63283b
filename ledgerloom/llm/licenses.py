"""License scans: lines against license templates by TF-IDF cosine, then inheritance by directory.

Every line of every text is a candidate header. A line's vector has a weight per distinct word
(count times inverse frequency among the templates), and the best template with a cosine of
``MIN_COSINE`` or more is the line's license. Most lines are ruled out unseen: of each template
uncommon words are taken as cues until the rest of its vector is too short for the cosine, so
a line without a cue can't match.

A document that mostly consists of its matched line is the license file of its directory. Files
without a license of their own take that of the nearest directory above that has a license file.
Everything is a DataFrame expression; templates are a parameter and small (``MAX_TERMS`` words).
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .common import folded, query, row_code, split_words, table

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
MIN_COSINE = 0.6
FILE_SHARE = 0.25  # of a license file's characters in its matched line
MAX_TERMS = 20_000

# Names and the notices by which texts declare them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "BSD 3-Clause License: redistributions must retain the above copyright notice and disclaimer.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0 Universal.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Proprietary": "All rights reserved. Reproduction prohibited without written permission.",
}

# Lines of standard headers and license files, as they are usually wrapped, and whole
# paragraphs on one line. What follows # tells the forms of one license apart. The opening line that all
# BSD licenses share counts as the three-clause one.
TEMPLATES |= {
    "AGPL-3.0#terms": "it under the terms of the GNU Affero General Public License as published by",
    "Apache-2.0#basis": 'distributed under the License is distributed on an "AS IS" BASIS,',
    "Apache-2.0#compliance": "you may not use this file except in compliance with the License.",
    "Apache-2.0#header": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "Apache-2.0#paragraph": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
                            "the License. You may obtain a copy of the License at",
    "BSD-3-Clause#endorse": "Neither the name of the copyright holder nor the names of its",
    "BSD-3-Clause#paragraph": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                              "following conditions are met:",
    "BSD-3-Clause#redistribution": "Redistribution and use in source and binary forms, with or without",
    "GPL-2.0#version": "the Free Software Foundation; either version 2 of the License, or",
    "GPL-3.0#paragraph": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
                         "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-3.0#terms": "it under the terms of the GNU General Public License as published by",
    "ISC#paragraph": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
                     "provided that the above copyright notice and this permission notice appear in all copies.",
    "ISC#permission": "Permission to use, copy, modify, and/or distribute this software for any",
    "LGPL-3.0#terms": "it under the terms of the GNU Lesser General Public License as published by",
    "MIT#deal": 'of this software and associated documentation files (the "Software"), to deal',
    "MIT#grant": "Permission is hereby granted, free of charge, to any person obtaining a copy",
    "MIT#paragraph": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
                     'files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, '
                     "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
                     "Software is furnished to do so, subject to the following conditions:",
    "MIT#title": "The MIT License (MIT)",
    "MPL-2.0#header": "This Source Code Form is subject to the terms of the Mozilla Public",
    "Unlicense#header": "This is free and unencumbered software released into the public domain.",
}
SPDX = ("AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "CC-BY-4.0", "CC0-1.0", "GPL-2.0", "GPL-3.0", "ISC", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense")
TEMPLATES |= {f"{name}#spdx": f"SPDX-License-Identifier: {name}" for name in SPDX}


# Words that any English line may have; they become cues last.
COMMON = frozenset("a all and any are as at be by for from has have in is it may no not of on or other so that the this to was with work".split())


def license_of(template: str) -> str:
    """The license that a template stands for: its name up to #."""
    return template.split("#")[0]


def template_words(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def weights(templates: dict[str, str]) -> tuple[dict[str, float], float]:
    """Inverse frequency of each template word, and that of words in no template."""
    n = len(templates)
    seen = Counter(w for t in templates.values() for w in set(template_words(t)))
    return {w: math.log((1 + n) / (1 + k)) + 1 for w, k in seen.items()}, math.log(1 + n) + 1


def vectors(templates: dict[str, str]) -> dict[str, dict[str, float]]:
    """Unit vector of each template that has words."""
    idf, _ = weights(templates)
    out = {}
    for name, text in sorted(templates.items()):
        raw = {w: k * idf[w] for w, k in Counter(template_words(text)).items()}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        if norm:
            out[name] = {w: x / norm for w, x in sorted(raw.items())}
    return out


def cues(templates: dict[str, str], min_cosine: float = MIN_COSINE) -> list[str]:
    """Words of which a line must have one to reach the cosine with any template."""
    out = set()
    for vector in vectors(templates).values():
        rest = 1.0
        for w, x in sorted(vector.items(), key=lambda e: (e[0] in COMMON, -e[1], e[0])):
            if rest < min_cosine * min_cosine - 1e-9:
                break
            out.add(w)
            rest -= x * x
    return sorted(out)


def line_licenses(docs: DataFrame, templates: dict[str, str] | None = None, min_cosine: float = MIN_COSINE,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, code, line, license, cosine, share): the best template of each line that reaches the cosine.

    ``line`` counts from 0, ``share`` is the line's part of the text's characters. Ties go to the first template.
    """
    templates = TEMPLATES if templates is None else templates
    spark = docs.sparkSession
    idf, unknown = weights(templates)
    found = vectors(templates)
    if sum(map(len, found.values())) > MAX_TERMS:
        raise ValueError(f"templates have more than {MAX_TERMS} words")
    empty = "doc_id {0}, code long, line int, license string, cosine double, share double"
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    if not found:
        return spark.createDataFrame([], empty.format(rows.dtypes[0][1]))
    wanted, in_templates = cues(templates, min_cosine), sorted(idf)  # looked up by hash; maps are searched from the start
    rows = rows.select("doc_id", row_code().alias("code"), F.length("text").alias("chars"), F.posexplode_outer(F.split("text", "\n", -1)).alias("line", "content"))
    rows = rows.filter("content != ''").withColumn("words", split_words(folded(F.col("content")), SEPARATORS))
    rows = rows.filter(F.exists("words", lambda w: w.isin(wanted))).select(
        "doc_id", "code", "line", (F.length("content") / F.col("chars")).alias("share"), F.sort_array("words").alias("words")
    )
    # Counts of equal words are distances between the ends of their runs in sorted order.
    is_end = lambda i: F.get("words", i + 1).isNull() | (F.get("words", i) != F.get("words", i + 1))
    rows = rows.withColumn("ends", F.filter(F.sequence(F.lit(0), F.size("words") - 1), is_end))
    known = _map(idf)
    weight = lambda w: F.when(w.isin(in_templates), F.element_at(known, w)).otherwise(F.lit(unknown))
    value = lambda e, j: (e - F.coalesce(F.get("ends", j - 1), F.lit(-1))) * weight(F.get("words", e))
    rows = rows.withColumn("vector", F.transform("ends", lambda e, j: F.struct(F.get("words", e).alias("word"), value(e, j).alias("value"))))
    total = lambda v, part: F.aggregate(v, F.lit(0.0), lambda a, p: a + part(p))
    rows = rows.select(
        "doc_id", "code", "line", "share", F.sqrt(total("vector", lambda p: p["value"] * p["value"])).alias("norm"),
        F.filter("vector", lambda p: p["word"].isin(in_templates)).alias("vector"),
    )
    scores = [
        F.struct(
            F.round(total("vector", lambda p, m=_map(v): p["value"] * F.coalesce(F.element_at(m, p["word"]), F.lit(0.0))) / F.col("norm"), 6).alias("cosine"),
            F.lit(-place).alias("order"), F.lit(license_of(name)).alias("license"),
        )
        for place, (name, v) in enumerate(found.items())
    ]
    best = F.filter(F.array(F.array_max(F.array(*scores))), lambda b: b["cosine"] >= min_cosine)
    # Generated, so that the filter stays above: pushed below, it would compute the counts anew for every word.
    rows = rows.select("doc_id", "code", "line", "share", F.explode_outer(best).alias("best"))
    return rows.filter("best is not null").select("doc_id", "code", "line", "best.license", "best.cosine", "share")


def _map(values: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def _last_first(name: str) -> Column:
    """A value that is largest for the first name: code points turned round, the end above all."""
    turned = F.transform(F.split(F.col(name), ""), lambda c: F.lit(65536) - F.ascii(c))
    return F.concat(turned, F.array(F.lit(70000)))


def scan(docs: DataFrame, path: Column, templates: dict[str, str] | None = None, min_cosine: float = MIN_COSINE,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, path, own_license, own_cosine, license, license_from.

    ``path`` is the file's path with / between directories; a null path has no directory and
    inherits nothing. A text's own license is that of its best line (then the first name). Several
    license files in a directory: the highest cosine, then the first name. ``license_from`` is
    'text', the directory that it comes from, or null.
    Null and empty texts match nothing; repeated rows stay; an empty table gives no rows.
    """
    lines = line_licenses(docs, templates, min_cosine, id_col, text_col)
    best = F.max(F.struct("cosine", _last_first("license").alias("order"), "license")).alias("best")
    own = lines.groupBy("doc_id", "code").agg(best, F.max("share").alias("share")).select(
        F.col("doc_id").alias("own_id"), F.col("code").alias("own_code"), F.col("best.license").alias("own_license"),
        F.col("best.cosine").alias("own_cosine"), "share",
    )
    files = docs.select(F.col(f"`{id_col}`").alias("doc_id"), path.alias("path"), row_code(id_col, text_col).alias("code"))
    same = (F.col("code") == F.col("own_code")) & F.col("doc_id").eqNullSafe(F.col("own_id"))
    files = cut(files.join(own, same, "left").drop("own_id", "own_code", "code").withColumn("dir", _directory(F.col("path"))), "files")
    licensed = files.filter(F.col("share") >= FILE_SHARE).filter("dir is not null").groupBy("dir").agg(
        F.max(F.struct(F.col("own_cosine"), _last_first("own_license").alias("order"), "own_license")).alias("best")
    ).select(F.col("dir").alias("above"), F.col("best.own_license").alias("dir_license"))
    # Directories are few next to files: each finds its nearest licensed ancestor once.
    names = F.split("dir", "/", -1)
    chain = files.select("dir").filter("dir is not null").distinct().withColumn(
        "above", F.explode_outer(F.transform(F.sequence(F.lit(1), F.size(names)), lambda k: F.array_join(F.slice(names, 1, k), "/")))
    )
    nearest = chain.join(licensed, "above").groupBy("dir").agg(
        F.max_by(F.struct("above", "dir_license"), F.length("above")).alias("found")
    )
    found = files.join(nearest, "dir", "left")
    return found.select(
        "doc_id", "path", "own_license", "own_cosine",
        F.coalesce("own_license", "found.dir_license").alias("license"),
        F.when(F.col("own_license").isNotNull(), "text").otherwise(F.col("found.above")).alias("license_from"),
    )


def _directory(path: Column) -> Column:
    """The path up to its last /; null for a null path, empty for a file at the top."""
    return F.regexp_replace(F.when(path.contains("/"), path).otherwise(F.concat(F.lit("/"), path)), "/[^/]*$", "")


def document_path() -> Column:
    """The documents table has no paths: source, language and thousand of the id stand in for directories."""
    return F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 1000).cast("string"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))


def _sql() -> str:
    idf, unknown = weights(TEMPLATES)
    terms = ", ".join(f"('{w}', {idf[w]!r}::double, '{n}', {x!r}::double)" for n, v in vectors(TEMPLATES).items() for w, x in v.items())
    fold = "translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
with t(word, idf, form, x) as (values {terms}),
lines as materialized (select doc_id, length(text) as chars, p, string_split(text, chr(10))[p] as line
          from (select doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) as p from documents)),
w as materialized (select doc_id, p, word, count(*) as times from
       (select doc_id, p, unnest(regexp_extract_all({fold}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word from lines) group by doc_id, p, word),
hit as (select distinct doc_id, p from w where word in (select word from t)),
v as materialized (select w.doc_id, w.p, w.word, times * coalesce(idf, {unknown!r}) as value
       from w join hit using (doc_id, p) left join (select distinct word, idf from t) i on w.word = i.word),
n as (select doc_id, p, sqrt(sum(value * value)) as norm from v group by doc_id, p),
c as (select v.doc_id, v.p, form, sum(value * x) as dot from v join t on v.word = t.word group by v.doc_id, v.p, form),
m as (select doc_id, p, form, round(dot / norm, 6) as cosine from c join n using (doc_id, p) where round(dot / norm, 6) >= {MIN_COSINE}),
best as (select doc_id, p, cosine, split_part(form, '#', 1) as license from m
         qualify row_number() over (partition by doc_id, p order by cosine desc, form) = 1),
s as (select doc_id, max(length(line)::double / chars) as share from best join lines using (doc_id, p) group by doc_id),
own as (select doc_id, license as own_license, cosine as own_cosine, share from best join s using (doc_id)
        qualify row_number() over (partition by doc_id order by cosine desc, license) = 1),
f as materialized (select doc_id, source || '/' || lang || '/' || (doc_id // 1000) as dir, own_license, own_cosine, share
      from documents left join own using (doc_id)),
l as (select dir as above, own_license as dir_license from f where share >= {FILE_SHARE}
      qualify row_number() over (partition by dir order by own_cosine desc, own_license) = 1),
near as (select f.doc_id, above, dir_license from f join l on f.dir = above or starts_with(f.dir, above || '/')
         qualify row_number() over (partition by f.doc_id order by length(above) desc) = 1)
select doc_id, dir || '/' || doc_id || '.txt' as path, own_license, own_cosine, coalesce(own_license, dir_license) as license,
       case when own_license is not null then 'text' else above end as license_from
from f left join near using (doc_id)
"""


@query("op5_licenses", _sql())
def op5_licenses(spark, sf):
    return scan(table(spark, sf, "documents"), document_path())
