import math
from collections import Counter

from pyspark.sql import functions as F

from ledgerloom.llm import licenses as lic

DOCS = "doc_id long, path string, text string, license string, line int"


def _cosine(line, name):
    idf, unknown = lic.weights(lic.TEMPLATES)
    raw = {w: k * idf.get(w, unknown) for w, k in Counter(lic.template_words(line)).items()}
    norm = math.sqrt(sum(x * x for x in raw.values()))
    v = lic.vectors(lic.TEMPLATES)[name]
    return sum(x * v.get(w, 0) for w, x in raw.items()) / norm if norm else 0.0


LINES = ["Released under the MIT License.", "released UNDER the mit license (see file)", "Licensed under the Apache License, Version 2.0.",
         "the of and to in is by a", "MIT", "license", "This work is licensed under the GNU General Public License, version 2 or 3",
         "Plain words about nothing at all", "cc by nc 4 0", "", "   ", "..."]


def test_lines_against_plain_cosine(spark):
    df = spark.createDataFrame([(i, None, t, "x", 1) for i, t in enumerate(LINES)] + [(99, None, None, "x", 1)], DOCS)
    got = {r.doc_id: (r.license, r.cosine) for r in lic.line_licenses(df).collect()}
    for i, t in enumerate(LINES):
        scores = {n: round(_cosine(t, n), 6) for n in lic.TEMPLATES}
        best = min(scores, key=lambda n: (-scores[n], n))
        if scores[best] >= lic.MIN_COSINE:
            assert got[i][0] == lic.license_of(best) and abs(got[i][1] - scores[best]) < 2e-6
        else:
            assert i not in got


def test_nearest_directory_wins(spark):
    mit, gpl = LINES[0], "This work is licensed under the GNU General Public License, version 3."
    rows = [(1, "a/LICENSE", mit), (2, "a/x.txt", "text"), (3, "a/b/COPYING", gpl), (4, "a/b/c/d.txt", "text"), (5, "a/b/e.txt", "words " * 200 + "\n" + mit),
            (6, "z/y.txt", "text"), (7, "top.txt", "text"), (8, None, "text"), (9, "ab/f.txt", "text"), (10, "a/b/c/none.txt", None), (4, "a/b/c/d.txt", "text")]
    df = spark.createDataFrame([(i, p, t, "x", 1) for i, p, t in rows], DOCS)
    out = lic.scan(df, F.col("path")).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: (r.license, r.license_from) for r in out}
    assert got == {1: ("MIT", "text"), 2: ("MIT", "a"), 3: ("GPL-3.0", "text"), 4: ("GPL-3.0", "a/b"), 5: ("MIT", "text"), 6: (None, None),
                   7: (None, None), 8: (None, None), 9: (None, None), 10: ("GPL-3.0", "a/b")}
    assert lic.scan(df.limit(0), F.col("path")).count() == 0
    assert lic.scan(df, F.col("path"), templates={}).filter("license is not null").isEmpty()


def test_a_line_without_a_cue_cannot_match():
    known = set(lic.cues(lic.TEMPLATES))
    for name, vector in lic.vectors(lic.TEMPLATES).items():
        assert math.sqrt(sum(x * x for w, x in vector.items() if w not in known)) < lic.MIN_COSINE, name


NOTICES = {
    "Apache-2.0": ['# Licensed under the Apache License, Version 2.0 (the "License");', "// SPDX-License-Identifier: Apache-2.0",
                   "   you may not use this file except in compliance with the License."],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification,", "SPDX-License-Identifier: BSD-3-Clause",
                     "3. Neither the name of the copyright holder nor the names of its contributors"],
    "GPL-3.0": [" * it under the terms of the GNU General Public License as published by", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "LGPL-3.0": [" * it under the terms of the GNU Lesser General Public License as published by"],
    "MIT": ["Permission is hereby granted, free of charge, to any person obtaining a copy", "MIT License", "/* SPDX-License-Identifier: MIT */"],
}
OTHERS = ["SPDX-License-Identifier: Foo-7", "the license of the car was lost by the person", "use the copy of this file as is", "source and binary are words"]


def test_real_notices_are_found(spark):
    lines = [(n, t) for n, of in NOTICES.items() for t in of] + [(None, t) for t in OTHERS]
    body = "\n".join(f"some long line about {k} nothing" for k in range(300))
    rows = [(i, None, f"/*\n{t}\n*/\n" + body * (i % 2), "x", 1) for i, (_, t) in enumerate(lines)]
    got = {r.doc_id: r.license for r in lic.line_licenses(spark.createDataFrame(rows, DOCS)).collect()}
    assert {i: got.get(i) for i in range(len(lines))} == {i: n for i, (n, _) in enumerate(lines)}
