import math
import re
from collections import Counter

from tidemark.llm import license_scan as L
from tidemark.sources.tables import read_table

TRIGGER, NAME, TERM = (re.compile(p, re.A) for p in (L.TRIGGER, L.LICENCE_FILE, L.TERM))
AZ = str.maketrans(L._UPPER, L._LOWER)


def brute(rows):
    found = []
    for i, path, text in rows:
        lines = [x for x in (text or "").split("\n") if TRIGGER.search(x)]
        if path is not None and text is not None and NAME.match(path.rsplit("/", 1)[-1]):
            lines.append(text)
        found += [(i, s) for s in lines]
    counted = Counter(s for _, s in found)
    tf = {s: Counter(TERM.findall(s.translate(AZ))) for s in counted}
    df = Counter()
    for s, n in counted.items():
        for t in tf[s]:
            df[t] += n

    def vector(c):
        v = {t: (1 + math.log(n)) * (math.log((1 + len(found)) / (1 + df[t])) + 1) for t, n in c.items()}
        return v, math.sqrt(sum(x * x for x in v.values()))
    known = {name: vector(Counter(TERM.findall(t.translate(AZ)))) for name, t in L.TEMPLATES}
    best = {}
    for s, c in tf.items():
        v, norm = vector(c)
        got = [(-round(sum(x * k.get(t, 0) for t, x in v.items()) / (norm * n), 6), name)
               for name, (k, n) in known.items() if norm and set(k) & set(v)]
        got = [g for g in got if -g[0] >= L.THRESHOLD]
        if got:
            best[s] = min(got)
    own = {}
    for i, s in found:
        if i is not None and s in best:
            own[i] = min(own.get(i, best[s]), best[s])
    folders = {}
    for i, path, _ in rows:
        if path is not None and i in own and NAME.match(path.rsplit("/", 1)[-1]):
            f = path.rsplit("/", 1)[0] if "/" in path else ""
            folders[f] = min(folders.get(f, own[i]), own[i])
    out = []
    for i, path, _ in rows:
        if i in own:
            out.append((i, path, own[i][1], -own[i][0], "header", None))
            continue
        f = None if path is None else path.rsplit("/", 1)[0] if "/" in path else ""
        while f is not None and f not in folders:
            f = None if f == "" else f.rsplit("/", 1)[0] if "/" in f else ""
        out.append((i, path, *((folders[f][1], -folders[f][0], "folder", f) if f is not None else (None,) * 4)))
    return sorted(out, key=str)


def run(spark, rows):
    files = spark.createDataFrame([(*r, 1, "x") for r in rows], "file_id long, path string, text string, n int, term string")
    return sorted(map(tuple, L.licences(spark, files).collect()), key=str)


ROWS = [
    (1, "a/LICENSE", "Released under the MIT License."), (2, "a/x.py", "code"), (3, "a/b/c/y.py", "more\ncode"),
    (4, "a/b/COPYING.txt", "x\nThis work is licensed under the GNU General Public License, version 3.\ny"), (5, "a/b/z", "-"),
    (6, "q/w", "prose about a license that nobody knows of, at some length indeed"), (7, "q/r", "Licensed under the apache license version 2.0"),
    (8, None, "text"), (9, "top", None), (10, "", ""), (None, "a/b/none", "Released under the MIT License."), (None, "a/n", "z"),
    (11, "a/b/c/LICENSE", "nothing"), (12, "ab/x", "not under a"), (13, "d/LICENSE-1", "Licensed under CC BY-NC 4.0."),
    (14, "d/LICENSE-2", "Licensed under CC BY 4.0."), (15, "d/e/f", "x"), (16, "s/t", "long line license " * 20_000),
    (17, "h/i", "Copyright\r\nReleased under the MIT License.\r\n\r\n"), (2, "a/x.py", "code"), (18, "/abs/x", "q"), (19, "/NOTICE", "MIT License released under the"),
]


def test_matches_brute_force(spark):
    got = run(spark, ROWS)
    assert got == brute(ROWS)
    by = {r[0]: r[2:] for r in got}
    assert by[3][0] == "GPL-3.0" and by[3][3] == "a/b" and by[2][0] == "MIT" and by[6] == ("MIT", 1.0, "folder", "")
    assert run(spark, []) == []
    assert run(spark, [(1, "x/y", "no")]) == [(1, "x/y", None, None, None, None)]


def test_whole_table(spark, small):
    files = L.documents_as_files(read_table(spark, small, "documents"))
    rows = [tuple(r) for r in files.collect()]
    got = run(spark, rows)
    assert got == brute(rows) and any(r[4] == "header" for r in got)


def test_no_python_on_the_main_path(spark):
    files = spark.createDataFrame(ROWS, "file_id long, path string, text string").repartition(2)
    plan = L.licences(spark, files)._jdf.queryExecution().toString()
    assert "ArrowEval" not in plan and "InArrow" not in plan and "BatchEvalPython" not in plan


GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version %d of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY."""
APACHE = """Copyright 2019 The Authors

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0"""
MIT = """Copyright (c) 2021 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""


def test_wrapped_headers_and_whole_texts(spark):
    def marked(text, mark):
        return "\n".join(f"{mark} {x}".rstrip() for x in text.split("\n"))
    texts = dict(L.TEXTS)
    bsd = {n: [t for m, t in L.HEADERS if m == n and "Redistribution and use" in t][0] for n in ("BSD-2-Clause", "BSD-3-Clause")}
    code = "\nimport os\n" + "print(os.sep)\n" * 200
    want = {1: "GPL-3.0", 2: "GPL-2.0", 3: "Apache-2.0", 4: "MIT", 5: "GPL-3.0", 6: "Apache-2.0", 7: "BSD-2-Clause", 8: "BSD-3-Clause",
            9: "MPL-2.0", 10: "LGPL-3.0", 11: "MIT", 12: "GPL-2.0", 13: None, 14: "Apache-2.0", 15: "BSD-3-Clause"}
    rows = [(1, "a.py", "#!/bin/python\n" + marked(GPL % 3, "#") + code), (2, "b.c", "/*\n" + marked(GPL % 2, " *") + "\n */" + code),
            (3, "c.js", marked(APACHE, "//") + code), (4, "d.c", "/* " + MIT + " */" + code),
            (5, "g/COPYING", texts["GPL-3.0"]), (6, "h/LICENSE", texts["Apache-2.0"]), (7, "i/LICENSE.txt", "Copyright 2001 X\n\n" + bsd["BSD-2-Clause"]),
            (8, "j/LICENSE", bsd["BSD-3-Clause"]), (9, "k/LICENSE", texts["MPL-2.0"]), (10, "l/COPYING", texts["LGPL-3.0"]),
            (11, "README", "A tool.\n\nUse it.\n\n" + MIT + "\n\nBye."), (12, "g2/COPYING", texts["GPL-2.0"]),
            (13, "none.py", "# The licence of the king was long, and none may copy it.\n" + code), (14, "h/src/x.py", "pass"),
            (15, "m.sh", "#!/bin/sh\n" + marked("Copyright 2020\n\n" + bsd["BSD-3-Clause"], "#") + code)]
    got = {r[0]: r[2:] for r in run(spark, rows)}
    assert {i: g[0] for i, g in got.items()} == want
    assert got[14][2:] == ("folder", "h") and all(got[i][2] == "header" for i in want if i not in (13, 14))
