import random
import re

import pytest

from ratewise.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower_ascii(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(text):
    """Every rule at every place of every text."""
    low = lower_ascii(text)
    words = WORD.findall(low)
    base = []
    for label, phrase in licenses.BASE:
        parts = re.sub("[<>]", "", phrase).split()
        base += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    found = []
    for rule in licenses.RULES:
        pattern = re.compile(f"( {rule.pattern} )")
        for i, word in enumerate(words):
            if word == rule.keyword:
                left = words[max(0, i - licenses.REACH) : i]
                window = " " + " ".join([*left, f"<{word}>", *words[i + 1 : i + 1 + licenses.REACH]]) + " "
                m = pattern.search(window)
                if m:
                    start = i - len(left) + window[: m.start() + 1].count(" ") - 1
                    found.append((start, start + m[0].count(" ") - 1, rule))
    kept = [
        (a, b, r) for a, b, r in found
        if not any(
            c <= a and d >= b and (q.priority < r.priority or q.priority == r.priority
            and (d - c > b - a or ((c, d) == (a, b) and q.number < r.number)))
            for c, d, q in found
        )
    ]
    labels = {label for _, label in base} | {r.label for _, _, r in kept}
    score = max([0.95] * bool(base) + [r.score for _, _, r in kept] + [0.0])
    starts = [i for i, _ in base]
    return (
        len(words), len(base), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({label for _, label in base})), ",".join(sorted(labels)), score,
    )


TEXTS = [
    None, "", "...", "Released under the MIT License.", "mit der mit", "İ K under the mit license",
    "Licensed under the Apache License, Version 2.0. under THE mit license under the mit license",
    "licensed under CC BY-NC 4.0 and CC-BY-NC-SA 4.0", "cc by nc cc by nc", "SPDX-License-Identifier: GPL-3.0-or-later",
    "GNU General Public License, version 3", "All rights reserved", "é license é", "x " * 30_000 + "under the mit license",
    "apache license version 2" * 3, "under the mit license " * 300, "Copyright (c) 2020 someone",
    "Released under MIT", "available under CC BY 4.0", "MIT no attribution", "submit the limit", "CreativeML RAIL-M",
    "Permission is hereby granted, free of charge, to any person", "3-clause BSD license", "BSD 3-Clause",
]


def _random_texts():
    rng = random.Random(8)
    words = sorted({w for r in licenses.RULES for w in re.findall(r"[a-z0-9]+", r.pattern)})
    common = ["under", "the", "license", "licensed", "gnu", "general", "public", "version", "3", "mit", "cc", "by", "nc", "4", "0"]
    return [" ".join(rng.choices(words + common * 12, k=rng.randrange(3, 60))) for _ in range(60)]


def test_scan_equals_brute_force(spark):
    texts = TEXTS + _random_texts()
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, TEXTS[3], "x"), (3, TEXTS[3], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string")
    found = licenses.scanned(docs).drop("matches").collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: tuple(r)[1:] for r in found}
    for i, text in enumerate(texts):
        assert by_id[i] == pytest.approx(brute(text)), text
    assert by_id[None] == by_id[3]


def test_rules_are_many_and_native(spark):
    assert len(licenses.RULES) > 200
    for rule in licenses.RULES:
        re.compile(rule.pattern)
        assert rule.keyword and "'" not in rule.pattern and "\\" not in rule.pattern
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = licenses.scanned(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan and "Arrow" not in plan
    assert licenses.scanned(docs.limit(0)).count() == 0


def test_notices_without_a_telling_word_are_found(spark):
    """No gate but the rules' own keywords: a longer text tells no more than its notice."""
    texts = {
        "Released under MIT": ("mit", 0.95), "distributed under the ISC": ("isc", 0.95),
        "available under CC BY 4.0": None, "CC-BY-SA 4.0": None, "CC BY-ND 3.0": None,
        "Creative Commons Attribution-ShareAlike 4.0": None, "MIT no attribution": None,
        "CreativeML RAIL-M": None, "submit the limit": ("", 0.0),
    }
    rows = [(2 * i, t) for i, t in enumerate(texts)] + [(2 * i + 1, f"{t}. It is free") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scanned(docs).collect()}
    for i, (text, wanted) in enumerate(texts.items()):
        assert found[2 * i] == found[2 * i + 1], text
        assert found[2 * i] == (wanted or found[2 * i]), text
        assert found[2 * i][0] or text == "submit the limit", text


def test_every_rule_needs_a_keyword_of_the_prefilter():
    for rule in licenses.RULES:
        assert f"<{rule.keyword}>" in rule.pattern and rule.keyword in licenses._keywords()


HEADER_TEXTS = {
    "either version 2 of the License, or (at your option) any later version.": "gpl-2-or-later",
    "either version 3 of the License, or (at your option) any later version.": "gpl-3-or-later",
    "either version 2.1 of the License, or (at your option) any later version.": "lgpl-2.1-or-later",
    "This library is free software; you can redistribute it and/or modify it": "lgpl",
    "under the terms of the GNU Affero General Public License": "agpl-3",
    "The contents of this file are subject to the Mozilla Public License Version 1.1": "mpl-1.1",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": "mpl-2",
    "accompanying materials are made available under the terms of the Eclipse Public License v1.0": "epl-1",
    "accompanying materials are made available under the terms of the Eclipse Public License 2.0": "epl-2",
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy": "boost",
    "The origin of this software must not be misrepresented; you must not claim": "zlib",
    "without any express or implied warranty. In no event will the authors be held liable": "zlib",
    "Redistributions of source code must retain the above copyright notice": "bsd",
    "Neither the name of the University nor the names of its contributors may be used": "bsd-3-clause",
    "All advertising materials mentioning features or use of this software must display": "bsd-4-clause",
    "As a special exception, the copyright holders of this library give you permission to link": "linking-exception",
    "GPL-2.0 WITH Classpath-exception": "classpath-exception",
    "Apache License v2.0 with LLVM Exceptions": "llvm-exception",
    "under the GCC Runtime Library Exception, version 3.1": "gcc-exception",
    "Licensed under MIT or Apache-2.0": "apache-2,mit",
    "Licensed under Apache 2.0 or MIT": "apache-2,mit",
    "dual licensed under the MIT license or the GPL": "gpl,mit",
}


def test_headers_clauses_exceptions_and_choices(spark):
    rows = list(enumerate(HEADER_TEXTS))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in licenses.scanned(docs).drop("matches").collect()}
    for i, text in rows:
        assert set(HEADER_TEXTS[text].split(",")) <= set(found[i]["labels"].split(",")), text
        assert tuple(found[i])[1:] == pytest.approx(brute(text)), text
    # the clause of a longer notice does not stand beside what contains it
    later = next(i for i, t in rows if "2.1" in t and "later" in t)
    assert found[later]["labels"] == "lgpl-2.1-or-later"
