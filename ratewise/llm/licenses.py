"""License scans by ordered signature rules, in DataFrame functions only.

A rule is a regular expression around a keyword, written ``<keyword>``. Only texts
that contain some keyword are looked at, which no match can do without, and only the
words around a keyword are matched, against the rules of that keyword. A match is an
interval of words. It
is suppressed if an interval of a better rule contains it: one of lesser priority
number, or of the same and longer, or of the same interval and earlier in the list.

Words are runs of digits, a-z (after lower-casing A-Z) and characters beyond ASCII.
Null texts count as empty: no words, no labels, score zero. Texts of any length are
scanned whole; the work grows with the keywords in them. Repeated rows are kept.
Extra columns of the input are ignored. Empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words on each side of a keyword that a rule may look at; no rule needs as many.
REACH = 14
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: The base phrases (fixed values): label, words with the keyword marked.
BASE = (
    ("mit", "under the <mit> license"),
    ("apache-2", "<apache> license version 2"),
    ("cc-by-nc", "<cc> by nc"),
)

#: Licenses (fixed values): label, SPDX identifier as words, name within a notice,
#: name that says enough by itself.
LICENSES = (
    ("mit", "mit", "<mit>(?: license)?", "(?:the )?<mit> license"),
    ("mit-0", "mit 0", "<mit> (?:0|no attribution)(?: license)?", "<mit> no attribution"),
    ("apache-1.1", "apache 1 1", "<apache> (?:software )?license (?:version |v )?1 1", "<apache> software license version 1 1"),
    ("apache-2", "apache 2 0", "<apache> (?:software )?(?:license )?(?:version |v)?2(?: 0)?", "<apache> (?:software )?license (?:version |v)?2(?: 0)?"),
    ("gpl-1", "gpl 1 0(?: only| or later)?", "gnu <gpl> (?:version |v)?1(?: 0)?", "<gpl> ?v1"),
    ("gpl-2", "gpl 2 0(?: only| or later)?", "(?:gnu )?<gpl> (?:version |v)?2(?: 0)?", "<gpl> (?:version |v)?2(?: 0)?"),
    ("gpl-3", "gpl 3 0(?: only| or later)?", "(?:gnu )?<gpl> (?:version |v)?3(?: 0)?", "<gpl> (?:version |v)?3(?: 0)?"),
    ("gpl-2", "gnu gpl 2", "<gnu> general public license (?:version |v)?2(?: 0)?", "<gnu> general public license (?:as published by the free software foundation )?(?:either )?(?:version |v)?2(?: 0)?"),
    ("gpl-3", "gnu gpl 3", "<gnu> general public license (?:version |v)?3(?: 0)?", "<gnu> general public license (?:as published by the free software foundation )?(?:either )?(?:version |v)?3(?: 0)?"),
    ("gpl", "gnu gpl", "<gnu> (?:gpl|general public license)", "<gnu> general public license"),
    ("lgpl-2.1", "lgpl 2 1(?: only| or later)?", "(?:gnu )?<lgpl> (?:version |v)?2 1", "<lgpl> (?:version |v)?2 1"),
    ("lgpl-3", "lgpl 3 0(?: only| or later)?", "(?:gnu )?<lgpl> (?:version |v)?3(?: 0)?", "<lgpl> (?:version |v)?3(?: 0)?"),
    ("lgpl", "gnu lgpl", "<gnu> (?:lesser|library) general public license", "<gnu> (?:lesser|library) general public license"),
    ("agpl-3", "agpl 3 0(?: only| or later)?", "(?:gnu )?<agpl> (?:version |v)?3(?: 0)?", "<agpl> (?:version |v)?3(?: 0)?"),
    ("agpl-3", "gnu agpl", "<gnu> affero general public license(?: (?:version |v)?3(?: 0)?)?", "<gnu> affero general public license"),
    ("fdl", "gfdl 1 3", "<gnu> free documentation license(?: version 1 [0-3])?", "<gnu> free documentation license"),
    ("bsd-2-clause", "bsd 2 clause", "<bsd> 2 clause(?: license)?|2 clause <bsd>(?: license)?|simplified <bsd>(?: license)?", "(?:2 clause|simplified) <bsd> license|<bsd> 2 clause"),
    ("bsd-3-clause", "bsd 3 clause", "<bsd> 3 clause(?: license)?|3 clause <bsd>(?: license)?|(?:new|modified|revised) <bsd>(?: license)?", "(?:3 clause|new|modified|revised) <bsd> license|<bsd> 3 clause"),
    ("bsd-4-clause", "bsd 4 clause", "<bsd> 4 clause(?: license)?|original <bsd>(?: license)?", "original <bsd> license|<bsd> 4 clause"),
    ("bsd-0", "0bsd", "zero clause <bsd>(?: license)?|<bsd> zero clause(?: license)?", "zero clause <bsd>"),
    ("bsd", "bsd", "<bsd>(?: style)?(?: licen[cs]e)?", "<bsd>(?: style)? licen[cs]e"),
    ("isc", "isc", "<isc>(?: license)?", "(?:the )?<isc> license"),
    ("mpl-1.1", "mpl 1 1", "<mozilla> public license (?:version |v)?1 1", "<mozilla> public license (?:version |v)?1 1"),
    ("mpl-2", "mpl 2 0", "<mozilla> public license(?: (?:version |v)?2(?: 0)?)?", "<mozilla> public license (?:version |v)?2(?: 0)?"),
    ("epl-1", "epl 1 0", "<eclipse> public license (?:version |v)?1(?: 0)?", "<eclipse> public license (?:version |v)?1(?: 0)?"),
    ("epl-2", "epl 2 0", "<eclipse> public license (?:version |v)?2(?: 0)?", "<eclipse> public license (?:version |v)?2(?: 0)?"),
    ("cddl", "cddl 1 0", "common development and <distribution> license", "common development and <distribution> license"),
    ("cpl", "cpl 1 0", "<common> public license(?: version 1 0)?", "<common> public license"),
    ("eupl", "eupl 1 2", "<european> union public licen[cs]e(?: (?:version |v)?1 [12])?", "<european> union public licen[cs]e"),
    ("artistic", "artistic 2 0", "<artistic> license(?: (?:version )?[12](?: 0)?)?", "<artistic> license(?: (?:version )?[12](?: 0)?)?"),
    ("zlib", "zlib", "<zlib>(?: libpng)?(?: license)?", "<zlib>(?: libpng)? license"),
    ("boost", "bsl 1 0", "<boost> software license(?: version 1 0)?", "<boost> software license"),
    ("unlicense", "unlicense", "<unlicense>(?: license)?", "the <unlicense>"),
    ("wtfpl", "wtfpl", "<wtfpl>", "<wtfpl>"),
    ("postgresql", "postgresql", "<postgresql> licen[cs]e", "<postgresql> licen[cs]e"),
    ("python", "psf 2 0", "<python> software foundation license(?: version 2)?", "<python> software foundation license"),
    ("openssl", "openssl", "<openssl> license", "<openssl> license"),
    ("ofl", "ofl 1 1", "(?:sil )?open <font> license(?: (?:version )?1 1)?", "(?:sil )?open <font> license"),
    ("odbl", "odbl 1 0", "open (?:data commons open )?<database> license", "open <database> license"),
    ("ms-pl", "ms pl", "<microsoft> public license", "<microsoft> public license"),
    ("rail", "rail", "(?:open|creativeml) <rail>(?: m)?(?: license)?", "(?:open|creativeml) <rail>(?: m)?"),
    ("cc0", "cc0 1 0", "<cc0>(?: 1 0)?(?: universal)?", "<cc0> 1 0|<cc0> universal"),
    ("cc-by", "cc by [1-4] [0-5]", "<cc> by(?: [1-4] [0-5])?", "<cc> by [1-4] [0-5]"),
    ("cc-by-sa", "cc by sa [1-4] [0-5]", "<cc> by sa(?: [1-4] [0-5])?", "<cc> by sa"),
    ("cc-by-nd", "cc by nd [1-4] [0-5]", "<cc> by nd(?: [1-4] [0-5])?", "<cc> by nd"),
    ("cc-by-nc", "cc by nc [1-4] [0-5]", "<cc> by nc(?: [1-4] [0-5])?", "<cc> by nc(?: [1-4] [0-5])?"),
    ("cc-by-nc-sa", "cc by nc sa [1-4] [0-5]", "<cc> by nc sa(?: [1-4] [0-5])?", "<cc> by nc sa(?: [1-4] [0-5])?"),
    ("cc-by-nc-nd", "cc by nc nd [1-4] [0-5]", "<cc> by nc nd(?: [1-4] [0-5])?", "<cc> by nc nd(?: [1-4] [0-5])?"),
    ("cc-by", "cc by", "creative <commons> attribution(?: [1-4] [0-5])?(?: international| unported)?(?: license)?", "creative <commons> attribution (?:[1-4] [0-5] )?(?:international |unported )?license"),
    ("cc-by-sa", "cc by sa", "creative <commons> attribution share ?alike(?: [1-4] [0-5])?", "creative <commons> attribution share ?alike"),
    ("cc-by-nd", "cc by nd", "creative <commons> attribution no ?deriv(?:ative)?s(?: [1-4] [0-5])?", "creative <commons> attribution no ?deriv(?:ative)?s"),
    ("cc-by-nc", "cc by nc", "creative <commons> attribution non ?commercial(?: [1-4] [0-5])?", "creative <commons> attribution non ?commercial"),
    ("cc-by-nc-sa", "cc by nc sa", "creative <commons> attribution non ?commercial share ?alike(?: [1-4] [0-5])?", "creative <commons> attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", "cc by nc nd", "creative <commons> attribution non ?commercial no ?deriv(?:ative)?s(?: [1-4] [0-5])?", "creative <commons> attribution non ?commercial no ?deriv(?:ative)?s"),
    ("public-domain", "public domain", "public <domain>", "(?:released into|dedicated to|in) the public <domain>"),
    ("proprietary", "proprietary", "<proprietary> license", "all <rights> reserved"),
)

#: Signs of a license without its name (fixed values): label, rule.
SIGNS = (
    ("mit", "<permission> is hereby granted free of charge to any person"),
    ("isc", "<permission> to use copy modify and or distribute this software"),
    ("bsd", "<redistribution> and use in source and binary forms"),
    ("gpl", "this program is free <software> you can redistribute it"),
    ("apache-2", "you may not use this <file> except in compliance with the license"),
    ("unlicense", "this is free and unencumbered <software> released into the public domain"),
    ("wtfpl", "do what the fuck you want to public <license>"),
    ("unnamed", "(?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:this|the following) <license>"),
    ("unnamed", "see the <license> file"),
    ("unnamed", "<copyright> c? ?[12][0-9]{3}"),
)

#: Headers, clauses, exceptions and choices (fixed values): label, priority, score, rule.
HEADERS = (
    ("gpl-2-or-later", 2, 0.95, "either version 2 of the license or at your <option> any later version"),
    ("gpl-3-or-later", 2, 0.95, "either version 3 of the license or at your <option> any later version"),
    ("lgpl-2.1-or-later", 2, 0.95, "either version 2 1 of the license or at your <option> any later version"),
    ("lgpl", 3, 0.8, "this library is free <software> you can redistribute it"),
    ("agpl-3", 2, 0.95, "under the terms of the gnu <affero> general public license"),
    ("mpl-1.1", 2, 0.95, "the contents of this file are subject to the <mozilla> public license version 1 1"),
    ("mpl-2", 2, 0.95, "this source code form is subject to the terms of the <mozilla> public license v 2 0"),
    ("epl-1", 2, 0.95, "accompanying materials are made available under the terms of the <eclipse> public license (?:v1 0|v 1 0|1 0)"),
    ("epl-2", 2, 0.95, "accompanying materials are made available under the terms of the <eclipse> public license (?:v2 0|v 2 0|2 0)"),
    ("boost", 3, 0.8, "permission is hereby granted free of charge to any person or <organization> obtaining a copy"),
    ("zlib", 3, 0.8, "the <origin> of this software must not be misrepresented"),
    ("zlib", 4, 0.7, "without any express or <implied> warranty in no event will the authors be held liable"),
    ("bsd", 4, 0.7, "redistributions of source code must retain the above <copyright> notice"),
    ("bsd-3-clause", 3, 0.85, "neither the name of (?:[^ ]+ ){1,4}nor the names of (?:its|the|other) <contributors>"),
    ("bsd-4-clause", 3, 0.9, "all <advertising> materials mentioning features or use of this software must display"),
    ("linking-exception", 3, 0.85, "as a special exception the copyright holders (?:of this library )?give you permission to <link>"),
    ("classpath-exception", 3, 0.85, "<classpath> exception"),
    ("llvm-exception", 3, 0.85, "<llvm> exceptions?"),
    ("gcc-exception", 3, 0.85, "<gcc> runtime library exception"),
    ("apache-2", 2, 0.9, "mit(?: license)? or (?:the )?<apache>(?: license)?(?: version)?(?: 2(?: 0)?)?"),
    ("mit", 2, 0.9, "apache(?: license)?(?: version)?(?: 2(?: 0)?)? or (?:the )?<mit>(?: license)?"),
    ("gpl", 2, 0.9, "mit(?: license)? or (?:the )?(?:gnu )?<gpl>"),
)

#: How a license is named (fixed values): priority, score, text around the name.
NOTICES = (
    (1, 1.0, "spdx license identifier {spdx}"),
    (2, 0.95, "(?:licen[cs]ed|released|distributed|published|available|provided|shared|covered) (?:under|by|with) (?:the )?(?:terms of (?:the )?|conditions of (?:the )?)?{name}"),
    (3, 0.85, "licen[cs]e(?: is| type| name)? {name}"),
    (3, 0.85, "under (?:the )?(?:terms of (?:the )?)?{name}"),
    (4, 0.75, "{full}"),
)


@dataclass(frozen=True)
class Rule:
    number: int
    keyword: str
    label: str
    priority: int
    score: float
    pattern: str


def rules() -> tuple[Rule, ...]:
    """All rules in their order: every license in every notice, the signs, the headers."""
    found = []

    def add(label: str, priority: int, score: float, pattern: str) -> None:
        keyword = pattern[pattern.index("<") + 1 : pattern.index(">")]
        found.append(Rule(len(found), keyword, label, priority, score, pattern))

    for priority, score, notice in NOTICES:
        for label, spdx, name, full in LICENSES:
            if "{spdx}" in notice:
                add(label, priority, score, "<spdx>" + notice.format(spdx=spdx)[4:])
            elif "{name}" in notice:
                add(label, priority, score, notice.format(name=f"(?:{name})"))
            else:
                add(label, priority, score, notice.format(full=f"(?:{full})"))
    for label, sign in SIGNS:
        add(label, 5, 0.6, sign)
    for header in HEADERS:
        add(*header)
    return tuple(found)


RULES = rules()
def _marked(word: str) -> str:
    return word[word.index("<") + 1 : word.index(">")]


def _constant(structs: list[str]) -> str:
    return f"array({','.join(structs)})"


def _rules_by_keyword() -> Column:
    """keyword -> its rules, folded to a constant of the plan."""
    own: dict[str, list[str]] = {}
    for r in RULES:
        own.setdefault(r.keyword, []).append(
            f"named_struct('number', {r.number}, 'label', '{r.label}', 'priority', {r.priority}, "
            f"'score', {r.score}D, 'pattern', '( {r.pattern} )')"
        )
    for label, phrase in BASE:  # keywords of base phrases need not have rules
        own.setdefault(_marked(phrase), [])
    pairs = [f"struct('{word}', {_constant(found)})" for word, found in own.items()]
    return F.expr(f"map_from_entries({_constant(pairs)})")


def lowered(text: Column) -> Column:
    """A-Z in lower case. Other letters may change case, which no rule can see; the two
    that would become ASCII letters are left as they are."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    odd = F.contains(text, F.lit("\u212a")) | F.contains(text, F.lit("\u0130"))
    return F.when(odd, F.translate(text, upper, lower)).otherwise(F.lower(text))


def _keywords() -> list[str]:
    return sorted({r.keyword for r in RULES} | {_marked(phrase) for _, phrase in BASE})


def _telling(low: Column) -> Column:
    """Whether a keyword occurs anywhere in the text, within longer words too."""
    found = F.lit(False)
    for word in _keywords():
        # of two keywords the one within the other is enough
        if not any(other in word for other in _keywords() if other != word):
            found = found | F.contains(low, F.lit(word))
    return found


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _windows(words: str, keywords: Column) -> Column:
    """(at, left, word, window) of each keyword: its place, how many words stand before
    it in the window, and the window with the keyword in angle brackets."""
    marked = F.transform(words, lambda w, i: F.struct(i.alias("at"), w.alias("word")))
    at_keywords = F.filter(marked, lambda a: F.array_contains(keywords, a["word"]))

    def window(a: Column) -> Column:
        left = F.least(a["at"], F.lit(REACH))
        before = F.slice(words, a["at"] - left + 1, left)
        behind = F.slice(words, a["at"] + 2, F.lit(REACH))
        joined = F.concat(
            F.lit(" "),
            F.array_join(
                F.concat(before, F.array(F.concat(F.lit("<"), a["word"], F.lit(">"))), behind), " "
            ),
            F.lit(" "),
        )
        return F.struct(
            a["at"].alias("at"), left.alias("left"), a["word"].alias("word"), joined.alias("window")
        )

    return F.transform(at_keywords, window)


def _matches(windows: str, rules: Column) -> Column:
    """(start, stop, priority, number, label, score) of every match of every rule."""

    def of_window(w: Column) -> Column:
        hit = F.filter(F.element_at(rules, w["word"]), lambda r: F.rlike(w["window"], r["pattern"]))

        def interval(r: Column) -> Column:
            place = F.regexp_instr(w["window"], r["pattern"])
            start = w["at"] - w["left"] + _spaces(F.substring(w["window"], F.lit(1), place)) - 1
            length = _spaces(F.regexp_substr(w["window"], r["pattern"])) - 1
            return F.struct(
                start.alias("start"), (start + length).alias("stop"), r["priority"].alias("priority"),
                r["number"].alias("number"), r["label"].alias("label"), r["score"].alias("score"),
            )

        return F.transform(hit, interval)

    return F.array_sort(F.flatten(F.transform(windows, of_window)))


def _survivors(matches: str) -> Column:
    """Matches that no interval of a better rule contains.

    Matches are in the order of their starts, and an interval spans a window at most:
    those that may contain one another are within ``near`` places.
    """
    per_keyword: dict[str, int] = {}
    for rule in RULES:
        per_keyword[rule.keyword] = per_keyword.get(rule.keyword, 0) + 1
    near = 4 * (REACH + 1) * max(per_keyword.values())

    def kept(d: Column, k: Column) -> Column:
        around = F.slice(matches, F.greatest(k - near, F.lit(0)) + 1, F.lit(2 * near + 1))

        def better(e: Column) -> Column:
            longer = (e["stop"] - e["start"]) > (d["stop"] - d["start"])
            equal = (e["start"] == d["start"]) & (e["stop"] == d["stop"])
            first = longer | (equal & (e["number"] < d["number"]))
            return (
                (e["start"] <= d["start"]) & (e["stop"] >= d["stop"])
                & ((e["priority"] < d["priority"]) | ((e["priority"] == d["priority"]) & first))
            )

        return ~F.exists(around, better)

    return F.filter(matches, kept)


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, base phrases (n_base, first_word, last_word, base_labels), labels
    and score of every row, and the surviving ``matches`` as intervals of words."""
    rules = _rules_by_keyword()
    low = lowered(F.coalesce("text", F.lit("")))
    parts = docs.select("doc_id", low.alias("low"))
    cut = F.split("low", BETWEEN_WORDS)
    parts = parts.select("doc_id", _telling(F.col("low")).alias("telling"), cut.alias("cut"))
    empty = (F.element_at("cut", 1) == "").cast("int") + (
        (F.size("cut") > 1) & (F.element_at("cut", -1) == "")
    ).cast("int")
    words = F.when(F.col("telling"), F.filter("cut", lambda w: w != "")).otherwise(F.array())
    parts = parts.select("doc_id", (F.size("cut") - empty).cast("long").alias("n_words"), words.alias("words"))
    parts = parts.select("doc_id", "n_words", _windows("words", F.map_keys(rules)).alias("windows"))

    def base_places(label: str, phrase: str) -> Column:
        before = phrase.split(" ").index(f"<{_marked(phrase)}>")
        found = F.filter("windows", lambda w: F.contains(w["window"], F.lit(f" {phrase} ")))
        return F.transform(
            found,
            lambda w: F.struct((w["at"] - before).cast("long").alias("start"), F.lit(label).alias("label")),
        )

    base = F.flatten(F.array(*[base_places(*entry) for entry in BASE]))
    parts = parts.select("doc_id", "n_words", base.alias("base"), _matches("windows", rules).alias("found"))
    parts = parts.select("doc_id", "n_words", "base", _survivors("found").alias("matches"))
    labels = F.concat(F.col("base")["label"], F.col("matches")["label"])
    base_score = F.when(F.size("base") > 0, 0.95).otherwise(0.0)
    return parts.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(F.col("base")["start"]).alias("first_word"),
        F.array_max(F.col("base")["start"]).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.col("base")["label"])), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("labels"),
        F.greatest(base_score, F.coalesce(F.array_max(F.col("matches")["score"]), F.lit(0.0))).alias("score"),
        "matches",
    )
