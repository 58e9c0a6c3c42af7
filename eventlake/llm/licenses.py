"""License scans by ordered signature rules.

A text is reduced to its words, lower-cased and one space apart. Each rule has
a label, a priority, a keyword and a regular expression over that form; the
expression runs only where the keyword occurs. Hits resolve by interval: a hit
inside another of the same or a higher priority is suppressed, and a wide hit
is suppressed by one of a higher priority inside it.

Only DataFrame expressions are used; the rules are a constant array, and a
document's hits never leave its row.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import quoted, rest_struct
from .quality import once

#: Everything that isn't part of a word, once lower-cased.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

CAPITALS = string.ascii_uppercase
#: Length of the blocks in which a document's hits are added up.
BLOCK = 64

#: Phrases that always count, and their labels.
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]
BASE_SCORE = 0.6
#: Confidence by priority: a generic notice, a name, a name with its version or tag.
SCORES = {1: 0.5, 2: 0.8, 3: 1.0}

# License families, as label, name as a pattern over words, an
# example of the name, version numbers in words, and the prefilter's keywords,
# one of which every form of the name has.
L = "licen[cs]e"
FAMILIES = [
    ("apache", f"apache(?: software)? {L}", "apache license", ["1 0", "1 1", "2 0"], [" apache"]),
    ("mit", f"(?:mit|expat) {L}", "mit license", [], [" mit ", " expat "]),
    ("gpl", f"(?:gnu )?(?:general public {L}|gpl)", "gnu general public license", ["1 0", "2 0", "3 0"], [" general public", " gpl"]),
    ("lgpl", f"(?:gnu )?(?:(?:lesser|library) general public {L}|lgpl)", "gnu lesser general public license", ["2 0", "2 1", "3 0"], [" general public", " lgpl"]),
    ("agpl", f"(?:gnu )?(?:affero general public {L}|agpl)", "gnu affero general public license", ["1 0", "3 0"], [" affero", " agpl"]),
    ("gfdl", f"(?:gnu )?(?:free documentation {L}|gfdl)", "gnu free documentation license", ["1 1", "1 2", "1 3"], [" free documentation", " gfdl"]),
    ("mpl", f"(?:mozilla public {L}|mpl)", "mozilla public license", ["1 0", "1 1", "2 0"], [" mozilla", " mpl "]),
    ("epl", f"(?:eclipse public {L}|epl)", "eclipse public license", ["1 0", "2 0"], [" eclipse", " epl "]),
    ("eupl", f"(?:european union public {L}|eupl)", "european union public license", ["1 0", "1 1", "1 2"], [" european union", " eupl "]),
    ("cddl", f"(?:common development and distribution {L}|cddl)", "common development and distribution license", ["1 0", "1 1"], [" common development", " cddl "]),
    ("cpl", f"common public {L}", "common public license", ["1 0"], [" common public"]),
    ("bsd", f"bsd(?: style)? {L}", "bsd license", [], [" bsd "]),
    ("bsd-2-clause", f"(?:2|two) clause bsd {L}|simplified bsd {L}|freebsd {L}", "simplified bsd license", [], [" bsd ", " freebsd "]),
    ("bsd-3-clause", f"(?:3|three) clause bsd {L}|(?:modified|new|revised) bsd {L}", "modified bsd license", [], [" bsd "]),
    ("bsd-4-clause", f"(?:4|four) clause bsd {L}|original bsd {L}", "original bsd license", [], [" bsd "]),
    ("isc", f"isc {L}", "isc license", [], [" isc "]),
    ("zlib", f"zlib(?: libpng)? {L}", "zlib license", [], [" zlib "]),
    ("boost", f"boost software {L}", "boost software license", ["1 0"], [" boost "]),
    ("unlicense", "(?:the )?unlicense", "the unlicense", [], [" unlicense "]),
    ("wtfpl", f"do what the fuck you want to public {L}|wtfpl", "wtfpl", ["2 0"], [" want to public", " wtfpl "]),
    ("artistic", f"(?:perl )?artistic {L}", "artistic license", ["1 0", "2 0"], [" artistic "]),
    ("psf", f"python software foundation {L}", "python software foundation license", ["2 0"], [" python software"]),
    ("php", f"php {L}", "php license", ["3 0", "3 01"], [" php "]),
    ("ruby", f"ruby {L}", "ruby license", [], [" ruby "]),
    ("openssl", f"openssl {L}", "openssl license", [], [" openssl "]),
    ("postgresql", f"postgresql {L}", "postgresql license", [], [" postgresql "]),
    ("afl", f"academic free {L}", "academic free license", ["2 1", "3 0"], [" academic free"]),
    ("osl", f"open software {L}", "open software license", ["1 0", "2 1", "3 0"], [" open software"]),
    ("ofl", f"(?:sil )?open font {L}", "sil open font license", ["1 0", "1 1"], [" open font"]),
    ("odbl", f"open database {L}|odbl", "open database license", ["1 0"], [" open database", " odbl "]),
    ("odc-by", f"open data commons attribution {L}|odc by", "open data commons attribution license", ["1 0"], [" open data commons", " odc by"]),
    ("pddl", f"public domain dedication and {L}|pddl", "public domain dedication and license", ["1 0"], [" public domain dedication", " pddl "]),
    ("ogl", f"open government {L}", "open government license", ["1 0", "2 0", "3 0"], [" open government"]),
    ("ms-pl", f"microsoft public {L}|ms pl", "microsoft public license", [], [" microsoft public", " ms pl "]),
    ("ms-rl", f"microsoft reciprocal {L}|ms rl", "microsoft reciprocal license", [], [" microsoft reciprocal", " ms rl "]),
    ("cecill", f"cecill(?: free software)? {L}", "cecill license", ["1 0", "2 0", "2 1"], [" cecill "]),
    ("lppl", f"latex project public {L}|lppl", "latex project public license", ["1 0", "1 3"], [" latex project", " lppl "]),
    ("ncsa", f"(?:university of illinois )?ncsa(?: open source)? {L}", "ncsa open source license", [], [" ncsa "]),
    ("upl", f"universal permissive {L}", "universal permissive license", ["1 0"], [" universal permissive"]),
    ("sspl", f"server side public {L}|sspl", "server side public license", ["1 0"], [" server side", " sspl "]),
    ("busl", f"business source {L}|busl", "business source license", ["1 0", "1 1"], [" business source", " busl "]),
    ("elastic", f"elastic {L}", "elastic license", ["1 0", "2 0"], [" elastic "]),
    ("openrail", f"(?:bigscience |creativeml )?open ?rail(?: m)?(?: {L})?", "creativeml openrail m license", [], [" open rail", " openrail"]),
    ("llama", f"llama (?:2 |3 )?community {L}", "llama community license", [], [" llama "]),
    ("cc0", "cc0|cc zero|creative commons zero", "cc0", ["1 0"], [" cc0", " cc zero", " creative commons"]),
    ("cc-by", "cc by|creative commons attribution", "cc by", ["1 0", "2 0", "2 5", "3 0", "4 0"], [" cc by", " creative commons"]),
    ("cc-by-sa", "cc by sa|creative commons attribution share ?alike", "cc by sa", ["1 0", "2 0", "2 5", "3 0", "4 0"], [" cc by", " creative commons"]),
    ("cc-by-nc", "cc by nc|creative commons attribution non ?commercial", "cc by nc", ["1 0", "2 0", "2 5", "3 0", "4 0"], [" cc by", " creative commons"]),
    ("cc-by-nd", "cc by nd|creative commons attribution no ?deriv(?:ative)?s", "cc by nd", ["1 0", "2 0", "2 5", "3 0", "4 0"], [" cc by", " creative commons"]),
    ("cc-by-nc-sa", "cc by nc sa|creative commons attribution non ?commercial share ?alike", "cc by nc sa", ["1 0", "2 0", "2 5", "3 0", "4 0"], [" cc by", " creative commons"]),
    ("cc-by-nc-nd", "cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s", "cc by nc nd", ["1 0", "2 0", "2 5", "3 0", "4 0"], [" cc by", " creative commons"]),
]

# Notices that name no family, as label, pattern, example, keywords.
NOTICES = [
    ("reserved", "all rights reserved", "all rights reserved", [" reserved "]),
    ("reserved", "(?:todos los derechos reservados|tous droits reserves|tous droits réservés|alle rechte vorbehalten)", "alle rechte vorbehalten", [" reservados ", " tous droits ", " vorbehalten "]),
    ("copyright", "copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})?", "copyright c 2020", [" copyright "]),
    ("copyright", "copyright holders?", "copyright holder", [" copyright "]),
    ("public-domain", "(?:in|into|to) the public domain", "in the public domain", [" public domain "]),
    ("permissive", "permission is hereby granted free of charge", "permission is hereby granted free of charge", [" hereby granted "]),
    ("permissive", "permission to use copy modify and or distribute", "permission to use copy modify and or distribute", [" permission to use "]),
    ("permissive", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms", [" redistribution "]),
    ("disclaimer", "provided as is without warranty", "provided as is without warranty", [" without warranty "]),
    ("proprietary", "proprietary and confidential", "proprietary and confidential", [" proprietary "]),
    ("proprietary", "may not be (?:copied|reproduced|redistributed)", "may not be reproduced", [" may not be "]),
    ("non-commercial", "(?:for )?non ?commercial use only", "non commercial use only", [" commercial use only ", " noncommercial use only "]),
    ("unknown-license", f"(?:licensed|released|distributed) under (?:the )?(?:[^ ]+ ){{0,6}}{L}(?: version [0-9]+)?", "licensed under the some license", [" licensed under ", " released under ", " distributed under "]),
]
# Sentences of license bodies and headers, and exceptions to them,
# as label, pattern, example and keywords. None of them need name the license.
BODIES = [
    ("mit", "to any person obtaining a copy of this software and associated documentation files", "", [" associated documentation "]),
    ("mit", "this permission notice shall be included in all copies or substantial portions of the software", "", [" this permission notice "]),
    ("mit-0", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided", "", [" without restriction "]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted(?: provided that)?", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", [" with or without fee "]),
    ("postgresql", "for any purpose without fee and without a written agreement is hereby granted", "", [" written agreement "]),
    ("bsd", "redistributions of source code must retain the above copyright notice(?: this list of conditions)?", "redistributions of source code must retain the above copyright notice", [" redistributions of source "]),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice(?: this list of conditions)?", "redistributions in binary form must reproduce the above copyright notice", [" redistributions in binary "]),
    ("bsd-3-clause", "neither the names? of (?:[^ ]+ ){1,12}may be used to endorse or promote products derived from this software", "neither the name of the author nor the names of its contributors may be used to endorse or promote products derived from this software", [" to endorse or promote "]),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment", "all advertising materials mentioning features or use of this software must display the following acknowledgement", [" advertising materials "]),
    ("openssl", "this product includes software developed by the openssl project", "", [" openssl "]),
    ("apache-2.0", "you may not use this file except in compliance with the license", "", [" except in compliance "]),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "", [" agreed to in writing "]),
    ("apache-2.0", "grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:except as stated in this section )?(?:copyright|patent) license", "grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license", [" royalty free "]),
    ("gpl", "this program is free software you can redistribute it and or modify it", "", [" this program is free "]),
    ("gpl", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed", "", [" verbatim copies "]),
    ("gpl", "you may convey a work based on the program or the modifications to produce it", "", [" may convey a work "]),
    ("gpl-2.0", "you may copy and distribute verbatim copies of the program s source code as you receive it in any medium", "", [" verbatim copies "]),
    ("lgpl", "this library is free software you can redistribute it and or modify it", "", [" this library is free "]),
    ("lgpl", "a work that uses the library in isolation is not a derivative work of the library", "", [" uses the library "]),
    ("agpl-3.0", "all users interacting with it remotely through a computer network", "", [" interacting with it remotely "]),
    ("gfdl", "with no invariant sections no front cover texts and no back cover texts", "", [" invariant sections "]),
    ("or-later", "either version [0-9](?: [0-9])? of the license or at your option any later version", "either version 2 of the license or at your option any later version", [" any later version "]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "", [" source code form "]),
    ("mpl-2.0", "covered software is provided under this license on an as is basis", "", [" covered software "]),
    ("mpl-1.1", "the contents of this file are subject to the mozilla public license version 1 1", "", [" contents of this file "]),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license", "", [" accompanying materials "]),
    ("cddl", "the contents of this file are subject to the terms of the common development and distribution license", "", [" contents of this file "]),
    ("zlib", "the origin of this software must not be misrepresented you must not claim that you wrote the original software", "", [" be misrepresented "]),
    ("zlib", "altered source versions must be plainly marked as such", "", [" plainly marked "]),
    ("boost-1.0", "to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "", [" accompanying documentation "]),
    ("unlicense", "this is free and unencumbered software released into the public domain", "", [" unencumbered "]),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software", "", [" anyone is free "]),
    ("wtfpl", "you just do what the fuck you want to", "", [" you just do "]),
    ("artistic-1.0", "the intent of this document is to state the conditions under which a package may be copied", "", [" a package may be copied "]),
    ("artistic-2.0", "you may distribute verbatim copies of the source form of the standard version", "", [" standard version "]),
    ("psf", "psf is making python available to licensee on an as is basis", "", [" licensee "]),
    ("ms-pl", "if you bring a patent claim against any contributor over patents that you claim are infringed by the software", "", [" patent claim "]),
    ("ofl", "the font software may be sold as part of a larger software package but no copy", "", [" font software "]),
    ("ofl", "no modified version of the font software may use the reserved font names?", "no modified version of the font software may use the reserved font name", [" font software "]),
    ("cc0", "waive[sd]? all copyright and related (?:or|and) neighbou?ring rights", "waived all copyright and related or neighboring rights", [" related or neighbo", " related and neighbo"]),
    ("cc-by", "you must give appropriate credit provide a link to the license and indicate if changes were made", "", [" appropriate credit "]),
    ("cc-by-sa", "you must distribute your contributions under the same license as the original", "", [" your contributions "]),
    ("cc-by-nc", "you may not use the material for commercial purposes", "", [" commercial purposes "]),
    ("cc-by-nd", "you may not distribute the modified material", "", [" modified material "]),
    ("odbl", "any use of this database or works produced from (?:it|this database)", "any use of this database or works produced from it", [" this database "]),
    ("openrail", "you agree not to use the model or derivatives of the model", "", [" derivatives of the model "]),
    ("llama", "monthly active users of the products or services made available by or for licensee", "", [" monthly active users "]),
    ("commons-clause", "the grant of rights under the license will not include and the license does not grant to you the right to sell the software", "", [" right to sell "]),
    ("classpath-exception", "linking this library statically or dynamically with other modules is making a combined work based on this library", "", [" combined work "]),
    ("linking-exception", "as a special exception the copyright holders (?:of this library )?give you permission to link", "as a special exception the copyright holders of this library give you permission to link", [" special exception "]),
    ("openssl-exception", "permission to link the code of (?:[^ ]+ ){1,6}with the openssl (?:project s openssl )?library", "permission to link the code of portions of this program with the openssl library", [" openssl "]),
    ("autoconf-exception", "as part of a program that contains a configuration script generated by autoconf", "", [" generated by autoconf "]),
    ("bison-exception", "you may create a larger work that contains part or all of the bison parser skeleton", "", [" parser skeleton "]),
    ("gcc-exception", "gcc runtime library exception", "", [" gcc runtime "]),
    ("llvm-exception", "llvm exceptions?", "llvm exception", [" llvm exception"]),
]
TAG = [" spdx "]


class Rule(NamedTuple):
    label: str
    priority: int
    keywords: tuple[str, ...]
    pattern: str
    example: str


def all_rules() -> list[Rule]:
    """Every family's name; name and version; notice, with and without version;
    and tag; then the sentences of license bodies and the other notices."""
    rules = []

    def add(label: str, priority: int, pattern: str, example: str, keywords: list[str]) -> None:
        rules.append(Rule(label, priority, tuple(keywords), f" (?:{pattern})(?= )", f" {example} "))

    granted = "(?:licensed|released|distributed|available|provided|published) under (?:the )?(?:terms of (?:the )?)?"
    for label, name, example, versions, keywords in FAMILIES:
        words = label.replace("-", " ")
        add(label, 2, name, example, keywords)
        add(label, 2, f"{granted}(?:{name})", f"released under the {example}", keywords)
        add(label, 3, f"spdx {L} identifier {words}", f"spdx license identifier {words}", TAG)
        for v in versions:
            whole = v.removesuffix(" 0")
            number = f"{whole}(?: 0)?" if whole != v else v
            dotted = v.replace(" ", ".")
            add(f"{label}-{dotted}", 3, f"(?:{granted})?(?:{name})(?: international| unported)? ?(?:v|version |v )?{number}", f"{example} version {v}", keywords)
            add(f"{label}-{dotted}", 3, f"spdx {L} identifier {words} {v}(?: only| or later)?", f"spdx license identifier {words} {v}", TAG)
    for label, pattern, example, keywords in BODIES:
        add(label, 2, pattern, example or pattern, keywords)
    for label, pattern, example, keywords in NOTICES:
        add(label, 1, pattern, example, keywords)
    return rules


def words_apart(text: Column) -> Column:
    """The text's words, A-Z lower-cased, each after one space; a space at the end."""
    flat = F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), CAPITALS, CAPITALS.lower()), GAP, " "))
    return F.when(flat == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), flat, F.lit(" ")))


def spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def any_of(words: list[str]) -> str:
    """One pattern for all words, each after a space: branches by letter, so
    that few are tried at a place."""

    def branch(rest: set[str]) -> str:
        if "" in rest:
            return ""
        heads = sorted({r[0] for r in rest})
        parts = [re.escape(h) + branch({r[1:] for r in rest if r[0] == h}) for h in heads]
        return parts[0] if len(parts) == 1 else "(?:" + "|".join(parts) + ")"

    return " " + branch({w.removeprefix(" ") for w in words})


def phrase_places(phrase: str, label: str) -> Column:
    """Number, first and last start (in words) of a phrase that ``norm`` has."""
    size = phrase.count(" ") + 1

    def summary(cut: Column) -> Column:
        last = F.col("n_words") - (spaces(F.element_at(cut, -1)) - 1) - size
        return F.struct((F.size(cut) - 1).cast("long").alias("n"), spaces(cut[0]).cast("long").alias("first"), last.cast("long").alias("last"), F.lit(label).alias("label"))

    return F.transform(F.array(F.split("norm", f" {phrase}(?= )", -1)), summary)[0]


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def before(values: Column, fold: Callable[[Column, Column], Column], start: Column) -> Column:
    """For each place of an array, the fold of the values at the places before
    it. Appending copies an array, so it is done in blocks of fixed length, and
    over the blocks' totals."""

    def appended(part: Column, first: Column) -> Column:
        return F.aggregate(part, F.array(first), lambda out, x: F.concat(out, F.array(fold(F.element_at(out, -1), x))))

    def by_block(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda block: F.aggregate(block, start, lambda a, x: fold(a, x)))
        return bound(
            appended(totals, start),
            lambda carried: F.flatten(F.transform(blocks, lambda block, i: F.slice(appended(block, F.get(carried, i)), F.lit(1), F.size(block)))),
        )

    def cut(v: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(v), F.lit(BLOCK)), lambda at: at < F.size(v))
        return F.transform(starts, lambda at: F.slice(v, at + 1, F.lit(BLOCK)))

    return bound(values, lambda v: bound(cut(v), by_block))


def hits(rules: Column) -> Column:
    """All places of the given rules in ``norm``: start, end, priority, label."""

    def places(r: Column) -> Column:
        found = F.struct(F.split("norm", r["pattern"], -1).alias("between"), F.regexp_extract_all("norm", r["pattern"], F.lit(0)).alias("hit"))

        def placed(f: Column) -> Column:
            lengths = F.transform(f["hit"], lambda h, i: F.length(F.get(f["between"], i)) + F.length(h))
            return bound(
                before(lengths, lambda x, y: x + y, F.lit(0)),
                lambda at: F.transform(
                    f["hit"],
                    lambda h, i: bound(
                        F.get(at, i) + F.length(F.get(f["between"], i)),
                        lambda start: F.struct(start.alias("start"), (start + F.length(h)).alias("end"), r["priority"].alias("priority"), r["label"].alias("label")),
                    ),
                ),
            )

        return bound(found, placed)

    return F.flatten(F.transform(rules, places))


def resolved(found: Column) -> Column:
    """``found`` without hits inside one of the same or a higher priority, and
    without those that hold one of a higher priority: two sorts, and what came
    before each place of them marks the hits to leave out."""
    none, far = F.lit(-1), F.lit(2**31 - 1)

    def ends(rows: Column, p: int, other: Column, fold: Callable[[Column, Column], Column]) -> Column:
        return before(F.transform(rows, lambda x: F.when(x["d"]["priority"] >= p, x["d"]["end"]).otherwise(other)), fold, other)

    # from the right: the nearest end of a higher priority that starts no earlier
    def without_wide(rows: Column) -> Column:
        nearest = F.struct(*[ends(rows, p + 1, far, F.least).alias(f"p{p}") for p in (1, 2)])

        def narrow(near: Column) -> Column:
            end = lambda x, i: F.when(x["d"]["priority"] == 1, F.get(near["p1"], i)).when(x["d"]["priority"] == 2, F.get(near["p2"], i)).otherwise(far)
            return F.transform(F.filter(rows, lambda x, i: end(x, i) > x["d"]["end"]), lambda x: x["d"])

        return bound(nearest, narrow)

    # from the left: the furthest end of the same or a higher priority so far
    def without_inner(rows: Column) -> Column:
        furthest = F.struct(*[ends(rows, p, none, F.greatest).alias(f"p{p}") for p in (1, 2, 3)])

        def outer(far_end: Column) -> Column:
            end = lambda x, i: F.when(x["d"]["priority"] == 1, F.get(far_end["p1"], i)).when(x["d"]["priority"] == 2, F.get(far_end["p2"], i)).otherwise(F.get(far_end["p3"], i))
            return F.transform(F.filter(rows, lambda x, i: end(x, i) < x["d"]["end"]), lambda x: x["d"])

        return bound(furthest, outer)

    backward = F.sort_array(F.transform(found, lambda d: F.struct((-d["start"]).alias("s"), d["end"].alias("e"), (-d["priority"]).alias("p"), d.alias("d"))))
    forward = lambda kept: F.sort_array(
        F.transform(kept, lambda d: F.struct(d["start"].alias("s"), (-d["end"]).alias("e"), (-d["priority"]).alias("p"), d["label"].alias("l"), d.alias("d")))
    )
    return bound(forward(bound(backward, without_wide)), without_inner)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """License labels of each whole text.

    Returns ``id``, ``rest``, ``n_words``, ``n_base`` (places of the base
    phrases), ``first_word`` and ``last_word`` (their smallest and largest
    start, in words from 0; NULL without one), ``base_labels`` and ``labels``
    (arrays, distinct and sorted; ``labels`` holds the base ones too),
    ``detections`` (array of start, end, priority and label after resolution;
    places are characters of the reduced text) and ``score`` (0 to 1).

    A NULL or empty text, or one without words, has no labels and score 0; an
    empty table gives an empty one; a repeated row is judged like any other. Of
    hits on the same interval the higher priority stays, then the smaller label.
    Whole texts are read, however long; the work grows with a text's length and
    its hits (a text holds every pattern's split while it is worked on).
    """
    rules = all_rules() if rules is None else rules
    groups: dict[tuple[str, ...], list[Rule]] = {}
    for r in rules:
        groups.setdefault(r.keywords, []).append(r)
    table = F.array(
        *[
            F.struct(
                F.array(*map(F.lit, keywords)).alias("keywords"),
                F.array(*[F.struct(F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority"), F.lit(r.pattern).alias("pattern")) for r in group]).alias("rules"),
            )
            for keywords, group in groups.items()
        ]
    )
    rows = once(
        docs.select(quoted(id_col).alias("id"), rest_struct(docs, id_col, text_col).alias("rest"), words_apart(quoted(text_col)).alias("apart")),
        norm=F.col("apart"),
    ).drop("apart")
    rows = once(rows, n_words=spaces(F.col("norm")).cast("long") - 1)
    none = F.expr("cast(array() as array<string>)")
    parts = [F.when(F.contains("norm", F.lit(f" {phrase} ")), phrase_places(phrase, label)) for phrase, label in BASE]
    rows = once(rows, base=F.array_compact(F.array(*parts)))
    live = F.filter(table, lambda g: F.exists(g["keywords"], lambda k: F.contains("norm", k)))
    gate = F.col("norm").rlike(any_of([k for keywords in groups for k in keywords]))
    rows = once(rows, live=F.when(gate, F.flatten(F.transform(live, lambda g: g["rules"]))))
    rows = once(rows, found=F.when(F.size("live") > 0, hits(F.col("live"))))
    rows = once(rows, detections=F.when(F.size("found") > 0, resolved(F.col("found"))).otherwise(F.expr("cast(array() as array<struct<start: int, `end`: int, priority: int, label: string>>)")))
    labels = F.array_sort(F.array_distinct(F.transform("base", lambda b: b["label"])))
    confidence = F.array_max(F.transform("detections", lambda d: d["priority"]))
    score = F.when(confidence.isNull(), 0.0)
    for p, s in SCORES.items():
        score = score.when(confidence == p, s)
    return rows.select(
        "id",
        "rest",
        "n_words",
        F.aggregate("base", F.lit(0).cast("long"), lambda a, b: a + b["n"]).alias("n_base"),
        F.array_min(F.transform("base", lambda b: b["first"])).alias("first_word"),
        F.array_max(F.transform("base", lambda b: b["last"])).alias("last_word"),
        F.coalesce(labels, none).alias("base_labels"),
        F.array_sort(F.array_union(labels, F.transform("detections", lambda d: d["label"]))).alias("labels"),
        "detections",
        F.greatest(score, F.when(F.size("base") > 0, F.lit(BASE_SCORE)).otherwise(0.0)).alias("score"),
    )
