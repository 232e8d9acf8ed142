"""Ordered signature rules for licence scans.

Patterns are regular expressions over normalised words, one space between two
words; ``\\S+`` stands for any word. Earlier rules win over later ones of the
same priority and interval. Name rules are made from the table of families,
five forms each; text signatures are written out.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

#: Priorities: identifiers, licence texts and notices, names, loose fields.
IDENTIFIER, TEXT, NAME, FIELD = 4, 3, 2, 1
LIC = "licen[cs]e"
UNDER = (
    "(?:licensed|released|distributed|available|published|provided|covered|offered|issued|shared|redistributed) under"
    "(?: the| a)?(?: terms(?: and conditions)? of(?: the)?)?"
)

#: Label, identifier, full name and short name of licence families.
FAMILIES = (
    ("mit", "mit", f"(?:mit|expat|mit expat) {LIC}", "mit"),
    ("x11", "x11", f"x11 {LIC}", "x11"),
    ("mit-0", "mit 0", f"mit no attribution {LIC}", "mit no attribution"),
    ("isc", "isc", f"isc {LIC}", "isc"),
    ("apache-1", "apache 1 [01]", f"apache (?:software )?{LIC}(?: version| v)? (?:1|v1)(?: [01])?", "apache 1"),
    ("apache-2", "apache 2 0", f"apache (?:software )?{LIC}(?: version| v)? (?:2|v2)(?: 0)?", "apache (?:v )?(?:2|v2)(?: 0)?"),
    ("bsd-2-clause", "bsd 2 clause", f"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd) {LIC}", "bsd 2 clause"),
    ("bsd-3-clause", "bsd 3 clause", f"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd) {LIC}", "bsd 3 clause"),
    ("bsd-4-clause", "bsd 4 clause", f"(?:bsd 4 clause|4 clause bsd|original bsd) {LIC}", "bsd 4 clause"),
    ("0bsd", "0bsd", f"(?:zero clause bsd|bsd zero clause|0bsd) {LIC}", "0bsd"),
    ("gpl-1", "gpl 1 0(?: only| or later)?", f"(?:gnu )?general public {LIC}(?: version| v)? (?:1|v1)(?: 0)?", "(?:gnu )?(?:gpl 1|gpl v1|gplv1)"),
    ("gpl-2", "gpl 2 0(?: only| or later)?", f"(?:gnu )?general public {LIC}(?: version| v)? (?:2|v2)(?: 0)?", "(?:gnu )?(?:gpl 2|gpl v2|gplv2|gpl version 2)"),
    ("gpl-3", "gpl 3 0(?: only| or later)?", f"(?:gnu )?general public {LIC}(?: version| v)? (?:3|v3)(?: 0)?", "(?:gnu )?(?:gpl 3|gpl v3|gplv3|gpl version 3)"),
    ("lgpl-2", "lgpl 2 0(?: only| or later)?", f"(?:gnu )?library general public {LIC}(?: version| v)? (?:2|v2)(?: 0)?", "(?:gnu )?(?:lgpl 2|lgpl v2|lgplv2)"),
    ("lgpl-2.1", "lgpl 2 1(?: only| or later)?", f"(?:gnu )?lesser general public {LIC}(?: version| v)? (?:2|v2) 1", "(?:gnu )?(?:lgpl 2 1|lgpl v2 1|lgplv2 1)"),
    ("lgpl-3", "lgpl 3 0(?: only| or later)?", f"(?:gnu )?lesser general public {LIC}(?: version| v)? (?:3|v3)(?: 0)?", "(?:gnu )?(?:lgpl 3|lgpl v3|lgplv3)"),
    ("agpl-3", "agpl 3 0(?: only| or later)?", f"(?:gnu )?affero general public {LIC}(?: version| v)? (?:3|v3)(?: 0)?", "(?:gnu )?(?:agpl 3|agpl v3|agplv3)"),
    ("gfdl", "gfdl 1 [123](?: only| or later)?", f"(?:gnu )?free documentation {LIC}", "(?:gnu )?(?:gfdl|fdl)"),
    ("mpl-1", "mpl 1 [01]", f"mozilla public {LIC}(?: version| v)? (?:1|v1)(?: [01])?", "mpl (?:1|v1)(?: [01])?"),
    ("mpl-2", "mpl 2 0", f"mozilla public {LIC}(?: version| v)? (?:2|v2)(?: 0)?", "(?:mpl (?:2|v2)(?: 0)?|mplv2)"),
    ("epl-1", "epl 1 0", f"eclipse public {LIC}(?: version| v)? (?:1|v1)(?: 0)?", "epl (?:1|v1)(?: 0)?"),
    ("epl-2", "epl 2 0", f"eclipse public {LIC}(?: version| v)? (?:2|v2)(?: 0)?", "epl (?:2|v2)(?: 0)?"),
    ("eupl", "eupl 1 [012]", f"european union public {LIC}", "eupl"),
    ("cddl", "cddl 1 [01]", f"common development and distribution {LIC}", "cddl"),
    ("cpl", "cpl 1 0", f"common public {LIC}", "cpl"),
    ("ipl", "ipl 1 0", f"ibm public {LIC}", "ipl"),
    ("osl-3", "osl 3 0", f"open software {LIC}", "osl"),
    ("afl-3", "afl 3 0", f"academic free {LIC}", "afl"),
    ("artistic-1", "artistic 1 0", f"(?:perl )?artistic {LIC}(?: version)? 1(?: 0)?", "artistic 1"),
    ("artistic-2", "artistic 2 0", f"(?:perl )?artistic {LIC}(?: version)? 2(?: 0)?", "artistic 2"),
    ("zlib", "zlib", f"(?:zlib|zlib libpng) {LIC}", "zlib"),
    ("bsl-1", "bsl 1 0", f"boost software {LIC}", "boost"),
    ("unlicense", "unlicense", "the unlicense", "unlicense"),
    ("wtfpl", "wtfpl", f"do what the f\\S+ you want to public {LIC}", "wtfpl"),
    ("ofl", "ofl 1 [01]", f"(?:sil )?open font {LIC}", "(?:sil )?ofl"),
    ("psf-2", "(?:psf|python) 2 0", f"(?:python software foundation|psf) {LIC}", "psf"),
    ("php-3", "php 3 01?", f"php {LIC}", "php"),
    ("ruby", "ruby", f"ruby {LIC}", "ruby"),
    ("postgresql", "postgresql", f"postgresql {LIC}", "postgresql"),
    ("openssl", "openssl", f"openssl {LIC}", "openssl"),
    ("ms-pl", "ms pl", f"microsoft public {LIC}", "ms pl"),
    ("ms-rl", "ms rl", f"microsoft reciprocal {LIC}", "ms rl"),
    ("ncsa", "ncsa", f"(?:university of illinois )?ncsa(?: open source)? {LIC}", "ncsa"),
    ("w3c", "w3c", f"w3c (?:software(?: notice and)?|document) {LIC}", "w3c"),
    ("busl", "busl 1 1", f"business source {LIC}", "busl"),
    ("sspl", "sspl 1 0", f"server side public {LIC}", "sspl"),
    ("elastic-2", "elastic 2 0", f"elastic {LIC}", "elastic"),
    ("odbl", "odbl 1 0", f"open (?:data commons open )?database {LIC}", "odbl"),
    ("pddl", "pddl 1 0", f"public domain dedication and {LIC}", "pddl"),
    ("cc0", "cc0 1 0", "cc0(?: 1 0)? universal", "cc0"),
    ("cc-by", "cc by [1234] [05]", f"creative commons attribution(?: [1234] [05])?(?: \\S+){{0,2}} {LIC}", "cc by(?: [1234] [05])?"),
    ("cc-by-sa", "cc by sa [1234] [05]", "creative commons attribution (?:share alike|sharealike)", "cc by sa(?: [1234] [05])?"),
    ("cc-by-nd", "cc by nd [1234] [05]", "creative commons attribution (?:no deriv\\S+|noderiv\\S+)", "cc by nd(?: [1234] [05])?"),
    ("cc-by-nc", "cc by nc [1234] [05]", "creative commons attribution (?:non commercial|noncommercial)", "cc by nc(?: [1234] [05])?"),
    ("cc-by-nc-sa", "cc by nc sa [1234] [05]", "creative commons attribution (?:non commercial|noncommercial) (?:share alike|sharealike)", "cc by nc sa(?: [1234] [05])?"),
    ("cc-by-nc-nd", "cc by nc nd [1234] [05]", "creative commons attribution (?:non commercial|noncommercial) (?:no deriv\\S+|noderiv\\S+)", "cc by nc nd(?: [1234] [05])?"),
)

#: Label and wording of licence texts, notices and addresses.
TEXTS = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "opensource org licenses? mit(?: license)?"),
    ("bsl-1", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("bsl-1", "boost org license 1 0"),
    ("isc", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("hpnd", "permission to use copy modify(?: and)? distribute(?: and sell)? this software and its documentation for any purpose"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions"),
    ("bsd-3-clause", "neither the names? of(?: \\S+){1,9} nor the names of its contributors may be used to endorse or promote"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd-2-clause", "opensource org licenses? bsd 2 clause"),
    ("bsd-3-clause", "opensource org licenses? bsd 3 clause"),
    ("zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("zlib", "the origin of this software must not be misrepresented"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "unlicense org"),
    ("apache-2", "www apache org licenses? license 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at(?: \\S+){0,8} apache"),
    ("apache-2", "opensource org licenses? apache 2 0"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "you should have received a copy of the gnu general public license along with this program"),
    ("gpl-2", "gnu general public license as published by the free software foundation(?: either)? version 2"),
    ("gpl-3", "gnu general public license as published by the free software foundation(?: either)? version 3"),
    ("gpl-2", "gnu org licenses? (?:old licenses )?gpl 2 0"),
    ("gpl-3", "gnu org licenses? gpl 3 0"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("lgpl", "you should have received a copy of the gnu (?:lesser|library) general public license"),
    ("agpl-3", "gnu affero general public license as published by the free software foundation(?: either)? version 3"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2", "mozilla org mpl 2 0"),
    ("mpl-1", "the contents of this file are subject to the mozilla public license version 1 [01]"),
    ("epl", "the accompanying materials are made available under the terms of the eclipse public license"),
    ("epl-1", "eclipse org legal epl v10"),
    ("epl-2", "eclipse org legal epl (?:2 0|v20)"),
    ("cddl", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("ofl", "this font software is licensed under the sil open font license"),
    ("ofl", "scripts sil org ofl"),
    ("psf-2", "python software foundation license version 2"),
    ("ncsa", "permission is hereby granted free of charge(?: \\S+){1,30} to deal with the software without restriction"),
    ("cc0", "creativecommons org publicdomain zero 1 0"),
    ("cc0", "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("cc-by", "creativecommons org licenses by [1234] [05]"),
    ("cc-by-sa", "creativecommons org licenses by sa(?: [1234] [05])?"),
    ("cc-by-nd", "creativecommons org licenses by nd(?: [1234] [05])?"),
    ("cc-by-nc", "creativecommons org licenses by nc(?: [1234] [05])?"),
    ("cc-by-nc-sa", "creativecommons org licenses by nc sa(?: [1234] [05])?"),
    ("cc-by-nc-nd", "creativecommons org licenses by nc nd(?: [1234] [05])?"),
    ("public-domain", "creativecommons org publicdomain mark 1 0"),
    ("public-domain", "(?:this work|this software|this file|this text) is (?:hereby )?(?:in|released into|dedicated to|placed in) the public domain"),
    ("public-domain", "(?:released|dedicated|placed) (?:in|to|into) the public domain"),
    ("ogl-uk", "contains public sector information licensed under the open government licence"),
    ("ogl-uk", "open government licence(?: v)?(?: [123] 0)?"),
    ("proprietary", "proprietary and confidential"),
    ("proprietary", "confidential and proprietary"),
    ("proprietary", "unauthori[sz]ed (?:copying|reproduction|distribution|use)(?: \\S+){0,12} strictly prohibited"),
    ("proprietary", "this software is the confidential and proprietary information of"),
    ("proprietary", "end user license agreement"),
    ("proprietary", "no part of this (?:publication|book|work|document|site) may be reproduced"),
    ("non-commercial", "(?:for|only for) (?:personal (?:and|or) )?(?:non commercial|noncommercial) use only"),
    ("non-commercial", "not (?:be used )?for commercial (?:use|purposes)"),
    ("research-only", "for (?:academic |scientific )?research (?:purposes|use) only"),
)

#: Looser wordings, kept only where nothing better covers them.
LOOSE = (
    ("all-rights-reserved", "all rights(?: are)? reserved"),
    ("gpl", f"(?:gnu )?general public {LIC}"),
    ("lgpl", f"(?:gnu )?lesser general public {LIC}"),
    ("agpl-3", f"(?:gnu )?affero general public {LIC}"),
    ("mpl", f"mozilla public {LIC}"),
    ("epl", f"eclipse public {LIC}"),
    ("apache", f"apache (?:software )?{LIC}"),
    ("bsd", f"(?:bsd|berkeley software distribution) (?:style )?{LIC}"),
    ("artistic", f"artistic {LIC}"),
    ("creative-commons", f"creative commons(?: \\S+){{0,3}} {LIC}"),
    ("cc-by", "creative commons attribution"),
    ("gpl", "(?:under|by) the (?:gnu )?gpl"),
    ("copyright-notice", "copyright(?: c)? (?:19|20)\\d\\d"),
    ("copyright-notice", "(?:19|20)\\d\\d(?: c)? copyright"),
    ("warranty-disclaimer", "provided as is(?: and)? without (?:any )?(?:express or implied )?(?:warranty|warranties)"),
    ("warranty-disclaimer", "without warranty of any kind(?: express or implied)?"),
    ("permission", "(?:reprinted|reproduced|used) (?:with|by) (?:kind )?permission"),
    ("fair-use", "fair use notice"),
)

#: The phrases of the contract, found whatever covers them.
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

#: Words too common to tell anything; they gate no rule.
COMMON = frozenset(
    "above all along and any are as at be being by can code do end except file files following for form forms has have"
    " in included into is it its just kind list made may must name names no nor not of only open or org original"
    " part person program provided public purpose should such terms the this to type under use used user version"
    " versions want what who with without work www you".split()
)
#: Words a rule asks for at most; more would only be looked for longer.
MOST_KEYWORDS = 3

_PIECE = re.compile(r"(?:\[(\w+)\]|(\w))(\??)")
_WORD = re.compile(r"((?:(?:\[\w+\]|\w)\??)+)(?=$| |\(\?: )")


def _spelled(word: str) -> list[str]:
    """All spellings of a word with character classes and optional letters."""
    choices = [[*(some or one), *([""] if may else [])] for some, one, may in _PIECE.findall(word)]
    return ["".join(x) for x in product(*choices)]


def _cut(pattern: str, at: str) -> list[str]:
    """``pattern`` cut at a character outside of all brackets."""
    out, depth = [""], 0
    for c in pattern:
        depth += (c == "(") - (c == ")")
        if c == at and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


def _first_words(token: str) -> list[str]:
    """Words one of which every match of ``token`` begins with; none if unknown."""
    if token.startswith("(?:"):
        end = next(i for i in range(len(token)) if token[: i + 1].count("(") == token[: i + 1].count(")"))
        after = token[end + 1 :]
        if token[end - 1] == " " and after[0] == "?":
            return _first_words(after[1:])  # words that may stand before
        if after and not after.startswith("(?: "):
            return []  # may be missing, or a word goes on after it
        found = [_first_words(x) for x in _cut(token[3:end], "|")]
        return [w for words in found for w in words] if all(found) else []
    word = _WORD.match(token)
    return _spelled(word[1]) if word else []


def keywords(pattern: str) -> tuple[tuple[str, ...], ...]:
    """Sets of words: every match of ``pattern`` holds a word of each set."""
    found = [tuple(dict.fromkeys(w)) for t in _cut(pattern, " ") if (w := _first_words(t))]
    telling = [w for w in dict.fromkeys(found) if not COMMON.intersection(w) and not any(x.isdigit() for x in w)]
    found = telling or found
    return tuple(sorted(found, key=lambda w: (len(w), -len(w[0])))[:MOST_KEYWORDS])


@dataclass(frozen=True)
class Rule:
    number: int
    label: str
    priority: int
    confidence: float
    pattern: str
    need: tuple[tuple[str, ...], ...]
    base: bool = False


def _rules() -> tuple[Rule, ...]:
    made = [(label, 0, 1.0, p, True) for label, p in BASE]
    for label, spdx, full, short in FAMILIES:
        made += [
            (label, IDENTIFIER, 1.0, f"spdx license identifier {spdx}", False),
            (label, TEXT, 0.95, f"{UNDER} {full}", False),
            (label, NAME, 0.85, f"{UNDER} {short}", False),
            (label, NAME, 0.8, full, False),
            (label, FIELD, 0.6, f"(?:{LIC}|{LIC}s|{LIC}d)(?: type)? {short}", False),
        ]
    made += [(label, TEXT, 1.0, p, False) for label, p in TEXTS]
    made += [(label, FIELD, 0.5, p, False) for label, p in LOOSE]
    return tuple(Rule(i, label, pri, conf, p, keywords(p), base) for i, (label, pri, conf, p, base) in enumerate(made))


RULES = _rules()
