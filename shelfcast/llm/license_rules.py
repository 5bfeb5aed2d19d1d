"""Signature rules of licences: names, phrases and the rules made of them.

A rule is a regular expression over normalised words that are joined by single spaces. ``#`` stands before its
anchor, the one word by which the scanner finds the places to look at; ``keyword`` is a literal that every match holds.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

# Words looked at on either side of an anchor; no rule reaches further.
REACH = 28


@dataclass(frozen=True)
class Rule:
    """Higher ``priority`` wins; of equal ones the earlier rule. ``base`` rules are never suppressed."""

    label: str
    pattern: str
    anchor: str
    keyword: str
    priority: int
    weight: float
    base: bool = False


_V = r"(?: v(?:ersion)?)?"

# Hand-written names of licences: label, pattern, a literal word that the pattern always holds, SPDX identifier as words.
NAMES = [
    ("0bsd", r"(?:0bsd|zero clause bsd)", "bsd", r"0bsd"),
    ("afl", r"academic free(?: license)?(?: (?:v|version )?[123](?: [012])?)?", "academic free", r"afl [123] [012]"),
    ("agpl", r"(?:gnu )?affero general public(?: license)?(?: v(?:ersion)? ?[13](?: 0)?)?", "affero", r"agpl [13] 0(?: only| or later)?"),
    ("apache", r"apache(?: software)?(?: (?:v|version )?(?:1 [01]|2(?: 0)?))?", "apache", r"apache (?:1 [01]|2 0)"),
    ("apsl", r"apple public source(?: license)?", "apple public", r"apsl [12] [012]"),
    ("artistic", r"(?:perl )?artistic(?: [12](?: 0)?)?", "artistic", r"artistic [12] 0(?: perl| cl8)?"),
    ("beerware", r"beer ?ware", "beer", r"beerware"),
    ("boost", r"boost software(?: license)?", "boost", r"bsl 1 0"),
    ("bsd-2-clause", r"(?:simplified bsd|freebsd|(?:two|2) clause bsd|bsd (?:two|2) clause)", "bsd", r"bsd 2 clause(?: \w+)?"),
    ("bsd-3-clause", r"(?:new bsd|modified bsd|revised bsd|(?:three|3) clause bsd|bsd (?:three|3) clause)", "bsd", r"bsd 3 clause(?: \w+)?"),
    ("bsd-4-clause", r"(?:original bsd|old bsd|(?:four|4) clause bsd|bsd (?:four|4) clause)", "bsd", r"bsd 4 clause(?: uc)?"),
    ("bsd", r"bsd(?: style)?", "bsd", r"bsd"),
    ("busl", r"business source(?: license)?(?: 1 [01])?", "business source", r"busl 1 1"),
    ("cc-by", r"(?:cc by|creative commons attribution)(?: [1234] [05])?(?: international| unported)?", "c", r"cc by [1234] [05]"),
    ("cc-by-nc", r"(?:cc by nc|creative commons attribution non ?commercial)(?: [1234] [05])?(?: international| unported)?", "nc", r"cc by nc [1234] [05]"),
    ("cc-by-nc-nd", r"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv\w+)(?: [1234] [05])?", "n", r"cc by nc nd [1234] [05]"),
    ("cc-by-nc-sa", r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: [1234] [05])?", "n", r"cc by nc sa [1234] [05]"),
    ("cc-by-nd", r"(?:cc by nd|creative commons attribution no ?deriv\w+)(?: [1234] [05])?", "n", r"cc by nd [1234] [05]"),
    ("cc-by-sa", r"(?:cc by sa|creative commons attribution share ?alike)(?: [1234] [05])?(?: international| unported)?", "sa", r"cc by sa [1234] [05]"),
    ("cc0", r"(?:cc0|cc zero|creative commons zero)(?: 1 0)?(?: universal)?", "c", r"cc0 1 0"),
    ("cddl", r"(?:cddl|common development and distribution(?: license)?)(?: 1 [01])?", "c", r"cddl 1 [01]"),
    ("cecill", r"cecill(?: [abc])?(?: [12](?: [01])?)?", "cecill", r"cecill (?:[bc]|[12] [01])"),
    ("cpal", r"common public attribution(?: license)?", "common public", r"cpal 1 0"),
    ("cpl", r"common public(?: 1 0)?", "common public", r"cpl 1 0"),
    ("ecl", r"educational community(?: license)?", "educational", r"ecl [12] 0"),
    ("epl", r"eclipse public(?: license)?(?: (?:v|version )?[12](?: 0)?)?", "eclipse", r"epl [12] 0"),
    ("eupl", r"(?:eupl|european union public(?: license| licence)?)(?: (?:v|version )?1 [012])?", "e", r"eupl 1 [012]"),
    ("fdl", r"(?:gnu )?free documentation(?: license)?(?: (?:v|version )?1 [123])?", "documentation", r"gfdl 1 [123](?: only| or later)?"),
    ("gpl", r"(?:gnu )?(?:gpl|general public(?: license)?)(?: ?v?(?:ersion)? ?[123](?: 0)?)?", "g", r"gpl [123] 0(?: only| or later)?"),
    ("hpnd", r"historical permission notice and disclaimer", "historical", r"hpnd"),
    ("ijg", r"independent jpeg group", "jpeg", r"ijg"),
    ("isc", r"isc", "isc", r"isc"),
    ("lgpl", r"(?:gnu )?(?:lgpl|(?:lesser|library) general public(?: license)?)(?: ?v?(?:ersion)? ?[23](?: [01])?)?", "l", r"lgpl [23] [01](?: only| or later)?"),
    ("lppl", r"(?:lppl|latex project public(?: license)?)(?: 1 [0123])?", "l", r"lppl 1 [0123]\w?"),
    ("mit", r"(?:mit|expat|x11)", "", r"mit"),
    ("mit-0", r"mit (?:no attribution|0)", "mit", r"mit 0"),
    ("mpl", r"mozilla public(?: license)?(?: (?:v|version )?(?:1 [01]|2(?: 0)?))?", "mozilla", r"mpl (?:1 [01]|2 0)"),
    ("ms-pl", r"microsoft public", "microsoft", r"ms pl"),
    ("ms-rl", r"microsoft reciprocal", "microsoft", r"ms rl"),
    ("mulan", r"mulan(?: psl)?(?: v[12])?", "mulan", r"mulanpsl [12] 0"),
    ("ncsa", r"(?:university of illinois ncsa|ncsa)(?: open source)?", "ncsa", r"ncsa"),
    ("odbl", r"(?:odbl|open database)(?: 1 0)?", "o", r"odbl 1 0"),
    ("ofl", r"(?:sil )?open font(?: license)?(?: 1 [01])?", "open font", r"ofl 1 [01]"),
    ("openssl", r"openssl", "openssl", r"openssl"),
    ("osl", r"open software(?: license)?(?: [123] [01])?", "open software", r"osl [123] [01]"),
    ("php", r"php(?: 3 0[01]?)?", "php", r"php 3 0[01]?"),
    ("postgresql", r"postgresql", "postgresql", r"postgresql"),
    ("psf", r"(?:python software foundation|psf|python)(?: 2)?", "p", r"psf 2 0"),
    ("qpl", r"(?:qpl|q public)", "q", r"qpl 1 0"),
    ("ruby", r"ruby", "ruby", r"ruby"),
    ("sleepycat", r"sleepycat", "sleepycat", r"sleepycat"),
    ("sspl", r"server side public(?: license)?", "server side", r"sspl 1 0"),
    ("unlicense", r"unlicense", "unlicense", r"unlicense"),
    ("upl", r"universal permissive(?: license)?", "universal", r"upl 1 0"),
    ("vim", r"vim", "vim", r"vim"),
    ("w3c", r"w3c(?: software)?(?: notice)?", "w3c", r"w3c"),
    ("wtfpl", r"(?:wtfpl|do what the f\w+ you want to public)", "w", r"wtfpl"),
    ("zlib", r"(?:zlib(?: libpng)?|zlib png)", "zlib", r"zlib(?: acknowledgement)?"),
    ("zope", r"zope public(?: license)?(?: [12] [01])?", "zope", r"zpl [12] [01]"),
]

# Hand-written sentences of licence texts: label, pattern with its anchor, keyword.
PHRASES = [
    ("mit", "#permission is hereby granted free of charge to any person obtaining a copy", "free of charge"),
    ("mit", "#permission notice shall be included in all copies or substantial portions of the software", "substantial portions"),
    ("isc", "#permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee", "with or without fee"),
    ("hpnd", "#permission to use copy modify and distribute this software and its documentation for any purpose", "and its documentation"),
    ("bsd", "#redistribution and use in source and binary forms(?: with or without modification)?(?: are permitted)?", "source and binary"),
    ("bsd", "#redistributions in binary form must reproduce the above copyright notice", "binary form"),
    ("bsd", "#redistributions of source code must retain the above copyright notice", "source code"),
    ("bsd-4-clause", "all #advertising materials mentioning features or use of this software must display", "advertising materials"),
    ("bsd-3-clause", "may be used to #endorse or promote products derived from this software", "promote products"),
    ("apache", "unless required by applicable law or agreed to in writing software #distributed under the license", "applicable law"),
    ("apache", "(?:https? )?(?:www )?apache org #licenses license 2 0", "apache org"),
    ("gpl", "you can #redistribute it and or modify it under the terms of the gnu general public license", "gnu general public"),
    ("lgpl", "you can #redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license", "general public"),
    ("agpl", "you can #redistribute it and or modify it under the terms of the gnu affero general public license", "affero"),
    ("gpl", "(?:https? )?(?:www )?gnu org #licenses(?: old licenses)? gpl", "gnu org"),
    ("lgpl", "(?:https? )?(?:www )?gnu org #licenses(?: old licenses)? lgpl", "gnu org"),
    ("agpl", "(?:https? )?(?:www )?gnu org #licenses agpl", "gnu org"),
    ("fdl", "#permission is granted to copy distribute and or modify this document", "this document"),
    ("mpl", "subject to the terms of the mozilla public #license", "mozilla"),
    ("mpl", "(?:https? )?(?:www )?mozilla org #mpl", "mozilla org"),
    ("epl", "(?:https? )?(?:www )?eclipse org legal epl \\w+ #license", "eclipse org"),
    ("cc-by", "creativecommons org #licenses by [0-9]", "creativecommons"),
    ("cc-by-nc", "creativecommons org #licenses by nc [0-9]", "creativecommons"),
    ("cc-by-nc-nd", "creativecommons org #licenses by nc nd", "creativecommons"),
    ("cc-by-nc-sa", "creativecommons org #licenses by nc sa", "creativecommons"),
    ("cc-by-nd", "creativecommons org #licenses by nd", "creativecommons"),
    ("cc-by-sa", "creativecommons org #licenses by sa", "creativecommons"),
    ("cc0", "creativecommons org publicdomain #zero", "creativecommons"),
    ("unlicense", "this is free and #unencumbered software released into the public domain", "public domain"),
    ("public-domain", "(?:released|placed|dedicated) (?:in|into|to) the public #domain", "public"),
    ("boost", "distributed under the boost software #license", "boost"),
    ("zlib", "this software is provided as is without any express or #implied warranty", "without any express"),
    ("wtfpl", "you just do what the f\\w+ you #want to", "just do what"),
    ("beerware", "you can buy me a #beer in return", "buy me"),
    ("ofl", "this font software is #licensed under the sil open font license", "font software"),
    ("proprietary", "all rights #reserved", "all rights"),
    ("proprietary", "#proprietary and confidential", "confidential"),
    ("proprietary", "#unauthorized (?:copying|reproduction|distribution|use)(?: \\w+){0,8} is (?:strictly )?prohibited", "prohibited"),
]

_TERMS = r"(?:the terms (?:and conditions )?of )?(?:either )?(?:a |an |the )?"

# How a name stands in a sentence: pattern around the name, anchor, priority, weight.
FRAMES = [
    (r"{name} #license", "license", 2, 0.8),
    (r"{name} #licence", "licence", 2, 0.8),
    (r"#license(?: is| type| name)? (?:the )?{name}", "license", 1, 0.6),
    (r"#licensed under " + _TERMS + r"{name}(?: licen[cs]e)?" + _V + r"(?: [0-9]+(?: [0-9]+)?)?", "licensed", 4, 0.95),
    (r"(?:released|distributed|available|provided|published|covered) under " + _TERMS + r"{name} #license" + _V + r"(?: [0-9]+(?: [0-9]+)?)?", "license", 4, 0.95),
]

BASE = [
    Rule("mit", "mit #license", "license", "mit", 2, 0.8, True),
    Rule("apache", "apache #license", "license", "apache", 2, 0.8, True),
    Rule("gpl", "general public #license", "license", "general public", 2, 0.8, True),
]


def rules() -> list[Rule]:
    """All rules in order: base rules, identifiers, sentences of licence texts, every name in every frame."""
    out = list(BASE)
    out += [Rule(label, rf"spdx #license identifier {spdx}", "license", "spdx", 5, 1.0) for label, _, _, spdx in NAMES]
    for label, pattern, keyword in PHRASES:
        anchor = re.match(r"\w+", pattern.split("#")[1])[0]
        out.append(Rule(label, pattern, anchor, keyword, 3, 0.9))
    for frame, anchor, priority, weight in FRAMES:
        out += [Rule(label, frame.replace("{name}", name), anchor, keyword, priority, weight) for label, name, keyword, _ in NAMES]
    return out


# Literals of which every text that any rule can match holds at least one.
GATES = ["licen", "permission", "redistribut", "advertising", "endorse", "applicable law", "zero", "unencumbered", "public domain",
         "without any express", "you want", "buy me", "all rights", "proprietary", "unauthorized", "mozilla org"]
