"""The signature rules of the license scan, in order of priority.

A rule is a regex over normalised text: lower-case words with one blank between
them.  A license gives one rule for each way in which texts refer to it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

# The base phrases and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# label: regex of the name as written out; regex of the identifier's words; a word that every mention has.
LICENSES = {
    "mit": (r"mit|expat", r"mit", "mit|expat"),
    "mit-0": (r"mit no attribution|mit zero", r"mit 0", "mit"),
    "x11": (r"x11|x consortium", r"x11", "x11|consortium"),
    "apache-1.0": (r"apache(?: software)? license version 1 0", r"apache 1 0", "apache"),
    "apache-1.1": (r"apache(?: software)? license version 1 1", r"apache 1 1", "apache"),
    "apache-2.0": (r"apache(?: software)? license(?: version| v)? ?2(?: 0)?|apache 2 0", r"apache 2 0|apache2", "apache|apache2"),
    "bsd-2-clause": (r"(?:simplified|freebsd|2 clause|two clause) bsd|bsd (?:2|two) clause", r"bsd 2 clause", "bsd|freebsd"),
    "bsd-3-clause": (r"(?:new|modified|revised|3 clause|three clause) bsd|bsd (?:3|three) clause", r"bsd 3 clause", "bsd"),
    "bsd-4-clause": (r"(?:original|old|4 clause|four clause) bsd|bsd (?:4|four) clause", r"bsd 4 clause", "bsd"),
    "0bsd": (r"zero clause bsd|bsd zero clause", r"0bsd", "bsd|0bsd"),
    "isc": (r"isc|internet systems consortium", r"isc", "isc|consortium"),
    "zlib": (r"zlib(?: libpng)?", r"zlib", "zlib"),
    "libpng": (r"libpng", r"libpng(?: 2 0)?", "libpng"),
    "gpl-1.0": (r"gnu general public license v(?:ersion )?1(?: 0)?", r"gpl 1 0|gplv1", "gnu|gpl|gplv1"),
    "gpl-2.0": (r"gnu general public license v(?:ersion )?2(?: 0)?", r"gpl 2 0|gplv2", "gnu|gpl|gplv2"),
    "gpl-3.0": (r"gnu general public license v(?:ersion )?3(?: 0)?", r"gpl 3 0|gplv3", "gnu|gpl|gplv3"),
    "gpl": (r"gnu general public license|gnu gpl", r"gpl", "gnu|gpl"),
    "lgpl-2.0": (r"gnu library general public license v(?:ersion )?2(?: 0)?", r"lgpl 2 0|lgplv2", "library|lgpl|lgplv2"),
    "lgpl-2.1": (r"gnu lesser general public license v(?:ersion )?2 1", r"lgpl 2 1", "lesser|lgpl"),
    "lgpl-3.0": (r"gnu lesser general public license v(?:ersion )?3(?: 0)?", r"lgpl 3 0|lgplv3", "lesser|lgpl|lgplv3"),
    "lgpl": (r"gnu (?:lesser|library) general public license", r"lgpl", "lesser|library|lgpl"),
    "agpl-3.0": (r"gnu affero general public license v(?:ersion )?3(?: 0)?", r"agpl 3 0|agplv3", "affero|agpl|agplv3"),
    "agpl": (r"(?:gnu )?affero general public license", r"agpl", "affero|agpl"),
    "gfdl-1.2": (r"gnu free documentation license version 1 2", r"gfdl 1 2", "documentation|gfdl"),
    "gfdl-1.3": (r"gnu free documentation license version 1 3", r"gfdl 1 3", "documentation|gfdl"),
    "gfdl": (r"gnu free documentation license", r"gfdl", "documentation|gfdl"),
    "mpl-1.0": (r"mozilla public license version 1 0", r"mpl 1 0", "mozilla|mpl"),
    "mpl-1.1": (r"mozilla public license version 1 1", r"mpl 1 1", "mozilla|mpl"),
    "mpl-2.0": (r"mozilla public license(?: version| v)? 2 0", r"mpl 2 0", "mozilla|mpl"),
    "epl-1.0": (r"eclipse public license(?: version| v)? 1 0", r"epl 1 0", "eclipse|epl"),
    "epl-2.0": (r"eclipse public license(?: version| v)? 2 0", r"epl 2 0", "eclipse|epl"),
    "cddl-1.0": (r"common development and distribution license(?: version)? 1 0", r"cddl 1 0", "distribution|cddl"),
    "cddl-1.1": (r"common development and distribution license(?: version)? 1 1", r"cddl 1 1", "distribution|cddl"),
    "cpl-1.0": (r"common public license(?: version)? 1 0", r"cpl 1 0", "common|cpl"),
    "ipl-1.0": (r"ibm public license(?: version)? 1 0", r"ipl 1 0", "ibm|ipl"),
    "eupl-1.1": (r"european union public licen[cs]e(?: version| v)? ?1 1", r"eupl 1 1", "european|eupl"),
    "eupl-1.2": (r"european union public licen[cs]e(?: version| v)? ?1 2", r"eupl 1 2", "european|eupl"),
    "artistic-1.0": (r"artistic license(?: version)? 1 0", r"artistic 1 0", "artistic"),
    "artistic-2.0": (r"artistic license(?: version)? 2 0", r"artistic 2 0", "artistic"),
    "bsl-1.0": (r"boost software license(?: version)? 1 0", r"bsl 1 0", "boost|bsl"),
    "busl-1.1": (r"business source license(?: version)? 1 1", r"busl 1 1", "business|busl"),
    "unlicense": (r"unlicense", r"unlicense", "unlicense"),
    "wtfpl": (r"do what the fuck you want to public license", r"wtfpl", "wtfpl|fuck"),
    "cc0-1.0": (r"creative commons zero(?: v?1 0)?(?: universal)?", r"cc0(?: 1 0)?", "zero|cc0"),
    "afl-3.0": (r"academic free license(?: version| v)? ?3 0", r"afl 3 0", "academic|afl"),
    "osl-3.0": (r"open software license(?: version| v)? ?3 0", r"osl 3 0", "open|osl"),
    "ecl-2.0": (r"educational community license(?: version)? 2 0", r"ecl 2 0", "educational|ecl"),
    "ms-pl": (r"microsoft public license", r"ms pl", "microsoft|pl"),
    "ms-rl": (r"microsoft reciprocal license", r"ms rl", "microsoft|rl"),
    "ofl-1.1": (r"sil open font license(?: version)? 1 1", r"ofl 1 1", "font|ofl"),
    "psf-2.0": (r"python software foundation license(?: version 2)?", r"psf 2 0|python 2 0", "python|psf"),
    "php-3.01": (r"php license(?: version)? 3 01", r"php 3 01", "php"),
    "ruby": (r"ruby license", r"ruby", "ruby"),
    "vim": (r"vim license", r"vim", "vim"),
    "openssl": (r"openssl license|openssl and ssleay licenses?", r"openssl", "openssl"),
    "ncsa": (r"university of illinois (?:ncsa )?open source license", r"ncsa", "illinois|ncsa"),
    "postgresql": (r"postgresql licen[cs]e", r"postgresql", "postgresql"),
    "upl-1.0": (r"universal permissive license(?: version| v)? ?1 0", r"upl 1 0", "permissive|upl"),
    "zpl-2.1": (r"zope public license(?: version)? 2 1", r"zpl 2 1", "zope|zpl"),
    "w3c": (r"w3c software(?: notice)?(?: and)? license", r"w3c", "w3c"),
    "odbl-1.0": (r"open (?:data commons open )?database license(?: v?1 0)?", r"odbl(?: 1 0)?", "database|odbl"),
    "odc-by-1.0": (r"open data commons attribution license(?: v?1 0)?", r"odc by(?: 1 0)?", "data|odc"),
    "pddl-1.0": (r"public domain dedication and license", r"pddl(?: 1 0)?", "dedication|pddl"),
    "ogl-3.0": (r"open government licen[cs]e(?: v?3 0)?", r"ogl uk 3 0", "government|ogl"),
    "sspl-1.0": (r"server side public license(?: version 1| v1)?", r"sspl 1 0", "server|sspl"),
    "elastic-2.0": (r"elastic license(?: version)? 2 0", r"elastic 2 0", "elastic"),
    "openrail-m": (r"(?:creativeml |bigcode )?open ?rail m(?: license)?", r"openrail m?", "rail|openrail"),
    "llama-2": (r"llama 2 community license(?: agreement)?", r"llama2", "llama|llama2"),
    "beerware": (r"beer ?ware license", r"beerware", "beerware|beer"),
    "blueoak-1.0.0": (r"blue oak model license(?: 1 0 0)?", r"blueoak 1 0 0", "oak|blueoak"),
}

# The conditions of Creative Commons licenses, and the versions that name them.
_CONDITIONS = {
    "by": "attribution",
    "by-sa": "attribution share ?alike",
    "by-nd": "attribution no ?deriv(?:ative)?s",
    "by-nc": "attribution non ?commercial",
    "by-nc-sa": "attribution non ?commercial share ?alike",
    "by-nc-nd": "attribution non ?commercial no ?deriv(?:ative)?s",
}
_CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0", "")

# How a grant begins, besides "licensed".
GRANT_VERBS = ("released", "distributed", "published", "available", "provided", "covered", "redistributed")
GRANT_PREPOSITIONS = ("under", "by", "with")
_OF = r"(?: the)?(?: terms of)?(?: the)?"
_VERBS = "|".join(GRANT_VERBS)
_GRANT = rf"(?:(?:dual |re ?)?licen[cs]ed (?:under|by|with)|(?:{_VERBS}) under){_OF}"
# Much is provided by or with something; only what is called a license there is one.
_LOOSE_GRANT = rf"(?:{_VERBS}) (?:by|with){_OF}"

# Notices that name no license: label, regex, word that must be there, confidence.
NOTICES = (
    ("permissive-grant", r"permission is hereby granted free of charge to any person obtaining a copy", "hereby", 0.9),
    ("permissive-grant", r"permission to use copy modify and(?: or)? distribute this software", "permission", 0.9),
    ("permissive-grant", r"redistribution and use in source and binary forms", "redistribution", 0.9),
    ("no-warranty", r"provided as is without warranty of any kind|without any warranty", "warranty", 0.4),
    ("public-domain", r"(?:dedicated|released|placed) (?:in|in?to) the public domain|in the public domain", "domain", 0.8),
    ("proprietary", r"all rights reserved|proprietary and confidential", "rights|proprietary", 0.5),
    ("copyright", r"copyright (?:c )?(?:19|20)\d\d", "copyright", 0.3),
    ("license-mention", r"licen[cs]ed? under|see (?:the )?licen[cs]e file", "license|licensed|licence|licenced", 0.2),
)


@dataclass(frozen=True)
class Rule:
    priority: int  # a lower number wins
    label: str
    regex: re.Pattern
    keywords: frozenset  # any one of these words must be there
    gate: str  # and this word, if any
    confidence: float
    must: bytes = b""  # what the words found must hold


def _compiled(pattern: str) -> re.Pattern:
    return re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])".encode())


def _names() -> dict[str, tuple[str, str, str]]:
    names = dict(LICENSES)
    for condition, title in _CONDITIONS.items():
        for version in _CC_VERSIONS:
            end = " " + version.replace(".", " ") if version else ""
            label = f"cc-{condition}" + (f"-{version}" if version else "")
            long = rf"creative commons {title}" + (rf"(?: international| unported| generic)?{end}" if version else "")
            names[label] = (long, rf"cc {condition.replace('-', ' ')}{end}", "cc|commons")
    return names


def rules() -> list[Rule]:
    """All rules: tags first, then grants, links, written-out names, bare identifiers, and notices."""
    found = []
    for label, (name, identifier, keywords) in _names().items():
        words = frozenset(word.encode() for word in keywords.split("|"))
        link = identifier.replace("|", "|licenses ")
        forms = (
            (0, rf"spdx license identifier (?:[a-z0-9]+ ){{0,12}}?(?:{identifier})(?: only| or later)?", "spdx", 1.0),
            (1, rf"{_GRANT} (?:{name}|{identifier})(?: public)?(?: licen[cs]e)?(?: or any later version| or later)?", "", 0.95),
            (1, rf"{_LOOSE_GRANT} (?:{name}|{identifier})(?: public)? licen[cs]e(?: or any later version| or later)?", "", 0.95),
            (2, rf"https? (?:www )?[a-z0-9]+ (?:org|com|net|io) (?:[a-z0-9]+ ){{0,3}}licenses? (?:{link})", "licenses", 0.9),
            (3, rf"(?:the )?(?:{name})(?: licen[cs]e)?", "", 0.8),
            (4, rf"licen[cs]e (?:is )?(?:{identifier})|(?:{identifier}) licen[cs]ed?", "", 0.7),
        )
        for priority, pattern, gate, confidence in forms:
            must = b"licen" if priority == 3 else b""  # a bare name may be any word
            found.append(Rule(priority, label, _compiled(pattern), words, gate.encode(), confidence, must))
    for label, pattern, keywords, confidence in NOTICES:
        words = frozenset(word.encode() for word in keywords.split("|"))
        found.append(Rule(5, label, _compiled(pattern), words, b"", confidence))
    return sorted(found, key=lambda rule: rule.priority)
