"""Signature rules of licenses, written over words: lower case, one space between words, punctuation gone.

Families state a license's names, abbreviation, versions and address; notices are
sentences of license texts. ``rules`` turns them into regexes for identifier
tags, addresses, names with a version, grants and bare names. Every text that a
rule can match holds all its keywords.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

# kinds, strongest first, and what a detection of the kind is worth
KINDS = {"tag": 1.0, "notice": 0.95, "url": 0.9, "version": 0.85, "grant": 0.8, "name": 0.7, "base": 0.6}


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    kind: str
    pattern: str
    keywords: frozenset[str]

    @property
    def priority(self) -> int:
        return list(KINDS).index(self.kind)

    @property
    def base(self) -> bool:
        return self.kind == "base"


# fixed values: phrases and labels of the base detections
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# label; names, in plain words; abbreviation; versions; words of an address
FAMILIES = [
    ("gpl", "gnu general public license / general public license / gnu gpl", "gpl", "1.0 2.0 3.0", "gnu org licenses gpl"),
    ("lgpl", "gnu lesser general public license / gnu library general public license / lesser general public license", "lgpl", "2.0 2.1 3.0", "gnu org licenses lgpl"),
    ("agpl", "gnu affero general public license / affero general public license", "agpl", "1.0 3.0", "gnu org licenses agpl"),
    ("gfdl", "gnu free documentation license", "gfdl", "1.1 1.2 1.3", "gnu org licenses fdl"),
    ("apache", "apache license / apache software license / apache public license", "apache", "1.0 1.1 2.0", "apache org licenses license"),
    ("mpl", "mozilla public license", "mpl", "1.0 1.1 2.0", "mozilla org mpl"),
    ("epl", "eclipse public license", "epl", "1.0 2.0", "eclipse org legal epl"),
    ("eupl", "european union public licence / european union public license", "eupl", "1.0 1.1 1.2", "joinup ec europa eu eupl"),
    ("cddl", "common development and distribution license", "cddl", "1.0 1.1", "opensource org licenses cddl"),
    ("cpl", "common public license", "", "1.0", "opensource org licenses cpl"),
    ("afl", "academic free license", "afl", "1.1 1.2 2.0 2.1 3.0", "opensource org licenses afl"),
    ("osl", "open software license", "osl", "1.0 1.1 2.0 2.1 3.0", "opensource org licenses osl"),
    ("artistic", "artistic license", "artistic", "1.0 2.0", "perlfoundation org artistic license"),
    ("ofl", "sil open font license / open font license", "ofl", "1.0 1.1", "scripts sil org ofl"),
    ("lppl", "latex project public license", "lppl", "1.0 1.1 1.2 1.3", "latex project org lppl"),
    ("cecill", "cecill free software license agreement / cecill license", "cecill", "1.0 1.1 2.0 2.1", "cecill info licences"),
    ("ecl", "educational community license", "ecl", "1.0 2.0", "opensource org licenses ecl"),
    ("efl", "eiffel forum license", "efl", "1.0 2.0", ""),
    ("zpl", "zope public license", "zpl", "1.1 2.0 2.1", ""),
    ("php", "php license", "", "3.0 3.01", "php net license"),
    ("psf", "python software foundation license / psf license", "", "2.0", "docs python org license"),
    ("odbl", "open database license / open data commons open database license", "odbl", "1.0", "opendatacommons org licenses odbl"),
    ("odc-by", "open data commons attribution license", "odc by", "1.0", "opendatacommons org licenses by"),
    ("pddl", "open data commons public domain dedication and license", "pddl", "1.0", "opendatacommons org licenses pddl"),
    ("sspl", "server side public license", "sspl", "1.0", "mongodb com licensing server side public license"),
    ("busl", "business source license", "busl", "1.1", "mariadb com bsl11"),
    ("elastic", "elastic license", "elastic", "2.0", "elastic co licensing elastic license"),
    ("rpl", "reciprocal public license", "rpl", "1.1 1.5", ""),
    ("cpal", "common public attribution license", "cpal", "1.0", ""),
    ("ms-pl", "microsoft public license", "ms pl", "", "opensource org licenses ms pl"),
    ("ms-rl", "microsoft reciprocal license", "ms rl", "", "opensource org licenses ms rl"),
    ("mit", "mit x11 license / expat license / mit expat license / mit licence", "mit", "", "opensource org licenses mit"),
    ("mit-0", "mit no attribution license / mit no attribution", "mit 0", "", ""),
    ("x11", "x11 license", "x11", "", ""),
    ("isc", "isc license / isc licence", "isc", "", "opensource org licenses isc"),
    ("zlib", "zlib license / zlib libpng license", "zlib", "", "opensource org licenses zlib"),
    ("bsl-1.0", "boost software license", "bsl 1 0", "", "boost org license 1 0"),
    ("bsd-2-clause", "simplified bsd license / freebsd license / 2 clause bsd license / bsd 2 clause license", "bsd 2 clause", "", "opensource org licenses bsd 2 clause"),
    ("bsd-3-clause", "new bsd license / revised bsd license / modified bsd license / 3 clause bsd license / bsd 3 clause license", "bsd 3 clause", "", "opensource org licenses bsd 3 clause"),
    ("bsd-4-clause", "original bsd license / 4 clause bsd license / bsd 4 clause license", "bsd 4 clause", "", ""),
    ("0bsd", "zero clause bsd license / zero clause bsd / bsd zero clause license", "0bsd", "", ""),
    ("bsd", "bsd license / bsd style license / bsd licence", "", "", ""),
    ("unlicense", "the unlicense", "unlicense", "", "unlicense org"),
    ("wtfpl", "do what the fuck you want to public license", "wtfpl", "", "wtfpl net"),
    ("ncsa", "university of illinois ncsa open source license", "ncsa", "", ""),
    ("postgresql", "postgresql license", "postgresql", "", ""),
    ("openssl", "openssl license", "openssl", "", ""),
    ("ruby", "ruby license", "ruby", "", ""),
    ("vim", "vim license", "vim", "", ""),
    ("qpl", "q public license", "qpl 1 0", "", ""),
    ("sleepycat", "sleepycat license", "sleepycat", "", ""),
    ("w3c", "w3c software notice and license / w3c license", "w3c", "", ""),
    ("hpnd", "historical permission notice and disclaimer", "hpnd", "", ""),
    ("json", "json license", "json", "", "json org license"),
    ("beerware", "beer ware license / beerware license", "beerware", "", ""),
    ("cc0", "creative commons zero", "cc0", "1.0", "creativecommons org publicdomain zero"),
    ("public-domain", "creative commons public domain mark / creative commons public domain dedication", "", "", "creativecommons org publicdomain mark"),
]

# parts of a Creative Commons license in their order, and the words that name them
COMMONS = {"by": "attribution", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s?(?: works)?", "sa": "share ?alike"}
COMMONS_LICENSES = ["by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd"]
COMMONS_VERSIONS = "1.0 2.0 2.5 3.0 4.0"

# sentences of license texts and customary notices: label, words (regex), keywords
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission obtaining"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies", "permission notice"),
    ("isc", "permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted", "permission distribute"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution permitted"),
    ("bsd-3-clause", "neither the name of (?:[^ ]+ ){1,12}nor the names of (?:its|their) contributors may be used to endorse", "neither endorse"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display", "advertising features"),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance", "apache compliance"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "required writing"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "redistribute general"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license", "library redistribute"),
    ("gpl", "you should have received a copy of the gnu general public license", "received general"),
    ("lgpl", "you should have received a copy of the gnu (?:lesser|library) general public license", "received general"),
    ("agpl", "you should have received a copy of the gnu affero general public license", "received affero"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla subject"),
    ("mpl-2.0", "if a copy of the mpl was not distributed with this file", "mpl distributed"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", "express liable"),
    ("zlib", "altered source versions must be plainly marked as such and must not be misrepresented", "altered misrepresented"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("bsl-1.0", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation", "permission organization"),
    ("wtfpl", "you just do what the fuck you want to", "fuck"),
    ("cc0", "(?:has|have) waived all copyright and related or neighboring rights", "waived neighboring"),
    ("public-domain", "(?:this work|this file|this software|it) is (?:hereby )?(?:in|released into|placed in|dedicated to) the public domain", "public domain"),
    ("beerware", "as long as you retain this notice you can do whatever you want with this stuff", "retain whatever"),
    ("json", "the software shall be used for good not evil", "good evil"),
    ("proprietary", "all rights reserved(?: worldwide)?", "rights reserved"),
    ("proprietary", "(?:this software|this document) is (?:confidential and proprietary|proprietary and confidential)", "confidential proprietary"),
    ("proprietary", "unauthorized (?:copying|use|reproduction|distribution) of this (?:file|software|document|work) (?:via any medium )?is strictly prohibited", "unauthorized prohibited"),
    ("no-license", "no license is granted", "granted"),
]

GRANTS = "(?:licen[cs]ed|released|distributed|available|published|provided|offered|covered|used)"
UNDER = "under(?: the)?(?: terms(?: and conditions)? of)?(?: an?| the)?"


def _keywords(words: str) -> frozenset[str]:
    """The two longest words of a plain phrase."""
    return frozenset(sorted(set(words.split()), key=lambda w: (-len(w), w))[:2])


def _version(text: str) -> str:
    """Words of a version: 2.0 also as 2; never the front part of a longer one."""
    major, minor = text.split(".")
    return f"v?{major}(?: {minor})?(?! [0-9])" if minor == "0" else f"v?{major} {minor}(?! [0-9])"


def _family(label: str, names: list[str], short: str, versions: list[str], address: str) -> Iterator[Rule]:
    later = "(?: (?:or|and)(?: any)? later(?: versions?)?| only)?"
    for version in versions:
        own, number = f"{label}-{version}", _version(version)
        for name in names:
            between = "(?: (?:version|ver|v))?"
            yield Rule(f"version {name} {version}", own, "version", f"{name}{between} {number}{later}", _keywords(name))
        if short:
            yield Rule(f"tag {short} {version}", own, "tag", f"spdx license identifier {short} {number}{later}", frozenset({"spdx", *short.split()[:1]}))
            glued = f"{short}(?: (?:version|ver|v))? ?{number}{later}"
            yield Rule(f"version {short} {version}", own, "version", glued, frozenset(short.split()))
    if short:
        yield Rule(f"tag {short}", label, "tag", f"spdx license identifier {short}(?! v?[0-9])", frozenset({"spdx", *short.split()[:1]}))
    if address:
        yield Rule(f"url {label}", label, "url", address, _keywords(address))
    for name in names:
        yield Rule(f"name {name}", label, "name", name, _keywords(name))
    granted = "|".join([*names, short] if short else names)
    for name in granted.split("|"):
        yield Rule(f"grant {name}", label, "grant", f"{GRANTS} {UNDER} {name}(?: licen[cs]e)?", _keywords(name) | {"under"})


def _commons(parts: str) -> Iterator[Rule]:
    label = "cc-" + parts.replace(" ", "-")
    spelled = "creative commons " + " ".join(COMMONS[p] for p in parts.split())
    yield Rule(f"name {label}", label, "name", spelled + "(?! non ?commercial| no ?deriv| share ?alike)", frozenset({"creative", "commons"}))
    for version in COMMONS_VERSIONS.split():
        own, number = f"{label}-{version}", _version(version)
        place = "(?: (?:international|unported|generic))?"
        yield Rule(f"version {own}", own, "version", f"cc {parts}(?: license)? {number}{place}", frozenset({"cc"}))
        yield Rule(f"spelled {own}", own, "version", f"{spelled}(?: public)?(?: licen[cs]e)? {number}{place}(?: (?:public )?licen[cs]e)?", frozenset({"creative", "commons"}))
        yield Rule(f"tag {own}", own, "tag", f"spdx license identifier cc {parts} {number}", frozenset({"spdx", "cc"}))
        yield Rule(f"url {own}", own, "url", f"creativecommons org licenses {parts} {number}", frozenset({"creativecommons"}))


def rules() -> tuple[Rule, ...]:
    """All rules in their order: of equal detections the earlier rule's stays."""
    out = [Rule(f"base {label}", label, "base", phrase, frozenset(phrase.split()) - {"by"}) for phrase, label in BASE.items()]
    for i, (label, words, keywords) in enumerate(NOTICES):
        out.append(Rule(f"notice {i} {label}", label, "notice", words, frozenset(keywords.split())))
    for label, names, short, versions, address in FAMILIES:
        out.extend(_family(label, names.split(" / "), short, versions.split(), address))
    for parts in COMMONS_LICENSES:
        out.extend(_commons(parts))
    return tuple(out)
