"""The license signatures: hand-written patterns over words, in order of priority.

A signature is a pattern of words: tokens separated by blanks, each a regular
expression of one lower-case word.  ``~tok`` is an optional word and ``..n`` a
gap of up to n words; the first token is neither.  Punctuation is no word, so
"Apache-2.0" is the three words ``apache 2 0``.
"""

from __future__ import annotations

from dataclasses import dataclass

#: Tiers, best first: identifiers, notices, versioned titles, titles, hints.
SPDX, NOTICE, VERSIONED, TITLE, HINT = range(5)
#: How sure a signature of each tier is that its license applies.
CONFIDENCE = (1.0, 0.95, 0.85, 0.6, 0.3)


@dataclass(frozen=True)
class Signature:
    """``keyword`` is a word (or one of ``a|b``) that every match holds: the prefilter."""

    label: str
    tier: int
    keyword: str
    words: str
    base: bool = False

    @property
    def regex(self) -> str:
        """Over text whose words each have a blank on both sides; group 1 is the match without the outer blanks."""
        parts = []
        for token in self.words.split(" "):
            if token.startswith(".."):
                parts.append(rf"(?:  [^ ]+){{0,{int(token[2:])}}}?")
            elif token.startswith("~"):
                parts.append(f"(?:  {token[1:]})?")
            else:
                parts.append(f"  {token}" if parts else token)
        return f" ({''.join(parts)}) "


#: The phrases every scan must report, with their labels.
BASE = (("mit", "mit", "under the mit license"), ("apache-2", "apache", "apache license version 2"), ("cc-by-nc", "nc", "cc by nc"))

_LICENSE = "licen[sc]es?"
#: label, keyword, title (words), identifier (words; empty: none).
NAMED = (
    ("mit", "mit", f"mit {_LICENSE}", "mit"),
    ("mit-0", "mit", f"mit no attribution ~{_LICENSE}", "mit 0"),
    ("x11", "x11", f"x11 {_LICENSE}", "x11"),
    ("isc", "isc", f"isc {_LICENSE}", "isc"),
    ("apache-1", "apache", f"apache ~software {_LICENSE} ~version v?1 ~0", "apache 1 0"),
    ("apache-1.1", "apache", f"apache ~software {_LICENSE} ~version v?1 1", "apache 1 1"),
    ("apache-2", "apache", f"apache ~software {_LICENSE} ~version v?2 ~0", "apache 2 0"),
    ("bsd-0", "bsd", f"(?:zero|0) clause bsd ~{_LICENSE}", "0bsd"),
    ("bsd-1", "bsd", f"(?:one|1) clause bsd ~{_LICENSE}", "bsd 1 clause"),
    ("bsd-2", "bsd", f"(?:two|2|simplified|freebsd) ~clause bsd ~{_LICENSE}", "bsd 2 clause"),
    ("bsd-3", "bsd", f"(?:three|3|new|modified|revised) ~clause bsd ~{_LICENSE}", "bsd 3 clause"),
    ("bsd-4", "bsd", f"(?:four|4|original) ~clause bsd ~{_LICENSE}", "bsd 4 clause"),
    ("bsd-3-clear", "bsd", f"clear bsd ~{_LICENSE}", "bsd 3 clause clear"),
    ("mpl-1", "mozilla", f"mozilla public {_LICENSE} ~version v?1 0", "mpl 1 0"),
    ("mpl-1.1", "mozilla", f"mozilla public {_LICENSE} ~version v?1 1", "mpl 1 1"),
    ("mpl-2", "mozilla", f"mozilla public {_LICENSE} ~version v?2 ~0", "mpl 2 0"),
    ("npl-1", "netscape", f"netscape public {_LICENSE} ~version v?1 ~0", "npl 1 0"),
    ("epl-1", "eclipse", f"eclipse public {_LICENSE} ~version v?1 ~0", "epl 1 0"),
    ("epl-2", "eclipse", f"eclipse public {_LICENSE} ~version v?2 ~0", "epl 2 0"),
    ("edl-1", "eclipse", f"eclipse distribution {_LICENSE} ~version v?1 ~0", ""),
    ("cddl-1", "cddl|distribution", f"common development and distribution {_LICENSE} ~version v?1 ~0", "cddl 1 0"),
    ("cddl-1.1", "cddl|distribution", f"common development and distribution {_LICENSE} ~version v?1 1", "cddl 1 1"),
    ("cpl-1", "common", f"common public {_LICENSE} ~version v?1 ~0", "cpl 1 0"),
    ("cpal-1", "cpal|attribution", f"common public attribution {_LICENSE} ~version v?1 ~0", "cpal 1 0"),
    ("ipl-1", "ibm", f"ibm public {_LICENSE} ~version v?1 ~0", "ipl 1 0"),
    ("eupl-1", "european|eupl", f"european union public {_LICENSE} ~version v?1 0", "eupl 1 0"),
    ("eupl-1.1", "european|eupl", f"european union public {_LICENSE} ~version v?1 1", "eupl 1 1"),
    ("eupl-1.2", "european|eupl", f"european union public {_LICENSE} ~version v?1 2", "eupl 1 2"),
    ("artistic-1", "artistic", f"artistic {_LICENSE} ~version v?1 ~0", "artistic 1 0"),
    ("artistic-2", "artistic", f"artistic {_LICENSE} ~version v?2 ~0", "artistic 2 0"),
    ("zlib", "zlib", f"zlib {_LICENSE}", "zlib"),
    ("zlib-libpng", "zlib", f"zlib libpng {_LICENSE}", ""),
    ("libpng", "libpng", f"libpng {_LICENSE}", "libpng 2 0"),
    ("unlicense", "unlicense", "the unlicense", "unlicense"),
    ("wtfpl", "wtfpl|fuck", f"do what the fuck you want to public {_LICENSE}", "wtfpl"),
    ("boost-1", "boost|bsl", f"boost software {_LICENSE} ~version v?1 ~0", "bsl 1 0"),
    ("psf-2", "python", f"python software foundation {_LICENSE} ~version ~v?2", "psf 2 0"),
    ("python-2", "python", f"python {_LICENSE} ~version v?2 ~0", "python 2 0"),
    ("ruby", "ruby", f"ruby {_LICENSE}", "ruby"),
    ("php-3", "php", f"php {_LICENSE} ~version v?3 0", "php 3 0"),
    ("php-3.01", "php", f"php {_LICENSE} ~version v?3 01", "php 3 01"),
    ("openssl", "openssl", f"openssl {_LICENSE}", "openssl"),
    ("ncsa", "ncsa|illinois", f"university of illinois ..2 open source {_LICENSE}", "ncsa"),
    ("afl-2", "academic|afl", f"academic free {_LICENSE} ~version v?2 ~[01]", "afl 2 [01]"),
    ("afl-3", "academic|afl", f"academic free {_LICENSE} ~version v?3 ~0", "afl 3 0"),
    ("osl-1", "open|osl", f"open software {_LICENSE} ~version v?1 ~[01]", "osl 1 [01]"),
    ("osl-2", "open|osl", f"open software {_LICENSE} ~version v?2 ~[01]", "osl 2 [01]"),
    ("osl-3", "open|osl", f"open software {_LICENSE} ~version v?3 ~0", "osl 3 0"),
    ("lppl-1.3", "latex|lppl", f"latex project public {_LICENSE} ~version v?1 3[ac]?", "lppl 1 3[ac]"),
    ("lppl", "latex|lppl", f"latex project public {_LICENSE}", ""),
    ("ofl-1", "sil|ofl", f"sil open font {_LICENSE} ~version v?1 0", "ofl 1 0"),
    ("ofl-1.1", "sil|ofl", f"sil open font {_LICENSE} ~version v?1 1", "ofl 1 1"),
    ("ms-pl", "microsoft|ms", f"microsoft public {_LICENSE}", "ms pl"),
    ("ms-rl", "microsoft|ms", f"microsoft reciprocal {_LICENSE}", "ms rl"),
    ("cecill-1", "cecill", f"cecill ~{_LICENSE} ~version v?1 ~[01]", "cecill 1 [01]"),
    ("cecill-2", "cecill", f"cecill ~{_LICENSE} ~version v?2 ~[01]", "cecill 2 [01]"),
    ("cecill-b", "cecill", f"cecill b ~{_LICENSE}", "cecill b"),
    ("cecill-c", "cecill", f"cecill c ~{_LICENSE}", "cecill c"),
    ("odbl-1", "database|odbl", f"open ~data ~commons ~open database {_LICENSE} ~version ~v?1 ~0", "odbl 1 0"),
    ("odc-by-1", "commons|odc", f"open data commons attribution {_LICENSE} ~version ~v?1 ~0", "odc by 1 0"),
    ("pddl-1", "domain|pddl", f"open data commons public domain dedication and {_LICENSE}", "pddl 1 0"),
    ("sspl-1", "server|sspl", f"server side public {_LICENSE} ~version ~v?1", "sspl 1 0"),
    ("busl-1.1", "business|busl", f"business source {_LICENSE} ~version ~v?1 ~1", "busl 1 1"),
    ("elastic-2", "elastic", f"elastic {_LICENSE} ~version ~v?2 ~0", "elastic 2 0"),
    ("commons-clause", "clause", f"commons clause ~{_LICENSE} ~condition", ""),
    ("sleepycat", "sleepycat", f"sleepycat {_LICENSE}", "sleepycat"),
    ("vim", "vim", f"vim {_LICENSE}", "vim"),
    ("beerware", "beerware|beer", f"(?:beerware|beer) ~ware {_LICENSE}", "beerware"),
    ("json", "json", f"json {_LICENSE}", "json"),
    ("icu", "icu", f"icu {_LICENSE}", "icu"),
    ("unicode", "unicode", f"unicode ~terms ~of ~use ~inc {_LICENSE}", "unicode dfs 2016"),
    ("w3c", "w3c", f"w3c software ~notice ~and ~document {_LICENSE}", "w3c"),
    ("curl", "curl", f"curl {_LICENSE}", "curl"),
    ("ijg", "jpeg|ijg", f"independent jpeg group {_LICENSE}", "ijg"),
    ("ftl", "freetype|ftl", f"freetype ~project {_LICENSE}", "ftl"),
    ("qpl-1", "q", f"q public {_LICENSE} ~version ~v?1 ~0", "qpl 1 0"),
    ("rpl-1.5", "reciprocal", f"reciprocal public {_LICENSE} ~version v?1 5", "rpl 1 5"),
    ("sissl", "sun", f"sun industry standards source {_LICENSE}", "sissl"),
    ("spl-1", "sun", f"sun public {_LICENSE} ~version ~v?1 ~0", "spl 1 0"),
    ("apsl-1", "apple", f"apple public source {_LICENSE} ~version v?1 ~[012]", "apsl 1 [012]"),
    ("apsl-2", "apple", f"apple public source {_LICENSE} ~version v?2 ~0", "apsl 2 0"),
    ("upl-1", "universal|upl", f"universal permissive {_LICENSE} ~version ~v?1 ~0", "upl 1 0"),
    ("watcom-1", "watcom", f"sybase open watcom public {_LICENSE}", "watcom 1 0"),
    ("zpl-2", "zope", f"zope public {_LICENSE} ~version v?2 ~[01]", "zpl 2 [01]"),
    ("ogl-1", "government", f"open government {_LICENSE} ~version v?1 ~0", "ogl uk 1 0"),
    ("ogl-2", "government", f"open government {_LICENSE} ~version v?2 ~0", "ogl uk 2 0"),
    ("ogl-3", "government", f"open government {_LICENSE} ~version v?3 ~0", "ogl uk 3 0"),
    ("etalab-2", "ouverte|etalab", "licence ouverte ~open ~licence ~version ~v?2 ~0", "etalab 2 0"),
    ("dl-de-by-2", "datenlizenz", "datenlizenz deutschland namensnennung ~version ~2 ~0", "dl de by 2 0"),
    ("blueoak-1", "oak|blueoak", f"blue oak model {_LICENSE} ~version ~1 ~0 ~0", "blueoak 1 0 0"),
    ("mulan-2", "mulan", f"mulan permissive software {_LICENSE} ~version ~v?2", "mulanpsl 2 0"),
    ("ecl-2", "educational|ecl", f"educational community {_LICENSE} ~version v?2 ~0", "ecl 2 0"),
    ("efl-2", "eiffel|efl", f"eiffel forum {_LICENSE} ~version ~v?2", "efl 2 0"),
    ("hpnd", "historical|hpnd", "historical permission notice and disclaimer", "hpnd"),
    ("openrail", "openrail", f"openrail ~m ~{_LICENSE}", "openrail"),
    ("llama-2", "llama", f"llama 2 community {_LICENSE}", ""),
    ("llama-3", "llama", f"llama 3 ~[0-9] community {_LICENSE}", ""),
)

#: The three licenses with "or later" forms: label, title words, abbreviation, versions.
COPYLEFT = (
    ("gpl", "gnu general public", "gpl", ("1 0", "2 0", "3 0")),
    ("lgpl", "gnu (?:lesser|library) general public", "lgpl", ("2 0", "2 1", "3 0")),
    ("agpl", "gnu affero general public", "agpl", ("1 0", "3 0")),
    ("gfdl", "gnu free documentation", "gfdl", ("1 1", "1 2", "1 3")),
)

#: Elements of the Creative Commons licenses: label, long name, short words.
COMMONS = (
    ("cc-by", "attribution", "by"),
    ("cc-by-sa", "attribution share ~alike", "by sa"),
    ("cc-by-nc", "attribution non ~commercial", "by nc"),
    ("cc-by-nd", "attribution no ~derivatives", "by nd"),
    ("cc-by-nc-sa", "attribution non ~commercial share ~alike", "by nc sa"),
    ("cc-by-nc-nd", "attribution non ~commercial no ~derivatives", "by nc nd"),
)
COMMONS_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")

_UNDER = "(?:under|by) the ~terms ~of ~the"


def _number(version: str) -> str:
    """The label's number: "2 0" is 2, "2 1" is 2.1."""
    return version.replace(" ", ".").removesuffix(".0")


def _spdx(label: str, words: str) -> Signature:
    return Signature(label, SPDX, "spdx", f"spdx license identifier {words}")


def _named() -> list[Signature]:
    out = []
    for label, keyword, title, identifier in NAMED:
        if identifier:
            out.append(_spdx(label, identifier))
        out.append(Signature(label, NOTICE, keyword, f"{_UNDER} {title}"))
        out.append(Signature(label, VERSIONED if any(c.isdigit() for c in label) else TITLE, keyword, title))
    return out


def _copyleft() -> list[Signature]:
    out = []
    for family, title, short, versions in COPYLEFT:
        for v in versions:
            major, minor = v.split(" ")
            label = f"{family}-{_number(v)}"
            # a point version is part of the number unless it is zero
            exact = f"{major} {minor}" if minor != "0" else f"{major} ~0"
            joined = f"{short}v?{major}"
            out += [
                _spdx(f"{label}-or-later", f"{short} {v} or later"),
                _spdx(label, f"{short} {v} ~only"),
                Signature(f"{label}-or-later", NOTICE, "gnu", f"{title} {_LICENSE} ..6 version {exact} ~of ~the ~{_LICENSE} or ..5 later ~version"),
                Signature(label, NOTICE, "gnu", f"{_UNDER} {title} {_LICENSE} ~version v?{exact}"),
                Signature(label, VERSIONED, "gnu", f"{title} {_LICENSE} ..6 version {exact}"),
                Signature(label, VERSIONED, "gnu", f"{title} {_LICENSE} v?{exact}"),
                Signature(f"{label}-or-later", VERSIONED, f"{short}|{short}{major}|{short}v{major}",
                          f"{short} ~version v?{exact} or ~any later ~version"),
                Signature(label, VERSIONED, short, f"{short} ~version v?{exact}"),
                Signature(label, VERSIONED, f"{short}{major}|{short}v{major}", f"{joined} {minor}" if minor != "0" else f"{joined} ~0"),
            ]
        out.append(Signature(family, TITLE, "gnu", f"{title} {_LICENSE}"))
        out.append(Signature(family, TITLE, short, f"{short} ~{_LICENSE}"))
    return out


def _commons() -> list[Signature]:
    out = []
    for label, name, short in COMMONS:
        for v in COMMONS_VERSIONS:
            full = f"{label}-{_number(v)}"
            out += [
                _spdx(full, f"cc {short} {v}"),
                Signature(full, NOTICE, "cc", f"licensed under cc {short} {v} ~international"),
                Signature(full, VERSIONED, "cc", f"cc {short} {v} ~international"),
                Signature(full, VERSIONED, "creative", f"creative commons {name} ~{_LICENSE} {v} ~(?:international|generic|unported) ~{_LICENSE}"),
            ]
        out.append(Signature(label, TITLE, "cc", f"cc {short}"))
        out.append(Signature(label, TITLE, "creative", f"creative commons {name} ~{_LICENSE}"))
    out += [
        _spdx("cc0-1", "cc0 1 0"),
        Signature("cc0-1", VERSIONED, "cc0", "cc0 1 0 ~universal"),
        Signature("cc0-1", VERSIONED, "creative", "creative commons zero ~v?1 ~0 ~universal"),
        Signature("cc0-1", TITLE, "cc0", "cc0"),
        Signature("cc", HINT, "creative", f"creative commons ~{_LICENSE}"),
    ]
    return out


def _texts() -> list[Signature]:
    """Sentences of the licenses' own texts, and hints that name no license."""
    return [
        Signature("mit", NOTICE, "hereby", "permission is hereby granted free of charge to any person obtaining a copy"),
        Signature("isc", NOTICE, "hereby", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
        Signature("bsd", NOTICE, "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
        Signature("bsd-3", VERSIONED, "endorse", "endorse or promote products derived from this software without specific prior written permission"),
        Signature("zlib", NOTICE, "altered", "altered source versions must be plainly marked as such"),
        Signature("unlicense", NOTICE, "unencumbered", "free and unencumbered software released into the public domain"),
        Signature("wtfpl", NOTICE, "fuck", "you just do what the fuck you want to"),
        Signature("boost-1", NOTICE, "hereby", "permission is hereby granted free of charge to any person or organization obtaining a copy"),
        Signature("gpl", NOTICE, "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license"),
        Signature("lgpl", NOTICE, "redistribute", "you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
        Signature("agpl", NOTICE, "redistribute", "you can redistribute it and or modify it under the terms of the gnu affero general public license"),
        Signature("bsd", TITLE, "bsd", f"bsd ~style {_LICENSE}"),
        Signature("apache", TITLE, "apache", f"apache ~software {_LICENSE}"),
        Signature("mpl", TITLE, "mozilla", f"mozilla public {_LICENSE}"),
        Signature("epl", TITLE, "eclipse", f"eclipse public {_LICENSE}"),
        Signature("eupl", TITLE, "eupl", "eupl"),
        Signature("cddl", TITLE, "cddl", f"cddl ~{_LICENSE}"),
        Signature("artistic", TITLE, "artistic", f"artistic {_LICENSE}"),
        Signature("public-domain", HINT, "domain", "(?:released|dedicated|placed) ~in ~to ~into the public domain"),
        Signature("proprietary", HINT, "rights", "all rights reserved"),
        Signature("proprietary", HINT, "proprietary", "proprietary and confidential"),
    ]


def signatures() -> tuple[Signature, ...]:
    """All signatures, the base phrases first; the place in this order breaks ties of a tier."""
    base = [Signature(label, NOTICE, keyword, words, True) for label, keyword, words in BASE]
    return tuple(base + _copyleft() + _commons() + _named() + _texts())
