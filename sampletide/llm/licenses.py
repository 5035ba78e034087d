"""License notices by ordered signature rules.

Rules are regular expressions over normalised words (lower case, joined by single blanks). They are written per licence
family as phrases and expanded over versions and ways of naming them, and by hand for the sentences of their texts. A rule runs only on
texts that hold its keyword. Detections are settled in order of priority: one that lies inside a detection of higher
priority, or of the same priority but longer, is suppressed. Base phrases are detections that nothing suppresses.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampletide.llm.common import mapped, travels

travels(__name__)

# Fixed values of the contract: phrase, label.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# Bytes that separate words become blanks, A-Z lower case; bytes of non-ASCII characters belong to words.
_TABLE = bytes(ord(chr(b).lower()) if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))


def _gnu(name: str, short: str, full: str, versions: str) -> list:
    rules = []
    for v in versions.split():
        number = v.replace(".", " ")
        shown = rf"{number}(?: 0)?" if " " not in number else number
        rules += [(f"{short}-{v}", short, rf"spdx license identifier {short} {shown}(?: only| or later)?", 9, 1.0),
                  (f"{short}-{v}", "gnu", rf"gnu {full} (?:public )?license(?: as published by the free software foundation)? (?:either )?(?:version|v) {shown}(?: of the license)?(?: or at your option any later version| or later| only)?", 8, 0.98),
                  (f"{short}-{v}", "gnu", rf"version {shown} of the gnu {full} (?:public )?license", 8, 0.98),
                  (f"{short}-{v}", "gnu", rf"gnu {short} (?:version |v ?)?{shown}(?: or later| only)?", 7, 0.95),
                  (f"{short}-{v}", short, rf"{short} ?v? ?{shown}(?: or later| only)?(?: license)?", 5, 0.8)]
    return [*rules, (short, "gnu", rf"(?:under|of) the (?:terms of the )?gnu {full} (?:public )?license", 4, 0.8),
            (short, "gnu", rf"gnu {full} (?:public )?license", 3, 0.7), (short, short, rf"{short} licen[cs]ed?", 3, 0.6)]


def _named(label: str, key: str, name: str, versions: str = "", spdx: str = "") -> list:
    rules = []
    for v in versions.split():
        number = v.replace(".", " ")
        shown = rf"{number}(?: 0)?" if " " not in number else number
        full = f"{label}-{v}"
        rules += [(full, key, rf"spdx license identifier {spdx or key} {shown}", 9, 1.0),
                  (full, key, rf"licen[cs]ed under the {name} (?:public )?(?:license )?(?:version|v) ?{shown}", 8, 0.98),
                  (full, key, rf"(?:terms of|subject to|under) the {name} (?:public )?(?:license )?(?:version|v) ?{shown}", 7, 0.97),
                  (full, key, rf"{name} (?:public )?licen[cs]e (?:version|v)? ?{shown}", 6, 0.95),
                  (full, key, rf"{name} {shown} licen[cs]e", 5, 0.85)]
    return [*rules, (label, key, rf"spdx license identifier {spdx or key}", 8, 0.97),
            (label, key, rf"(?:licensed|released|distributed|available|published) under (?:the |an )?(?:terms of the )?{name} (?:public )?licen[cs]e", 6, 0.95),
            (label, key, rf"under the {name} (?:public )?licen[cs]e", 4, 0.85),
            (label, key, rf"(?:the )?{name} (?:public )?licen[cs]e", 2, 0.6)]


def _creative(kind: str, words: str) -> list:
    rules = []
    for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
        number = v.replace(".", " ")
        rules += [(f"cc-{kind}-{v}", "cc by", rf"cc {kind.replace('-', ' ')} {number}(?: international| unported)?", 8, 0.97),
                  (f"cc-{kind}-{v}", "creative commons", rf"creative commons {words} {number}(?: international| unported)?(?: licen[cs]e)?", 8, 0.98),
                  (f"cc-{kind}-{v}", "creativecommons", rf"creativecommons org licenses {kind.replace('-', ' ')} {number}", 9, 1.0)]
    return [*rules, (f"cc-{kind}", "creative commons", rf"creative commons {words}(?: licen[cs]e)?", 4, 0.85),
            (f"cc-{kind}", "cc by", rf"cc {kind.replace('-', ' ')}(?= |$)", 3, 0.7)]


# Sentences of licence texts and of the notices they ask for, by which a text is known that never names its licence.
BODIES = (
    ("mit", "sublicense", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software", 8, 0.99),
    ("mit", "substantial portions", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", 7, 0.98),
    ("isc", "disclaims", "the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness", 7, 0.97),
    ("bsd", "redistributions", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", 7, 0.97),
    ("bsd", "redistributions", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation", 7, 0.97),
    ("bsd", "warranties", r"this software is provided by (?:\S+ ){1,8}as is and any express or implied warranties", 6, 0.9),
    ("apache-2", "in writing", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", 8, 0.98),
    ("apache-2", "compliance", "you may not use this file except in compliance with the license you may obtain a copy of the license at", 7, 0.96),
    ("apache-2", "contributor", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license", 9, 0.99),
    ("apache-2", "derivative works", "derivative works shall mean any work whether in source or object form that is based on or derived from the work", 9, 0.99),
    ("gpl", "free software", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", 7, 0.98),
    ("gpl", "in the hope", "this (?:program|software|file) is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose", 6, 0.9),
    ("gpl-1", "mercy", "the license agreements of most software companies try to keep users at the mercy of those companies", 9, 0.99),
    ("gpl-2", "freedom", "the licenses for most software are designed to take away your freedom to share and change it", 9, 0.97),
    ("gpl-2", "general public", "this license applies to any program or other work which contains a notice placed by the copyright holder saying it may be distributed under the terms of this general public license", 9, 0.99),
    ("gpl-3", "copyleft", "the gnu general public license is a free copyleft license for software and other kinds of works", 9, 0.99),
    ("gpl-3", "propagate", "to propagate a work means to do anything with it that without permission would make you directly or secondarily liable for infringement under applicable copyright law", 6, 0.9),
    ("lgpl", "library", "this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license", 8, 0.98),
    ("lgpl-2.1", "lesser", "the lesser general public license applies to some specially designated software packages typically libraries", 9, 0.99),
    ("lgpl-3", "lesser", "this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license", 9, 0.99),
    ("agpl-3", "affero", "the gnu affero general public license is a free copyleft license for software and other kinds of works", 9, 0.99),
    ("agpl-3", "remotely", "your modified version must prominently offer all users interacting with it remotely through a computer network", 9, 0.99),
    ("fdl", "free documentation", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", 8, 0.98),
    ("mpl-2.0", "mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0", 9, 1.0),
    ("mpl-2.0", "covered software", "covered software means source code form to which the initial contributor has attached the notice in exhibit a", 9, 0.99),
    ("mpl-1.1", "mozilla", "the contents of this file are subject to the mozilla public license version 1 1", 9, 1.0),
    ("epl", "eclipse", "the accompanying program is provided under the terms of this eclipse public license", 8, 0.99),
    ("epl", "recipient", "any use reproduction or distribution of the program constitutes recipient s acceptance of this agreement", 6, 0.85),
    ("cddl", "common development", "the contents of this file are subject to the terms of the common development and distribution license", 9, 1.0),
    ("cc-by", "redistribute", "you are free to share copy and redistribute the material in any medium or format", 5, 0.85),
    ("cc-by", "appropriate credit", "you must give appropriate credit provide a link to the license and indicate if changes were made", 5, 0.85),
    ("cc-by-nc", "commercial", "you may not use the material for commercial purposes", 6, 0.9),
    ("cc-by-sa", "build upon", "if you remix transform or build upon the material you must distribute your contributions under the same license as the original", 7, 0.97),
    ("cc-by-nd", "build upon", "if you remix transform or build upon the material you may not distribute the modified material", 7, 0.97),
    ("cc0", "public domain", "the person who associated a work with this deed has dedicated the work to the public domain", 9, 0.99),
    ("cc0", "waived", r"to the extent possible under law (?:\S+ ){1,12}has waived all copyright and related or neighboring rights", 9, 0.99),
    ("unlicense", "compiled binary", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary", 9, 1.0),
    ("wtfpl", "verbatim", "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed", 9, 1.0),
    ("zlib", "alter it", "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely", 9, 1.0),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented you must not claim that you wrote the original software", 8, 0.99),
    ("boost-1", "organization", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", 9, 1.0),
    ("artistic-1.0", "artistic", "the copyright holder maintains some semblance of artistic control over the development of the package", 9, 0.99),
    ("ofl", "font", "the goals of the open font license ofl are to stimulate worldwide development of collaborative font projects", 9, 0.99),
    ("postgresql", "written agreement", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted", 9, 0.99),
    ("python", "psf", "psf is making python available to licensee on an as is basis", 9, 0.99),
    ("openssl", "openssl", "this product includes software developed by the openssl project for use in the openssl toolkit", 9, 1.0),
    ("ms-pl", "accompanying", "this license governs use of the accompanying software if you use the software you accept this license", 8, 0.95),
    ("eupl", "eupl", "licensed under the eupl", 8, 0.97),
    ("json", "not evil", "the software shall be used for good not evil", 9, 1.0),
    ("beerware", "retain this notice", "as long as you retain this notice you can do whatever you want with this stuff", 9, 1.0),
)


def rules() -> list[tuple[str, tuple[bytes, ...], re.Pattern, int, float]]:
    """(label, keywords, pattern, priority, score) in order of falling priority."""
    made = [
        *_gnu("GPL", "gpl", "general", "1 2 3"), *_gnu("LGPL", "lgpl", "(?:lesser|library) general", "2 2.1 3"),
        *_gnu("AGPL", "agpl", "affero general", "1 3"), *_gnu("FDL", "gfdl", "free documentation", "1.1 1.2 1.3"),
        *_named("apache", "apache", "apache(?: software)?", "1 1.1 2"), *_named("mpl", "mozilla", "mozilla", "1.0 1.1 2.0", "mpl"),
        *_named("epl", "eclipse", "eclipse", "1.0 2.0", "epl"), *_named("cddl", "common development", "common development and distribution", "1.0 1.1"),
        *_named("eupl", "european", "european union", "1.1 1.2", "eupl"), *_named("artistic", "artistic", "(?:perl )?artistic", "1.0 2.0"),
        *_named("osl", "open software", "open software", "1.0 2.0 2.1 3.0", "osl"), *_named("afl", "academic", "academic free", "1.1 1.2 2.0 2.1 3.0", "afl"),
        *_named("cpl", "common", "common", "1.0", "cpl"), *_named("ms-pl", "microsoft", "microsoft", "", "ms pl"),
        *_named("mit", "mit", "mit"), *_named("isc", "isc", "isc"), *_named("zlib", "zlib", "zlib(?: libpng)?"), *_named("boost", "boost", "boost software", "1", "bsl"),
        *_named("bsd-2", "bsd", "(?:simplified|free|2 clause) bsd", "", "bsd 2 clause"), *_named("bsd-3", "bsd", "(?:new|modified|revised|3 clause) bsd", "", "bsd 3 clause"),
        *_named("bsd-4", "bsd", "(?:original|4 clause) bsd", "", "bsd 4 clause"), *_named("bsd", "bsd", "bsd"), *_named("wtfpl", "do what the", "do what the fuck you want to"),
        *_named("unlicense", "unlicense", "unlicense"), *_named("postgresql", "postgresql", "postgresql"), *_named("python", "python", "python(?: software foundation)?", "2"),
        *_named("php", "php", "php", "3.0 3.01"), *_named("ruby", "ruby", "ruby"), *_named("openssl", "openssl", "openssl"), *_named("w3c", "w3c", "w3c(?: software)?"),
        *_named("odbl", "open database", "(?:odc )?open database", "1.0", "odbl"), *_named("odc-by", "open data commons", "open data commons attribution", "1.0", "odc by"),
        *_named("cecill", "cecill", "cecill", "1 2 2.1"), *_named("ofl", "sil open", "sil open font", "1.0 1.1", "ofl"), *_named("ecl", "educational", "educational community", "1.0 2.0", "ecl"),
        *_creative("by", "attribution"), *_creative("by-sa", "attribution share ?alike"), *_creative("by-nc", "attribution non ?commercial"),
        *_creative("by-nd", "attribution no ?deriv(?:ative)?s?"), *_creative("by-nc-sa", "attribution non ?commercial share ?alike"),
        *_creative("by-nc-nd", "attribution non ?commercial no ?deriv(?:ative)?s?"),
        ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?", 7, 0.95), ("public-domain", "public domain", r"(?:released|dedicated|placed|donated) (?:in|in ?to|to) the public domain", 6, 0.9),
        ("public-domain", "public domain", r"public domain dedication", 6, 0.9), ("unlicense", "unencumbered", r"free and unencumbered software released into the public domain", 9, 1.0),
        ("mit", "permission", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", 9, 1.0),
        ("isc", "permission", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 9, 1.0),
        ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted", 7, 0.95),
        ("bsd-3", "neither", r"neither the name of (?:\S+ ){1,12}nor the names of its contributors may be used", 8, 0.98),
        ("bsd-4", "advertising", r"all advertising materials mentioning features or use of this software must display", 8, 0.98),
        ("zlib", "altered", r"altered source versions must be plainly marked as such", 8, 0.98), ("boost", "boost", r"boost software license version 1 0", 9, 1.0),
        ("apache-2", "apache", r"apache org licenses license 2 0", 9, 1.0), ("proprietary", "rights", r"all rights reserved", 1, 0.4),
        ("proprietary", "proprietary", r"proprietary and confidential", 3, 0.7), ("proprietary", "unauthori", r"unauthori[sz]ed copying of this (?:file|work) is strictly prohibited", 5, 0.9),
        *BODIES,
    ]
    # A pattern that cannot match without the word for licence is gated by its stem too.
    def keys(key, pattern):
        certain = re.sub(r"\(\?:[^()]*\)\?", "", pattern)
        return tuple(k.encode() for k in ("spdx" if pattern.startswith("spdx") else key, *["licen"] * ("licen" in certain)))
    return sorted(((label, keys(key, pattern), re.compile(rb"(?<![^ ])" + pattern.encode() + rb"(?![^ ])"), priority, score)
                   for label, key, pattern, priority, score in made), key=lambda r: -r[3])


RULES = rules()
# Every keyword is looked for once in a text; a rule whose keywords are not all there is not tried.
KEYWORDS = sorted({k for r in RULES for k in r[1]})
_BASE = [(re.compile(rb"(?<![^ ])" + p.encode() + rb"(?![^ ])"), p.split()[0].encode(), p.encode(), label) for p, label in BASE]


def normalised(text: str | None) -> tuple[bytes, int]:
    """Words joined by single blanks, and their number."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split(b" ")
    found = [w for w in found if w]
    return b" ".join(found), len(found)


def places(line: bytes, pattern: re.Pattern) -> list[int]:
    """Offsets of all matches, overlapping ones too."""
    out, m = [], pattern.search(line)
    while m:
        out.append(m.start())
        m = pattern.search(line, m.start() + 1)
    return out


def detections(line: bytes) -> list[tuple[int, int, str, int, float]]:
    """(start, end, label, priority, score) of the detections that nothing suppresses, by offset."""
    kept, near = [], {}
    present = {k for k in KEYWORDS if k in line}
    found = [(m.start(), m.end(), label, priority, score) for label, keys, pattern, priority, score in RULES
             if present.issuperset(keys) for m in pattern.finditer(line)]
    # Higher priority first, then longer, then earlier. `near` lists what is kept by the kilobytes it touches.
    for d in sorted(found, key=lambda d: (-d[3], d[0] - d[1], d[0], d[2])):
        if not any(k[0] <= d[0] and d[1] <= k[1] for k in near.get(d[0] >> 10, ())):
            kept.append(d)
            for block in range(d[0] >> 10, (d[1] >> 10) + 1):
                near.setdefault(block, []).append(d)
    return sorted(kept)


def scanned(text: str | None) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score."""
    line, n = normalised(text)
    starts, base = [], set()
    for pattern, _, phrase, label in _BASE:
        if phrase in line and (at := places(line, pattern)):
            starts += at
            base.add(label)
    found = detections(line)
    labels = base | {d[2] for d in found}
    word = {a: line.count(b" ", 0, a) for a in (min(starts), max(starts))} if starts else {}
    score = max([d[4] for d in found] + [0.9] * bool(base), default=0.0)
    return (n, len(starts), word[min(starts)] if starts else None, word[max(starts)] if starts else None,
            ",".join(sorted(base)), ",".join(sorted(labels)), score)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score; one row per row of `docs`.

    Null and empty texts have no words, empty labels and score 0. Ids may be null or repeat. Other columns are not read.
    """
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")

    def task(columns):
        rows = [scanned(t) for t in columns["text"].to_pylist()]
        return {"doc_id": columns["doc_id"]} | {n: [r[i] for r in rows] for i, n in enumerate(names)}
    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), task,
                  "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
                  "labels string, score double")
