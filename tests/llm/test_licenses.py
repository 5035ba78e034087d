import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sampletide.llm import licenses


def plain(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    starts, labels = [], set()
    for phrase, label in licenses.BASE:
        p = phrase.split()
        at = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
        starts += at
        labels |= {label} if at else set()
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["under", "THE", "mit", "license", "apache", "version", "2", "cc", "by", "nc", "é", "20", "-", ".\n", "by-nc"]), max_size=25))
def test_base(parts):
    text = " ".join(parts)
    assert licenses.scanned(text)[:5] == plain(text)


@pytest.mark.parametrize(("text", "labels"), [
    ("Licensed under the Apache License, Version 2.0.", "apache-2"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl-3"),
    ("SPDX-License-Identifier: LGPL-2.1-or-later", "lgpl-2.1"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("creative commons attribution non-commercial 4.0 international license", "cc-by-nc-4.0"),
    ("Mozilla Public License 2.0", "mpl-2.0"), ("nothing here", "")])
def test_labels(text, labels):
    assert set(filter(None, labels.split(","))) <= set(licenses.scanned(text)[5].split(",")) | {""}
    assert bool(labels) == bool(licenses.scanned(text)[5])


def test_contained_detections_go():
    found = [d[2] for d in licenses.detections(licenses.normalised("licensed under the apache license version 2.0")[0])]
    assert found == ["apache-2"]
    assert len(licenses.RULES) >= 300
    priorities = [r[3] for r in licenses.RULES]
    assert priorities == sorted(priorities, reverse=True)


def test_a_keyword_never_hides_a_match():
    texts = ["spdx license identifier mpl 2 0", "gnu gpl v3", "cc by sa 4 0", "licenced under the boost software license version 1", "all rights reserved",
             "gpl licensed", "under the terms of the gnu affero general public license", "python software foundation license version 2", "simplified bsd license"]
    for _, keys, pattern, _, _ in licenses.RULES:  # a keyword is part of what a pattern must match
        bare = re.sub(r"\(\?:[^()]*\)\?", "", pattern.pattern.decode()).replace("[cs]", "c")
        assert all(k.decode() in bare for k in keys), (keys, bare)
    for text in texts:
        line = licenses.normalised(text)[0]
        for _, keys, pattern, _, _ in licenses.RULES:
            assert not pattern.search(line) or all(k in line for k in keys), (text, pattern)


def test_odd_rows(odd, no_documents):
    rows = licenses.scan(odd).collect()
    assert len(rows) == 9 and {r.labels for r in rows} == {""} and {r.score for r in rows} == {0.0}
    assert licenses.scan(no_documents).count() == 0


@pytest.mark.parametrize(("text", "label"), [
    ("// This Source Code Form is subject to the terms of the Mozilla Public\n// License, v. 2.0.", "mpl-2.0"),
    ("This library is free software; you can redistribute it and/or\n * modify it under the terms of the GNU Lesser General Public\n * License", "lgpl"),
    ("The licenses for most software are designed to take away your\nfreedom to share and change it.", "gpl-2"),
    ("your modified version must prominently offer all users\ninteracting with it remotely through a computer network", "agpl-3"),
    ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES", "bsd"),
    ("Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS", "apache-2"),
    ("The origin of this software must not be misrepresented; you must not claim that you wrote the original software.", "zlib"),
    ("To the extent possible under law, the author of this work has waived all copyright and related or neighboring rights", "cc0"),
    ("If you remix, transform, or build upon the material, you must distribute your contributions under the same license as the original.", "cc-by-sa"),
    ("The Software shall be used for Good, not Evil.", "json")])
def test_texts_that_do_not_name_their_licence(text, label):
    assert label in licenses.scanned(text)[5].split(",")


def test_every_sentence_of_a_body_is_found():
    for label, _, pattern, _, _ in licenses.BODIES:
        text = pattern.replace("(?:\\S+ ){1,8}", "some people ").replace("(?:\\S+ ){1,12}", "the authors ").replace("(?:lesser|library)", "library").replace("(?:program|software|file)", "file")
        assert any(d[2] == label for d in licenses.detections(text.encode())), text


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["licensed under the apache license version 2 0", "under the", "gnu", "general public license", "version 2", "mozilla public license 2 0",
                                 "cc by nc", "cc by nc sa 4 0", "bsd license", "3 clause bsd license", "all rights reserved", "word", "mit license"]), max_size=14))
def test_suppression_against_comparing_all(parts):
    """A detection stays unless a kept one of an earlier place in the order holds it: compared one by one, without gates."""
    line = " ".join(parts).encode()
    every = sorted({(m.start(), m.end(), label, priority, score) for label, _, pattern, priority, score in licenses.RULES for m in pattern.finditer(line)},
                   key=lambda d: (-d[3], d[0] - d[1], d[0], d[2]))
    kept = []
    for d in every:
        if all(not (k[0] <= d[0] and d[1] <= k[1]) for k in kept):
            kept.append(d)
    assert licenses.detections(line) == sorted(kept)
