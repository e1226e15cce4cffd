import re

import pytest

from tidewater.llm import license_scan as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {c: c + 32 for c in range(65, 91)}


def brute(text):
    words = WORD.findall((text or "").translate(LOW))
    at = [(i, label) for phrase, label in L.BASE_PHRASES for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    return len(words), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None), ",".join(sorted({x for _, x in at}))


def rows(df):
    return sorted(tuple(r) for r in L.scan(df).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").na.fill(-1, ["doc_id"]).collect())


def test_base_equals_brute_force(documents, texts):
    assert rows(documents) == sorted((i, *brute(t)) for i, t in texts.items())


def test_odd_rows_and_empty_table(odd):
    want = sorted([(-1 if r.doc_id is None else r.doc_id, *brute(r.text)) for r in odd.select("doc_id", "text").collect()], key=repr)
    assert sorted(rows(odd), key=repr) == want
    assert L.scan(odd.limit(0)).collect() == []


def test_base_labels_stay_and_scores_are_shares(documents, odd):
    for r in L.scan(documents.select("doc_id", "text").union(odd.select("doc_id", "text"))).collect():
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1


@pytest.mark.parametrize("text, label", [
    ("SPDX-License-Identifier: MIT", "mit"), ("Licensed under the Apache License, Version 2.0", "apache-2.0"),
    ("see https://www.gnu.org/licenses/gpl-3.0.html", "gpl-3.0"), ("under CC BY-NC-SA 4.0", "cc-by-nc-sa-4.0"),
    ("GNU Lesser General Public License v2.1", "lgpl-2.1"), ("the Mozilla Public License 2.0", "mpl-2.0"), ("a 3-clause BSD text", "bsd-3-clause")])
def test_rules_find_their_license(spark, text, label):
    r = L.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert label in r.labels.split(",")


def test_rule_set_is_large_and_its_keywords_gate():
    rules = L.rule_set()
    assert len(rules) > 400
    for r in rules:
        assert WORD.fullmatch(r.keyword) and re.compile(r.pattern)


def test_suppression_equals_brute_force():
    import random
    rng, order = random.Random(3), (lambda r: r % 3)
    for _ in range(200):
        hits = [(a, a + rng.randint(1, 9), rng.randint(0, 5)) for a in (rng.randint(0, 12) for _ in range(rng.randint(0, 14)))]
        key = lambda h: (order(h[2]), h[0] - h[1], h[0], h[2])
        want = sorted(h for h in set(hits) if not any(o != h and o[0] <= h[0] and o[1] >= h[1] and key(o) < key(h) for o in hits))
        assert L.survivors(hits, order) == want


def test_detections_carry_their_places(spark):
    text = "Intro. Licensed under the MIT License. All rights reserved"
    found = L.detections(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert any(r.label == "mit" and "mit license" in text.lower()[r.start:r.end] for r in found)


GLUED = ["licensed under GPLv3", "GPLv2", "GPL3", "LGPLv2.1", "AGPLv3 only", "EUPLv1.2", "GPL_version_2", "gplversion3", "0BSD", "FreeBSD License",
         "Berkeley Software Distribution License", "Expat Licence", "the Unlicence", "\u201cMIT License\u201d", "GNU\u00a0GPL 2.0", "CDDLv1.1",
         "nocopyright 2020", "(c) copyrighted", "see mygnu.org/licenses/gpl-3.0", "CC0", "CC01.0", "spdxlicenseidentifier: MIT", "cc_by 4.0",
         "Uncreative Commons Attribution 4.0", "without warranty of any kindness", "rewtfpl.network", "PHP License 3.01"]


def test_prefilter_loses_no_detection(texts):
    import numpy as np
    sc, every = L.scanner(L.rule_set()), set(range(len(L.rule_set())))
    names = [n + g + v for _, _, names, versions, _ in L.FAMILIES for n in names for v in versions for g in ("", "v", " version ")]
    for t in GLUED + names + [t for _, t in sorted(texts.items())[:25]]:
        low = L.LOWER[np.frombuffer(t.encode(), np.uint8)]
        text = low.tobytes().decode()
        assert sc.detect(text, sc.gate(low, np.array([0, len(low)])).get(0, set())) == sc.detect(text, every), t


@pytest.mark.parametrize("text, labels", [
    ("licensed under GPLv3", {"gpl-3.0"}), ("LGPLv2.1", {"lgpl-2.1"}), ("FreeBSD License", {"bsd-2-clause"}), ("Expat License", {"mit"}), ("0BSD", {"bsd-0-clause"}),
    ("SPDX-License-Identifier: MIT OR Apache-2.0", {"mit", "apache-2.0"}),
    ("// SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note) OR (BSD-3-Clause AND ISC)\nand MPL", {"gpl-2.0", "bsd-3-clause", "isc"})])
def test_glued_names_and_whole_expressions(spark, text, labels):
    r = L.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert set(r.labels.split(",")) == labels and r.score > 0
