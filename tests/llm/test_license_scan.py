import itertools
import re
import time
from re import _constants, _parser

from llm_texts import texts_with_everything

from ledgerlens.llm.license_rules import BASE_PHRASES
from ledgerlens.llm.license_scan import detections, license_scan, rules, scan


def brute(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at, labels = [], set()
    for label, phrase in BASE_PHRASES.items():
        p = phrase.split()
        hits = [k for k in range(len(words) - len(p) + 1) if words[k : k + len(p)] == p]
        at += hits
        labels |= {label} if hits else set()
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_hundreds_of_rules_compile_and_hold_their_keyword():
    assert len(rules()) > 250
    assert len({(r.label, r.pattern.pattern) for r in rules()}) == len(rules())


def strings(pattern):
    """A string for every way through a pattern; repeated parts as often as they must, optional ones none or once."""
    out = [""]
    for op, arg in pattern:
        if op is _constants.LITERAL:
            some = [chr(arg)]
        elif op is _constants.ANY:
            some = ["0"]
        elif op is _constants.IN:
            some = ["0" if kind is _constants.CATEGORY else chr(c[0] if kind is _constants.RANGE else c) for kind, c in arg]
        elif op is _constants.SUBPATTERN:
            some = strings(arg[3])
        elif op is _constants.BRANCH:
            some = [s for branch in arg[1] for s in strings(branch)]
        elif op in (_constants.MAX_REPEAT, _constants.MIN_REPEAT):
            some = ([""] if arg[0] == 0 else []) + [s * max(1, arg[0]) for s in strings(arg[2])]
        else:
            assert op is _constants.ASSERT, op  # the blanks around
            continue
        out = [a + b for a, b in itertools.product(out, some)]
    return out


def test_the_prefilter_hides_no_match():
    hidden = []
    for rule in rules():
        for text in strings(_parser.parse(rule.pattern.pattern.decode(), re.DOTALL)):
            padded = f" {text} ".encode()
            assert rule.pattern.search(padded), (rule, text)
            if not any(keyword in padded for keyword in rule.keywords):
                hidden.append((rule.label, text))
    assert hidden == []
    for text, label in [(b"ASL 2.0 license", "apache-2.0"), (b"Expat licence", "mit"), (b"some rights reserved", "creative-commons"), (b"Licence Ouverte 2.0", "etalab-2.0")]:
        assert label in scan(text)[5].split(",")


def test_rows_equal_brute_force(docs):
    rows = texts_with_everything() + [(900, "Released under CC-BY, GNU General Public License. All rights reserved! all rights reserved")]
    got = license_scan(docs(rows)).collect()
    want = sorted((str(i), *map(str, brute(t))) for i, t in rows)
    assert sorted((str(r.doc_id), *map(str, (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels))) for r in got) == want
    assert all(0 <= r.score <= 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) for r in got)


def test_priority_and_containment():
    text = " licensed under the apache license version 2 0 the license "
    found = detections(text.encode())
    assert [(d.label, d.priority) for d in found] == [("apache-2.0", 4)]
    labels = scan(b"GNU General Public License, version 3 or later")[5]
    assert "gpl-3.0-or-later" in labels and "gpl" in labels.split(",")


def test_specific_notice_suppresses_the_general_name():
    assert "mit" in scan(b"SPDX-License-Identifier: MIT-0")[5]
    found = scan(b"SPDX-License-Identifier: MIT-0")[7]
    assert [d.label for d in found] == ["mit-0"]


def test_empty_table(docs):
    assert license_scan(docs([])).collect() == []


def test_places_in_long_licence_texts():
    """280,000 words full of detections: places are right, and found in one pass."""
    words = ("licensed under the apache license version 2 0 " * 35_000).split()
    text = " ".join(words)
    started = time.process_time()
    n_words, *_, found = scan(text.encode())
    assert time.process_time() - started < 10
    assert n_words == len(words) and len(found) >= 35_000
    short = scan(" ".join(words[:80]).encode())[-1]
    for d in found[: len(short) - 1] + found[-3:]:
        alike = [s for s in short if s.start == d.start % 8 and s.length == d.length and s.label == d.label]
        assert alike or d.start < 8
