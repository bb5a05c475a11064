from __future__ import annotations

import math
import re

from pairloom.llm.license_scan import BASE_PHRASES, TEMPLATES, scan_licenses
from pairloom.llm.text import PLAIN_WORD
from tests.llm import data

TEXTS = (
    "Licensed under the Apache License, Version 2.0.",
    "intro\n" * 40 + "Licensed under the Apache License, version 2 for you\n" + "tail " * 90,
    "the apache license, which is a licensed version under test",
    "CC BY cc-by CC;BY, all rights reserved. All RIGHTS\nreserved",
    "general public license general public general public license",
    "General Public Licenses",
    "Permission is hereby granted, free of charge, to a person getting a copy of this software",
    "redistribution " + "word " * 70 + "and use in source and binary forms with or without modification are permitted",
    "ccby cc  by",
    "bcc by",
    "All rights reserved",
    None,
    "",
)


def brute(text, block=64):
    words = re.findall(PLAIN_WORD, data.ascii_lower(text))
    places, base = [], set()
    for phrase, label in BASE_PHRASES:
        parts = phrase.split()
        found = [k for k in range(len(words)) if words[k : k + len(parts)] == parts]
        places += found
        base |= {label} if found else set()
    labels, best = set(base), 0.0
    for start in range(0, len(words), block // 2):
        held = set(words[start : start + block])
        for label, notice in TEMPLATES:
            wanted = set(re.findall(PLAIN_WORD, notice.lower()))
            common = len(wanted & held)
            if common >= math.ceil(0.8 * len(wanted) - 1e-9):
                labels.add(label)
                best = max(best, common / len(wanted))
    score = 1.0 if places else best
    first, last = (min(places), max(places)) if places else (None, None)
    return (len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score)


def test_against_brute_force(spark):
    given = data.rows() + [(1000 + k, text, None, None, 0) for k, text in enumerate(TEXTS)]
    have = data.check_table(scan_licenses, data.documents(spark, given))
    assert have == sorted(((r[0], *brute(r[1])) for r in given), key=repr)


def test_no_templates_or_phrases(spark):
    have = scan_licenses(data.documents(spark), base=(), templates=()).collect()
    assert all(r.labels == "" and r.n_base == 0 and r.score == 0.0 for r in have)
