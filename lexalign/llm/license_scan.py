"""License scans by ordered signature rules.

Every rule is a regular expression with a label, a priority, a weight and keywords.  A text's keywords are looked up
first; only rules whose keywords all occur run.  Detections are taken by priority, then length, then position, and a
detection inside an interval that was taken before is suppressed.

Words are runs of digits, letters a-z (A-Z lower-cased) and non-ASCII characters.  Base detections are the places
where the words of a base phrase stand consecutively; they are counted in full and their labels always stay.

Defined cases: null and empty texts have no words, no places and score 0; repeated rows are scanned each on their
own; an empty table gives an empty result; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import words as W
from .tables import documents, map_texts

#: base phrases and their labels
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: label, name in words, keywords (any of them), versions with a label of their own, SPDX name
FAMILIES = [
    ("gpl", "gnu general public licen[sc]e|gnu gpl|gpl", "gnu gpl", "1.0 2.0 3.0", "gpl"),
    ("lgpl", "gnu (?:lesser|library) general public licen[sc]e|gnu lgpl|lgpl", "gnu lgpl", "2.0 2.1 3.0", "lgpl"),
    ("agpl", "gnu affero general public licen[sc]e|gnu agpl|agpl", "gnu agpl", "1.0 3.0", "agpl"),
    ("gfdl", "gnu free documentation licen[sc]e|gfdl", "gnu gfdl", "1.1 1.2 1.3", "gfdl"),
    ("apache", "apache (?:software )?licen[sc]e", "apache", "1.0 1.1 2.0", "apache"),
    ("mit", "mit licen[sc]e|expat licen[sc]e", "mit expat", "", "mit"),
    ("mit-0", "mit no attribution licen[sc]e", "attribution", "", "mit-0"),
    ("x11", "x11 licen[sc]e|mit x11 licen[sc]e", "x11", "", "x11"),
    ("isc", "isc licen[sc]e", "isc", "", "isc"),
    ("bsd", "(?:new |modified |simplified |original )?bsd(?: style)? licen[sc]e", "bsd", "", "bsd"),
    ("bsd-2-clause", "(?:2|two) clause bsd licen[sc]e|bsd (?:2|two) clause licen[sc]e", "bsd", "", "bsd-2-clause"),
    ("bsd-3-clause", "(?:3|three) clause bsd licen[sc]e|bsd (?:3|three) clause licen[sc]e", "bsd", "", "bsd-3-clause"),
    ("bsd-4-clause", "(?:4|four) clause bsd licen[sc]e|bsd (?:4|four) clause licen[sc]e", "bsd", "", "bsd-4-clause"),
    ("0bsd", "zero clause bsd licen[sc]e|0bsd", "bsd", "", "0bsd"),
    ("mpl", "mozilla public licen[sc]e", "mozilla", "1.0 1.1 2.0", "mpl"),
    ("epl", "eclipse public licen[sc]e", "eclipse", "1.0 2.0", "epl"),
    ("cddl", "common development and distribution licen[sc]e|cddl", "development cddl", "1.0 1.1", "cddl"),
    ("cpl", "common public licen[sc]e", "common", "1.0", "cpl"),
    ("ipl", "ibm public licen[sc]e", "ibm", "1.0", "ipl"),
    ("eupl", "european union public licen[sc]e|eupl", "european eupl", "1.0 1.1 1.2", "eupl"),
    ("artistic", "artistic licen[sc]e", "artistic", "1.0 2.0", "artistic"),
    ("zlib", "zlib(?: libpng)? licen[sc]e", "zlib", "", "zlib"),
    ("bsl", "boost software licen[sc]e", "boost", "1.0", "bsl"),
    ("unlicense", "the unlicen[sc]e|unlicen[sc]e org", "unlicen", "", "unlicense"),
    ("wtfpl", "do what the fuck you want to public licen[sc]e|wtfpl", "fuck wtfpl", "", "wtfpl"),
    ("cc0", "cc0|creative commons zero", "cc0 creative", "1.0", "cc0"),
    ("cc-by", "(?:cc|creative commons) (?:by|attribution)", "cc creative", "1.0 2.0 2.5 3.0 4.0", "cc-by"),
    ("cc-by-sa", "(?:cc|creative commons) (?:by|attribution) (?:sa|share ?alike)", "cc creative", "1.0 2.0 2.5 3.0 4.0", "cc-by-sa"),
    ("cc-by-nd", "(?:cc|creative commons) (?:by|attribution) (?:nd|no ?deriv[a-z]*)", "cc creative", "1.0 2.0 2.5 3.0 4.0", "cc-by-nd"),
    ("cc-by-nc", "(?:cc|creative commons) (?:by|attribution) (?:nc|non ?commercial)", "cc creative", "1.0 2.0 2.5 3.0 4.0", "cc-by-nc"),
    ("cc-by-nc-sa", "(?:cc|creative commons) (?:by|attribution) (?:nc|non ?commercial) (?:sa|share ?alike)", "cc creative",
     "1.0 2.0 2.5 3.0 4.0", "cc-by-nc-sa"),
    ("cc-by-nc-nd", "(?:cc|creative commons) (?:by|attribution) (?:nc|non ?commercial) (?:nd|no ?deriv[a-z]*)", "cc creative",
     "1.0 2.0 2.5 3.0 4.0", "cc-by-nc-nd"),
    ("ofl", "sil open font licen[sc]e|open font licen[sc]e", "font", "1.0 1.1", "ofl"),
    ("ms-pl", "microsoft public licen[sc]e", "microsoft", "", "ms-pl"),
    ("ms-rl", "microsoft reciprocal licen[sc]e", "microsoft", "", "ms-rl"),
    ("psf", "python software foundation licen[sc]e|psf licen[sc]e", "python psf", "2.0", "psf"),
    ("php", "php licen[sc]e", "php", "3.0 3.01", "php"),
    ("ruby", "ruby licen[sc]e", "ruby", "", "ruby"),
    ("openssl", "openssl licen[sc]e", "openssl", "", "openssl"),
    ("postgresql", "postgresql licen[sc]e", "postgresql", "", "postgresql"),
    ("ncsa", "(?:university of illinois )?ncsa(?: open source)? licen[sc]e", "ncsa", "", "ncsa"),
    ("afl", "academic free licen[sc]e", "academic", "1.1 2.0 2.1 3.0", "afl"),
    ("osl", "open software licen[sc]e", "open", "1.0 2.0 2.1 3.0", "osl"),
    ("odbl", "open database licen[sc]e|odbl", "database odbl", "1.0", "odbl"),
    ("odc-by", "open data commons attribution licen[sc]e|odc by", "commons odc", "1.0", "odc-by"),
    ("pddl", "public domain dedication and licen[sc]e|pddl", "dedication pddl", "1.0", "pddl"),
    ("lppl", "latex project public licen[sc]e|lppl", "latex lppl", "1.0 1.2 1.3", "lppl"),
    ("qpl", "q public licen[sc]e", "licen", "1.0", "qpl"),
    ("sspl", "server side public licen[sc]e|sspl", "server sspl", "1.0", "sspl"),
    ("busl", "business source licen[sc]e|busl", "business busl", "1.1", "busl"),
    ("elastic", "elastic licen[sc]e", "elastic", "2.0", "elastic"),
    ("vim", "vim licen[sc]e", "vim", "", "vim"),
    ("public-domain", "(?:in|into|to) the public domain|public domain dedication", "public", "", "public-domain"),
    ("all-rights-reserved", "all rights reserved", "rights", "", "all-rights-reserved"),
]

#: a text without any of these in a word cannot match a rule or hold a base phrase
GATE = [b"licen", b"gnu", b"gpl", b"cc", b"spdx", b"creative", b"public", b"wtfpl", b"rights", b"cddl", b"eupl", b"gfdl",
        b"odbl", b"odc", b"pddl", b"lppl", b"sspl", b"busl", b"0bsd"]
_GATE = re.compile(b"|".join(GATE))

#: no rule matches more words than this
REACH = 24

_UNDER = (r"(?:licen[sc]ed|sublicen[sc]ed|released|distributed|available|published|provided|covered|redistributed|shared)"
          r" (?:under|by)(?: the)?(?: terms)?(?: of)?(?: the)?(?: conditions of the)?")
_VERSION = r"(?: licen[sc]e)?(?: (?:version|ver|v))?"


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    priority: int
    weight: float
    keywords: tuple[bytes, ...]
    pattern: re.Pattern


def _compile(words: str) -> re.Pattern:
    return re.compile(f"(?:(?<= )|^)(?:{words})(?= |$)".encode("ascii"))


def rules() -> list[Rule]:
    """All rules in order: SPDX tags, statements with and without a version, names with a version, bare names.

    Patterns run over words joined by one blank, so ``version 2.0`` is ``version 2 0``.
    """
    out = []
    for label, name, keyword, versions, spdx in FAMILIES:
        keys = tuple(k.encode() for k in keyword.split())
        name, tag = f"(?:{name})", spdx.replace("-", " ")
        for v in versions.split():
            major, minor = v.split(".")
            number = f"v?{major}(?: {minor})?(?! [0-9])" if minor == "0" else f"v?{major} {minor}"
            own = f"{label}-{v}"
            out.append(Rule(f"spdx:{own}", own, 6, 0.99, (b"spdx",), _compile(f"spdx licen[sc]e identifier {tag} {number}")))
            out.append(Rule(f"under:{own}", own, 5, 0.95, keys, _compile(f"{_UNDER} {name}{_VERSION} {number}")))
            out.append(Rule(f"named:{own}", own, 3, 0.85, keys, _compile(f"{name}{_VERSION} {number}")))
        out.append(Rule(f"spdx:{label}", label, 5, 0.98, (b"spdx",), _compile(f"spdx licen[sc]e identifier {tag}")))
        out.append(Rule(f"under:{label}", label, 4, 0.9, keys, _compile(f"{_UNDER} {name}")))
        out.append(Rule(f"bare:{label}", label, 1, 0.6, keys, _compile(name)))
    return out


_ready: list = []


def _prepared() -> tuple[list[Rule], list[tuple[re.Pattern, str]]]:
    if not _ready:
        _ready.append((rules(), [(_compile(p), label) for p, label in BASE.items()]))
    return _ready[0]


def regions(words: list[bytes]) -> list[tuple[int, int]]:
    """Word ranges around gate words, wide enough for any rule, merged where they touch."""
    out: list[list[int]] = []
    for i, word in enumerate(words):
        if _GATE.search(word):
            a, z = max(0, i - REACH), min(len(words), i + REACH + 1)
            if out and a <= out[-1][1]:
                out[-1][1] = z
            else:
                out.append([a, z])
    return [(a, z) for a, z in out]


def outermost(hits: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Hits that no hit before them contains: by priority, then the longer, then the earlier one.

    A hit that is suppressed lies inside an accepted one, so the accepted ones alone need looking at: by their start,
    of which only those within the longest hit's length can contain a hit."""
    longest = max((z - a for a, z, _ in hits), default=0)
    reached: dict[int, int] = {}
    out = []
    for a, z, r in sorted(hits, key=lambda h: (-h[2].priority, h[0] - h[1], h[0], h[2].name)):
        if not any(reached.get(x, -1) >= z for x in range(z - longest, a + 1)):
            reached[a] = max(reached.get(a, z), z)
            out.append((a, z, r))
    return sorted(out, key=lambda h: (h[0], h[1], h[2].name))


def detect(words: list[bytes]) -> tuple[list[tuple[int, int, Rule]], list[tuple[int, str]]]:
    """Accepted detections (first word, word after the last, rule) by position, and all base places (word, label)."""
    ordered, base = _prepared()
    hits: list[tuple[int, int, Rule]] = []
    places: list[tuple[int, str]] = []
    for a, z in regions(words):
        text = b" ".join(words[a:z])
        blanks = np.flatnonzero(np.frombuffer(text, np.uint8) == 0x20).tolist()
        seen: dict[bytes, bool] = {}

        def at(place: int, a: int = a, blanks: list[int] = blanks) -> int:
            return a + bisect_left(blanks, place)

        for pattern, label in base:
            places += [(at(m.start()), label) for m in pattern.finditer(text)]
        for r in ordered:
            for k in r.keywords:
                if k not in seen:
                    seen[k] = k in text
            if any(seen[k] for k in r.keywords):
                hits += [(at(m.start()), at(m.end()) + 1, r) for m in r.pattern.finditer(text)]
    return outermost(hits), sorted(places)


_SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
           "score double, rules string")


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: words, base places with their first and last start, labels, score, accepted rules.

    ``score`` is 1 - product of (1 - weight) over the accepted rules, a base place counting as a bare name.
    """

    def work(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = b.column("doc_id")
        for s in W.slices(b.column("text")):
            w = W.words(s, W.ALNUM)
            n = len(s)
            n_base = [0] * n
            first: list = [None] * n
            last: list = [None] * n
            base_labels, labels, score, names = [""] * n, [""] * n, [0.0] * n, [""] * n
            raw = w.low.tobytes()
            for k in range(n):
                if not _GATE.search(raw, s.bounds[k], s.bounds[k + 1]):
                    continue
                spans = zip(w.start[w.first[k] : w.first[k + 1]].tolist(), w.end[w.first[k] : w.first[k + 1]].tolist(),
                            strict=True)
                found, places = detect([raw[a:z] for a, z in spans])
                own = {label for _, label in places}
                doubt = float(np.prod([1 - r.weight for _, _, r in found])) if found else 1.0
                if places:
                    n_base[k], first[k], last[k] = len(places), places[0][0], places[-1][0]
                    doubt = min(doubt, 0.4)
                base_labels[k] = ",".join(sorted(own))
                labels[k] = ",".join(sorted(own | {r.label for _, _, r in found}))
                names[k] = ",".join(sorted({r.name for _, _, r in found}))
                score[k] = 1 - doubt
            yield pa.RecordBatch.from_arrays(
                [ids.slice(s.first, n), pa.array(np.diff(w.first), pa.int64()), pa.array(n_base, pa.int64()),
                 pa.array(first, pa.int64()), pa.array(last, pa.int64()), pa.array(base_labels), pa.array(labels),
                 pa.array(score, pa.float64()), pa.array(names)],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "rules"])

    return map_texts(documents(docs), work, _SCHEMA)
