"""Licence recognition: known sentences by identifier, then ordered rules over identifiers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from plumbline.llm import packed
from plumbline.llm.tables import in_small_batches

# Sentences of well-known licence texts and notices, normalised
# to lower-case words, and the order in which a licence has them. An identifier
# may have several wordings.
SENTENCES: dict[str, str | list[str]] = {
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-comply": "you may not use this file except in compliance with the license",
    "apache-obtain": "you may obtain a copy of the license at",
    "apache-as-is": "distributed under the license is distributed on an as is basis",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted",
    "bsd-source": "redistributions of source code must retain the above copyright notice",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice",
    "bsd-names": "may be used to endorse or promote products derived from this software",
    "cc-by-nc-notice": "licensed under cc by nc 4 0",
    "gpl-notice": "this work is licensed under the gnu general public license version 3",
    "gpl-free": ["this program is free software you can redistribute it and or modify it", "is free software you can redistribute it and or modify it"],
    "gpl-terms": "under the terms of the gnu general public license as published by",
    "lgpl-terms": ["under the terms of the gnu lesser general public license as published by", "under the terms of the gnu library general public license as published by"],
    "agpl-terms": "under the terms of the gnu affero general public license as published by",
    "gpl-warranty": ["this program is distributed in the hope that it will be useful", "is distributed in the hope that it will be useful"],
    "isc-grant": ["permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify and distribute this software for any purpose"],
    "0bsd-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is",
    "bsd-advertising": "all advertising materials mentioning features or use of this software must display the following acknowledgement",
    "unlicense-grant": "this is free and unencumbered software released into the public domain",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose",
    "zlib-altered": "altered source versions must be plainly marked as such",
    "bsl-grant": "permission is hereby granted free of charge to any person or organization obtaining a copy",
    "wtfpl-title": "do what the fuck you want to public license",
    "apache-title": "apache license version 2 0 january 2004",
    "gpl2-title": "gnu general public license version 2 june 1991",
    "gpl3-title": "gnu general public license version 3 29 june 2007",
    "lgpl2-title": "gnu library general public license version 2 june 1991",
    "lgpl21-title": "gnu lesser general public license version 2 1 february 1999",
    "lgpl3-title": "gnu lesser general public license version 3 29 june 2007",
    "agpl3-title": "gnu affero general public license version 3 19 november 2007",
    "mpl2-title": "mozilla public license version 2 0 1 definitions",
    "epl1-title": "eclipse public license v 1 0 the accompanying program is provided",
    "epl2-title": "eclipse public license v 2 0 the accompanying program is provided",
    "mit-notice": "released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy",
    "mit-keep": "the above copyright notice and this permission notice shall be included in all copies",
    "mit-as-is": "the software is provided as is without warranty of any kind",
}
RULES = [
    ("Apache-2.0", ["apache-notice", "apache-comply", "apache-obtain", "apache-as-is"]),
    ("Apache-2.0-notice", ["apache-notice"]),
    ("Apache-2.0", ["apache-title"]),
    ("BSD-4-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-names"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("CC-BY-NC-4.0-notice", ["cc-by-nc-notice"]),
    *[
        (f"{family}-{version}-{which}", [*before, f"{family.lower()}-terms", f"version-{version}-{which}", *after])
        for before, after in ((["gpl-free"], ["gpl-warranty"]), ([], []))
        for family in ("GPL", "LGPL", "AGPL")
        for version in ("1.0", "2.0", "2.1", "3.0")
        for which in ("or-later", "only")
    ],
    ("GPL-header", ["gpl-free", "gpl-terms", "gpl-warranty"]),
    ("LGPL-header", ["lgpl-terms"]),
    ("AGPL-header", ["agpl-terms"]),
    ("GPL-2.0", ["gpl2-title"]),
    ("GPL-3.0", ["gpl3-title"]),
    ("LGPL-2.0", ["lgpl2-title"]),
    ("LGPL-2.1", ["lgpl21-title"]),
    ("LGPL-3.0", ["lgpl3-title"]),
    ("AGPL-3.0", ["agpl3-title"]),
    ("MPL-2.0", ["mpl2-title"]),
    ("EPL-1.0", ["epl1-title"]),
    ("EPL-2.0", ["epl2-title"]),
    ("0BSD", ["0bsd-grant"]),
    ("BSL-1.0", ["bsl-grant"]),
    ("Unlicense", ["unlicense-grant"]),
    ("WTFPL", ["wtfpl-title"]),
    ("Zlib", ["zlib-grant", "zlib-altered"]),
    ("GPL-3.0-notice", ["gpl-notice"]),
    ("ISC", ["isc-grant"]),
    ("MIT", ["mit-grant", "mit-keep", "mit-as-is"]),
    ("MIT-notice", ["mit-notice"]),
]
# Names by which notices call a licence; a notice is one after "under" or the like.
_NAMED = {
    "MIT": ["mit license", "mit licence", "expat license"],
    "Apache-2.0": ["apache license version 2 0", "apache license 2 0", "apache license v2 0", "apache 2 0 license", "apache 2 0"],
    "Apache-1.1": ["apache license version 1 1", "apache software license version 1 1", "apache license 1 1"],
    "BSD-2-Clause": ["bsd 2 clause license", "2 clause bsd license", "simplified bsd license", "bsd 2 clause", "freebsd license"],
    "BSD-3-Clause": ["bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license", "revised bsd license", "bsd 3 clause"],
    "BSD": ["bsd license", "bsd style license", "bsd licence"],
    "0BSD": ["zero clause bsd license", "bsd zero clause license", "0bsd license"],
    "ISC": ["isc license", "isc licence"],
    "MPL-1.1": ["mozilla public license version 1 1", "mozilla public license 1 1", "mpl 1 1"],
    "MPL-2.0": ["mozilla public license version 2 0", "mozilla public license v 2 0", "mozilla public license v2 0", "mozilla public license 2 0", "mpl 2 0", "mpl v2 0"],
    "EPL-1.0": ["eclipse public license v1 0", "eclipse public license v 1 0", "eclipse public license version 1 0", "eclipse public license 1 0"],
    "EPL-2.0": ["eclipse public license v2 0", "eclipse public license v 2 0", "eclipse public license version 2 0", "eclipse public license 2 0"],
    "Unlicense": ["unlicense", "the unlicense"],
    "Zlib": ["zlib license", "zlib libpng license"],
    "BSL-1.0": ["boost software license version 1 0", "boost software license 1 0", "boost software license"],
    "Artistic-2.0": ["artistic license 2 0", "artistic license version 2 0"],
    "EUPL-1.2": ["european union public licence v 1 2", "eupl version 1 2", "eupl v 1 2", "eupl 1 2"],
    "CC0-1.0": ["cc0 1 0 universal", "cc0 1 0", "creative commons zero v1 0 universal", "creative commons cc0 1 0 universal"],
}
for _part, _long in {
    "BY": "attribution", "BY-SA": "attribution sharealike", "BY-ND": "attribution noderivatives", "BY-NC": "attribution noncommercial",
    "BY-NC-SA": "attribution noncommercial sharealike", "BY-NC-ND": "attribution noncommercial noderivatives",
}.items():
    for _version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
        _tail, _longs = _version.replace(".", " "), {_long, _long.replace("noncom", "non com").replace("sharea", "share a").replace("noder", "no der")}
        _NAMED[f"CC-{_part}-{_version}"] = [f"cc {_part.lower().replace('-', ' ')} {_tail}"] + [
            f"creative commons {x} {_tail}{y}" for x in sorted(_longs) for y in ("", " international", " unported", " generic")
        ]
for _family, _long in {"GPL": "general", "LGPL": "lesser general", "AGPL": "affero general"}.items():
    _short = _family.lower()
    _plain = [f"gnu {_long} public license", f"gnu {_short}", _short]
    _NAMED[_family] = _plain
    for _version in {"GPL": ("1.0", "2.0", "3.0"), "LGPL": ("2.0", "2.1", "3.0"), "AGPL": ("3.0",)}[_family]:
        _spoken = {_version.replace(".", " "), _version.removesuffix(".0").replace(".", " ")}
        _forms = [f"{x} {y}{n}" for x in _plain for y in ("version ", "v", "v ", "") for n in sorted(_spoken)]
        _forms += [f"{x}v{n}" for x in _plain[1:] for n in sorted(_spoken)]
        _NAMED[f"{_family}-{_version}"] = _forms
        _NAMED[f"{_family}-{_version}-or-later"] = [f"{x} {y}" for x in _forms for y in ("or later", "or any later version", "or at your option any later version")]
for _version in ("1.0", "2.0", "2.1", "3.0"):
    _spoken = sorted({_version.replace(".", " "), _version.removesuffix(".0")} if _version != "2.1" else {"2 1"})
    SENTENCES[f"version-{_version}-or-later"] = [f"either version {n}{x} or at your option any later version" for n in _spoken for x in (" of the license", "")]
    SENTENCES[f"version-{_version}-only"] = [f"version {n} of the license" for n in _spoken]

# Identifiers behind "SPDX-License-Identifier:"; the GPL family also with -only and -or-later.
_SPDX = [x for x in _NAMED if x not in ("BSD", "GPL", "LGPL", "AGPL") and not x.endswith("-or-later")]
_SPDX += [f"{x}-{y}" for x in _SPDX if "GPL-" in x for y in ("only", "or-later")] + ["BSD-4-Clause", "WTFPL", "MIT-0", "BlueOak-1.0.0", "OFL-1.1", "PostgreSQL", "Python-2.0", "NCSA", "CDDL-1.0"]
_UNDER = [
    "under", "under the", "under a", "under an", "under the terms of the", "under the terms of", "under the terms and conditions of the",
    "licensed under", "released under", "distributed under", "available under", "published under", "subject to the terms of the", "subject to the",
]
# Notices whose identifier or name is older than this table.
_OLDER = {"MIT": "mit-notice", "Apache-2.0": "apache-notice", "CC-BY-NC-4.0": "cc-by-nc-notice", "GPL-3.0": "gpl-notice"}


def _add_notices(least: int) -> None:
    """Wordings of notices with at least ``least`` words, and their rules."""
    for name in dict.fromkeys([*_NAMED, *_SPDX]):
        wordings = [f"{before} {named}" for named in _NAMED.get(name, []) for before in _UNDER]
        if name in _SPDX:
            wordings.append("spdx license identifier " + name.lower().replace("-", " ").replace(".", " "))
        if name.startswith("CC-"):
            wordings.append(f"creativecommons org licenses {name[3:-4].lower().replace('-', ' ')} {name[-3:].replace('.', ' ')}")
        identifier = _OLDER.get(name, f"{name.lower()}-notice")
        known = SENTENCES.get(identifier, [])
        known = [known] if isinstance(known, str) else known
        SENTENCES[identifier] = [*known, *(w for w in wordings if len(w.split()) >= least)]
        if name not in _OLDER:
            RULES.append((f"{name}-notice", [identifier]))
    SENTENCES["cc0-1.0-notice"].append("creativecommons org publicdomain zero 1 0")


MOST_BETWEEN = 120  # words between two sentences of a licence
_LEAD = 4
_add_notices(_LEAD)

_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = packed.utf8(column)
    data = packed.LOWER[data]
    starts, ends, firsts = packed.spans(data, offsets, _IS_WORD[data])
    return packed.span_hashes(data, starts, ends), firsts


class Sentences:
    """Known sentences by the hash of their first words."""

    def __init__(self, sentences: dict[str, str | list[str]]):
        spelled = [(name, w) for name, wordings in sentences.items() for w in ([wordings] if isinstance(wordings, str) else wordings)]
        self.names = [name for name, _ in spelled]
        words, firsts = _word_hashes(pa.array([w for _, w in spelled], pa.string()))
        known = [words[a:b] for a, b in zip(firsts, firsts[1:])]
        if any(len(w) < _LEAD for w in known):
            raise ValueError(f"a sentence needs at least {_LEAD} words")
        self.whole: dict[bytes, int] = {}
        lengths: dict[int, set[int]] = {}
        leads = packed.window_hashes(words, _LEAD)[firsts[:-1]].tolist()
        for place, (w, lead) in enumerate(zip(known, leads)):
            self.whole.setdefault(w.tobytes(), place)
            lengths.setdefault(lead, set()).add(len(w))
        #: by the hash of the first words, the lengths in words, longest first
        self.lengths = {lead: sorted(some, reverse=True) for lead, some in lengths.items()}
        self.lead = np.sort(np.array(list(lengths), np.uint64))
        self.slots = np.zeros(2**16, dtype=bool)
        self.slots[self.lead >> np.uint64(48)] = True

    def find(self, words: np.ndarray, firsts: np.ndarray) -> list[list[tuple[int, int, int]]]:
        """Per text, in order: (first word, end word, sentence) of each known sentence.

        The longest one counts at a place, and none that lies within another.
        """
        found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(firsts) - 1)]
        lead = packed.window_hashes(words, _LEAD)
        places = np.flatnonzero(self.slots[lead >> np.uint64(48)])
        places = places[np.isin(lead[places], self.lead)]
        for place in places.tolist():
            text = int(np.searchsorted(firsts, place, side="right")) - 1
            start, last = place - int(firsts[text]), int(firsts[text + 1])
            for length in self.lengths[int(lead[place])]:
                sentence = self.whole.get(words[place : place + length].tobytes()) if place + length <= last else None
                if sentence is not None:
                    if not found[text] or start + length > found[text][-1][1]:
                        found[text].append((start, start + length, sentence))
                    break
        return found


def match_rules(
    found: list[tuple[int, int, str]], rules=RULES, most_between: int = MOST_BETWEEN
) -> list[tuple[str, int, int]]:
    """Licences in a text's sentences (first word, end word, identifier), as (name, start, end).

    Rules are tried in order at every sentence not yet taken. The sentences of
    a rule must follow one another in its order, each at most ``most_between``
    words after the one before; others may stand between. The first rule that
    fits takes its sentences.
    """
    free = [True] * len(found)
    out = []
    for name, wanted in rules:
        for first, sentence in enumerate(found):
            if not free[first] or sentence[2] != wanted[0]:
                continue
            taken = [first]
            for identifier in wanted[1:]:
                end = found[taken[-1]][1]
                later = (
                    place
                    for place in range(taken[-1] + 1, len(found))
                    if free[place] and found[place][2] == identifier and 0 <= found[place][0] - end <= most_between
                )
                following = next(later, None)
                if following is None:
                    break
                taken.append(following)
            if len(taken) == len(wanted):
                for place in taken:
                    free[place] = False
                out.append((name, found[first][0], found[taken[-1]][1]))
    return sorted(out, key=lambda match: (match[1], match[0]))


def scan(
    docs: DataFrame, text: str = "text", sentences: dict[str, str | list[str]] = SENTENCES, rules=RULES
) -> DataFrame:
    """``docs`` with ``n_sentences``, ``n_licences``, ``licences`` and ``licence_spans``.

    ``n_sentences`` counts known sentences, ``licences`` are the distinct names
    found, sorted and comma-joined, ``licence_spans`` name:first:end of each in
    words. Words are runs of letters, digits and all beyond ASCII, lower-cased,
    so line breaks and punctuation do not matter. NULL and empty texts have
    none. Input columns so named are replaced. One pass, no shuffle.
    """
    added = ["n_sentences", "n_licences", "licences", "licence_spans"]
    docs = docs.drop(*added)
    schema = T.StructType(
        docs.schema.fields
        + [T.StructField(name, T.LongType()) for name in added[:2]]
        + [T.StructField(name, T.StringType()) for name in added[2:]]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Sentences(sentences)
        for whole in batches:
            for batch in packed.chunks(whole, text):
                found = known.find(*_word_hashes(batch.column(text)))
                matches = [match_rules([(a, b, known.names[s]) for a, b, s in f], rules) if f else [] for f in found]
                columns = [
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array([len(m) for m in matches], pa.int64()),
                    pa.array([",".join(sorted({name for name, _, _ in m})) for m in matches], pa.string()),
                    pa.array([",".join(f"{n}:{a}:{b}" for n, a, b in m) for m in matches], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *added])

    return in_small_batches(docs).mapInArrow(run, schema)
