"""Licence detection by ordered signature rules.

A rule is a regex over the lower-cased bytes of a text, behind a keyword that must occur for the regex to be tried.
Signatures of licence bodies, notices and addresses are written out one by one. Beside them every licence family has names
and, where it has them, versions, which the forms that a mention takes (an SPDX tag, a grant, a notice, a title) turn into
rules. Detections are taken by priority, then length, then place; one that lies within a detection taken before it is
suppressed.

Base phrases are looked for beside the rules: their words, one after another, with anything but words between.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import reachable

#: Fixed by the contract of the base: phrases and labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: (label, keyword, names as regexes, versions): what licences are called.
FAMILIES = (
    ("agpl", b"affero", r"(?:gnu )?affero general public licen[sc]e", r"[123](?:\.0)?"),
    ("lgpl", b"lesser", r"(?:gnu )?lesser general public licen[sc]e", r"[23](?:\.[01])?"),
    ("lgpl", b"library", r"(?:gnu )?library general public licen[sc]e", r"2(?:\.[01])?"),
    ("gpl", b"general public", r"(?:gnu )?general public licen[sc]e", r"[123](?:\.0)?"),
    ("gfdl", b"documentation", r"(?:gnu )?free documentation licen[sc]e", r"1\.[123]"),
    ("apache", b"apache", r"apache(?: software)? licen[sc]e", r"(?:1\.[01]|2(?:\.0)?)"),
    ("mit", b"mit", r"mit(?:/x11| \(expat\))? licen[sc]e", None),
    ("mit", b"expat", r"expat licen[sc]e", None),
    ("x11", b"x11", r"x11 licen[sc]e", None),
    ("bsd-2-clause", b"bsd", r"(?:2-clause|simplified|freebsd) bsd licen[sc]e", None),
    ("bsd-3-clause", b"bsd", r"(?:3-clause|new|modified|revised) bsd licen[sc]e", None),
    ("bsd", b"bsd", r"(?:original )?bsd(?:-style)? licen[sc]e", None),
    ("isc", b"isc", r"isc licen[sc]e", None),
    ("zlib", b"zlib", r"zlib(?:/libpng)? licen[sc]e", None),
    ("mpl", b"mozilla", r"mozilla public licen[sc]e", r"(?:1\.[01]|2(?:\.0)?)"),
    ("epl", b"eclipse", r"eclipse public licen[sc]e", r"[12](?:\.0)?"),
    ("edl", b"eclipse", r"eclipse distribution licen[sc]e", r"1\.0"),
    ("eupl", b"european", r"european union public licen[sc]e", r"1\.[0-2]"),
    ("cddl", b"common development", r"common development and distribution licen[sc]e", r"1\.[01]"),
    ("cpl", b"common public", r"common public licen[sc]e", r"1\.0"),
    ("artistic", b"artistic", r"(?:perl )?artistic licen[sc]e", r"[12](?:\.0)?"),
    ("boost", b"boost", r"boost software licen[sc]e", r"1\.0"),
    ("unlicense", b"unlicense", r"(?:the )?unlicense", None),
    ("wtfpl", b"wtfpl", r"wtfpl", r"[12]"),
    ("ms-pl", b"microsoft", r"microsoft public licen[sc]e", None),
    ("ms-rl", b"microsoft", r"microsoft reciprocal licen[sc]e", None),
    ("python", b"python", r"(?:python software foundation|python|psf) licen[sc]e", r"2(?:\.0)?"),
    ("php", b"php", r"php licen[sc]e", r"3\.0[01]?"),
    ("ruby", b"ruby", r"ruby licen[sc]e", None),
    ("openssl", b"openssl", r"openssl licen[sc]e", None),
    ("ofl", b"open font", r"(?:sil )?open font licen[sc]e", r"1\.[01]"),
    ("odbl", b"open database", r"open database licen[sc]e", r"1\.0"),
    ("odc-by", b"open data commons", r"open data commons attribution licen[sc]e", r"1\.0"),
    ("postgresql", b"postgresql", r"postgresql licen[sc]e", None),
    ("ncsa", b"ncsa", r"(?:university of illinois/)?ncsa(?: open source)? licen[sc]e", None),
    ("afl", b"academic free", r"academic free licen[sc]e", r"[1-3]\.[0-2]"),
    ("osl", b"open software", r"open software licen[sc]e", r"[1-3]\.[01]"),
    ("qpl", b"q public", r"q public licen[sc]e", r"1\.0"),
    ("bsl", b"business source", r"business source licen[sc]e", r"1\.1"),
    ("sspl", b"server side", r"server side public licen[sc]e", r"1"),
    ("elastic", b"elastic", r"elastic licen[sc]e", r"2\.0"),
    ("cc0", b"cc0", r"(?:creative commons )?cc0", r"1\.0"),
    ("cc-by-nc-nd", b"cc", r"(?:cc|creative commons)[ -](?:by|attribution)-(?:nc|noncommercial)-(?:nd|noderivs|noderivatives)", r"[1-4]\.[05]"),
    ("cc-by-nc-sa", b"cc", r"(?:cc|creative commons)[ -](?:by|attribution)-(?:nc|noncommercial)-(?:sa|sharealike)", r"[1-4]\.[05]"),
    ("cc-by-nc", b"cc", r"(?:cc|creative commons)[ -](?:by|attribution)-(?:nc|noncommercial)", r"[1-4]\.[05]"),
    ("cc-by-nd", b"cc", r"(?:cc|creative commons)[ -](?:by|attribution)-(?:nd|noderivs|noderivatives)", r"[1-4]\.[05]"),
    ("cc-by-sa", b"cc", r"(?:cc|creative commons)[ -](?:by|attribution)-(?:sa|sharealike)", r"[1-4]\.[05]"),
    ("cc-by", b"cc", r"(?:cc|creative commons)[ -](?:by|attribution)", r"[1-4]\.[05]"),
    ("cc-by-nc-nd", b"creative commons", r"creative commons attribution[ -]noncommercial[ -]no ?deriv(?:ative)?s", r"[1-4]\.[05]"),
    ("cc-by-nc-sa", b"creative commons", r"creative commons attribution[ -]noncommercial[ -]share ?alike", r"[1-4]\.[05]"),
    ("cc-by-nc", b"creative commons", r"creative commons attribution[ -]noncommercial", r"[1-4]\.[05]"),
    ("cc-by-sa", b"creative commons", r"creative commons attribution[ -]share ?alike", r"[1-4]\.[05]"),
)
#: SPDX names and addresses of families that have them.
TAGS = {"agpl": "agpl", "lgpl": "lgpl", "gpl": "gpl", "gfdl": "gfdl", "apache": "apache", "mit": "mit", "bsd-2-clause": "bsd-2-clause", "bsd-3-clause": "bsd-3-clause", "isc": "isc", "zlib": "zlib", "mpl": "mpl", "epl": "epl", "eupl": "eupl", "cddl": "cddl", "boost": "bsl", "unlicense": "unlicense", "cc0": "cc0", "cc-by-nc-nd": "cc-by-nc-nd", "cc-by-nc-sa": "cc-by-nc-sa", "cc-by-nc": "cc-by-nc", "cc-by-nd": "cc-by-nd", "cc-by-sa": "cc-by-sa", "cc-by": "cc-by", "ofl": "ofl", "odbl": "odbl", "artistic": "artistic", "postgresql": "postgresql", "ncsa": "ncsa", "python": "psf"}
#: Forms of a signature in order of priority, with the confidence of each; {n} stands for names, {v} for a version.
FORMS = (
    (0, 0.95, r"(?:licensed|released|distributed|published|available|redistributed|covered|provided) (?:under|by|with|subject to)(?: the)?(?: terms(?: and conditions)? of)?(?: the| an?)? {n}(?:,? ?v(?:ersion)?\.? ?(?P<version>{v})|[ -](?P<version2>{v}))?"),
    (1, 0.9, r"(?:subject to|under|see|per|terms of|conditions of|permitted by|governed by)(?: the)?(?: terms(?: and conditions)? of)?(?: the| an?)? {n}(?:,? ?v(?:ersion)?\.? ?(?P<version>{v})|[ -](?P<version2>{v}))?"),
    (2, 0.85, r"licen[sc]e ?[:=] ?(?:the )?{n}(?:,? ?v(?:ersion)?\.? ?(?P<version>{v})|[ -](?P<version2>{v}))?"),
    (3, 0.7, r"{n},? (?:v(?:ersion)?\.? ?)?(?P<version>{v})"),
    (4, 0.5, r"{n}"),
)
NEVER = r"(?!)"
#: Signatures of bodies and notices in order of priority: label, keyword, words. A space stands for anything between words.
BODIES = (
    ("mit", b"permission", r"permission is hereby granted,? free of charge,? to any person obtaining a copy of this software and associated documentation files"),
    ("mit", b"permission", r"permission is hereby granted,? free of charge,? to any person obtaining a copy"),
    ("mit", b"copyright notice", r"the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions of the software"),
    ("mit", b"warranty", r"the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"),
    ("mit-0", b"permission", r"permission is hereby granted free of charge to any person obtaining a copy of this software [^.]{0,300}to permit persons to whom the software is furnished to do so the software is provided as is"),
    ("bsd-3-clause", b"endorse", r"neither the names? of [^.]{1,160}? nor the names of (?:its|the|any) contributors may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", b"advertising", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd", b"redistribution", r"redistribution and use in source and binary forms,? with or without modification,? are permitted provided that the following conditions are met"),
    ("bsd", b"redistribution", r"redistributions of source code must retain the above copyright notice,? this list of conditions and the following disclaimer"),
    ("bsd", b"redistribution", r"redistributions in binary form must reproduce the above copyright notice,? this list of conditions and the following disclaimer"),
    ("0bsd", b"permission", r"permission to use,? copy,? modify,? and or distribute this software for any purpose with or without fee is hereby granted(?! provided)"),
    ("isc", b"permission", r"permission to use,? copy,? modify,? (?:and|and or) distribute this software for any purpose with or without fee is hereby granted,? provided that the above copyright notice"),
    ("apache", b"apache", r"apache license version (?P<version>2\.0) january 2004"),
    ("apache", b"apache", r"licensed under the apache license,? version (?P<version>[12]\.[01]) the license you may not use this file except in compliance with the license"),
    ("apache", b"compliance", r"you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache", b"grant of patent", r"grant of patent license subject to the terms and conditions of this license each contributor hereby grants to you"),
    ("agpl", b"affero", r"redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation,? (?:either )?version (?P<version>[123])(?: of the license)?"),
    ("lgpl", b"lesser", r"redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation,? (?:either )?version (?P<version>[23](?:\.[01])?)(?: of the license)?"),
    ("lgpl", b"library", r"redistribute it and or modify it under the terms of the gnu library general public license as published by the free software foundation,? (?:either )?version (?P<version>2(?:\.[01])?)(?: of the license)?"),
    ("gpl", b"general public", r"redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation,? (?:either )?version (?P<version>[123])(?: of the license)?"),
    ("gpl", b"general public", r"either version (?P<version>[123]) of the (?:gnu general public )?license or at your option any later version"),
    ("gpl", b"general public", r"you should have received a copy of the gnu general public license along with this"),
    ("lgpl", b"lesser", r"you should have received a copy of the gnu lesser general public license along with this"),
    ("agpl", b"affero", r"you should have received a copy of the gnu affero general public license along with this"),
    ("gpl", b"general public", r"gnu general public license version (?P<version>[123]),? (?:june|29 june|february) (?:1989|1991|2007)"),
    ("lgpl", b"lesser", r"gnu lesser general public license version (?P<version>2\.1|3),? (?:february 1999|29 june 2007)"),
    ("agpl", b"affero", r"gnu affero general public license version (?P<version>3),? 19 november 2007"),
    ("gpl", b"preamble", r"the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl", b"copyleft", r"the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("gfdl", b"documentation", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license,? version (?P<version>1\.[123])"),
    ("mpl", b"mozilla", r"this source code form is subject to the terms of the mozilla public license,? v \.? ?(?P<version>2\.0)"),
    ("mpl", b"mozilla", r"the contents of this file are subject to the mozilla public license version (?P<version>1\.[01])"),
    ("mpl", b"mpl was not", r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("epl", b"eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public license(?: v(?:ersion)? (?P<version>[12]\.0))?"),
    ("cddl", b"common development", r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("zlib", b"express-or-implied", r"this software is provided as-is without any express or implied warranty in no event will the authors be held liable"),
    ("zlib", b"express or implied", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("zlib", b"misrepresented", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("boost", b"boost", r"distributed under the boost software license,? version (?P<version>1\.0)"),
    ("boost", b"permission", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("unlicense", b"unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", b"unlicense", r"for more information please refer to https? unlicense org"),
    ("wtfpl", b"what the fuck", r"do what the fuck you want to(?: public license)?"),
    ("cc0", b"waive", r"to the extent possible under law [^.]{1,200}? has waived all copyright and related or neighboring rights to this work"),
    ("public-domain", b"public domain", r"(?:is|has been|are) (?:hereby )?(?:placed|released|dedicated|put) (?:in|into|to) the public domain"),
    ("cc-by-nc-sa", b"noncommercial", r"this work is licensed under a creative commons attribution noncommercial sharealike (?P<version>[1-4]\.[05])"),
    ("cc-by-sa", b"sharealike", r"this work is licensed under a creative commons attribution sharealike (?P<version>[1-4]\.[05])"),
    ("cc-by", b"creative commons", r"this work is licensed under a creative commons attribution (?P<version>[1-4]\.[05])"),
    ("ofl", b"open font", r"this font software is licensed under the sil open font license,? version (?P<version>1\.[01])"),
    ("artistic", b"artistic", r"you may distribute under the terms of either the gnu general public license or the artistic license"),
    ("python", b"python software foundation", r"this license agreement is between the python software foundation psf and the individual or organization"),
    ("openssl", b"openssl", r"this product includes software developed by the openssl project"),
    ("ncsa", b"ncsa", r"permission is hereby granted free of charge to any person obtaining a copy [^.]{0,200}to deal with the software without restriction"),
    ("postgresql", b"without fee", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("hpnd", b"without fee", r"permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted"),
    ("odbl", b"open data commons", r"is made available under the open database license"),
    ("elastic", b"elastic license", r"you may not provide the software to third parties as a hosted or managed service"),
    ("sspl", b"server side public", r"redistribute it and or modify it under the terms of the server side public license"),
    ("bsl", b"business source", r"use limitation or change date and change license business source license"),
    ("proprietary", b"all rights reserved", r"unauthorized copying of this file via any medium is strictly prohibited"),
)
#: Addresses of licence texts: label, what follows the scheme.
ADDRESSES = (
    ("apache", r"(?:www\.)?apache\.org/licenses/license-(?P<version>[12]\.[01])"),
    ("mit", r"(?:www\.)?opensource\.org/licenses?/mit(?:-license)?"),
    ("bsd-2-clause", r"(?:www\.)?opensource\.org/licenses?/bsd-2-clause"),
    ("bsd-3-clause", r"(?:www\.)?opensource\.org/licenses?/bsd-3-clause"),
    ("bsd", r"(?:www\.)?opensource\.org/licenses?/bsd-license"),
    ("isc", r"(?:www\.)?opensource\.org/licenses?/isc"),
    ("zlib", r"(?:www\.)?opensource\.org/licenses?/zlib"),
    ("agpl", r"(?:www\.)?gnu\.org/licenses/agpl(?:-(?P<version>3\.0))?"),
    ("lgpl", r"(?:www\.)?gnu\.org/licenses/(?:old-licenses/)?lgpl(?:-(?P<version>[23]\.[01]))?"),
    ("gpl", r"(?:www\.)?gnu\.org/licenses/(?:old-licenses/)?gpl(?:-(?P<version>[123]\.0))?"),
    ("gfdl", r"(?:www\.)?gnu\.org/licenses/fdl(?:-(?P<version>1\.[123]))?"),
    ("gpl", r"(?:www\.)?opensource\.org/licenses?/gpl-(?P<version>[23]\.0)"),
    ("mpl", r"(?:www\.)?mozilla\.org/(?:[a-z-]+/)?mpl/(?P<version>[12]\.[01])"),
    ("epl", r"(?:www\.)?eclipse\.org/legal/epl-?v?(?P<version>[12]0|[12]\.0)"),
    ("boost", r"(?:www\.)?boost\.org/license_1_0"),
    ("unlicense", r"(?:www\.)?unlicense\.org"),
    ("wtfpl", r"(?:www\.)?wtfpl\.net"),
    ("ofl", r"scripts\.sil\.org/ofl"),
    ("cc0", r"(?:www\.)?creativecommons\.org/publicdomain/zero/(?P<version>1\.0)"),
    ("cc-by-nc-nd", r"(?:www\.)?creativecommons\.org/licenses/by-nc-nd/(?P<version>[1-4]\.[05])"),
    ("cc-by-nc-sa", r"(?:www\.)?creativecommons\.org/licenses/by-nc-sa/(?P<version>[1-4]\.[05])"),
    ("cc-by-nc", r"(?:www\.)?creativecommons\.org/licenses/by-nc/(?P<version>[1-4]\.[05])"),
    ("cc-by-nd", r"(?:www\.)?creativecommons\.org/licenses/by-nd/(?P<version>[1-4]\.[05])"),
    ("cc-by-sa", r"(?:www\.)?creativecommons\.org/licenses/by-sa/(?P<version>[1-4]\.[05])"),
    ("cc-by", r"(?:www\.)?creativecommons\.org/licenses/by/(?P<version>[1-4]\.[05])"),
    ("odbl", r"(?:www\.)?opendatacommons\.org/licenses/odbl"),
)


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    confidence: float
    keywords: tuple[bytes, ...]
    pattern: re.Pattern


def make_rules() -> list[Rule]:
    """All rules in order: tags, bodies and notices, addresses, then every form with every family."""
    edge, out = r"(?<![0-9a-z\x80-\xff])", []
    end = r"(?![0-9a-z\x80-\xff])"
    for label, tag in TAGS.items():
        version = rf"(?:[ -]v?(?P<version>[0-9](?:\.[0-9])?)(?:-only|-or-later|\+)?)?"
        out.append(Rule(label, -1, 1.0, (b"spdx",), re.compile(rf"{edge}spdx-license-identifier: ?{tag}{version}{end}(?!-)".encode("latin-1"))))
    # between words anything but letters and digits, so that line ends, comment marks and quotes don't matter
    between = r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"
    for label, keyword, words in BODIES:
        text = words.replace(",?", "").replace(" ", between)
        out.append(Rule(label, -1, 0.98, (keyword.split(b"-")[0].split()[0],), re.compile(f"{edge}{text}{end}".encode("latin-1"))))
    for label, address in ADDRESSES:
        out.append(Rule(label, -1, 0.9, (b"://",), re.compile(f"https?://{address}(?![0-9a-z])".encode("latin-1"))))
    for priority, confidence, form in FORMS:
        for label, keyword, names, version in FAMILIES:
            if version is None and priority == 3:
                continue
            keywords = (b"cc", b"creative") if keyword == b"cc" else (keyword.split()[0],)
            text = form.replace("{n}", f"(?:{names})").replace("{v}", version or NEVER)
            text = text.replace("[ -]", "(?:-| )")
            # any run of white space may stand for a space
            text = text.replace(" ", r"[\x00-\x20]+").replace(r"[\x00-\x20]+?", r"[\x00-\x20]*")
            tail = "(?!-(?:nc|nd|sa|share|noncom|noder))" if label.startswith("cc-by") else ""
            out.append(Rule(label, priority, confidence, keywords, re.compile(f"{edge}{text}{end}{tail}".encode("latin-1"))))
    return out


@dataclass(frozen=True)
class Detection:
    start: int
    end: int
    label: str
    priority: int
    confidence: float
    version: str | None


LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_SEP = rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"
_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
_base = re.compile(rb"(?<![0-9a-z\x80-\xff])(?:" + b"|".join(b"(%s)" % _SEP.join(p.encode().split()) for p in BASE) + rb")(?![0-9a-z\x80-\xff])")
_rules: list[Rule] = []


_keywords: set[bytes] = set()


def detect(low: bytes) -> list[Detection]:
    """Detections in a lower-cased text, in order of place, overlaps resolved."""
    if not _rules:
        _rules.extend(make_rules())
        _keywords.update(k for r in _rules for k in r.keywords)
    here = {k for k in _keywords if k in low}
    found = []
    for rule in _rules:
        if not here.isdisjoint(rule.keywords):
            for m in rule.pattern.finditer(low):
                groups = m.groupdict()
                version = groups.get("version") or groups.get("version2")
                found.append(Detection(m.start(), m.end(), rule.label, rule.priority, rule.confidence, version.decode() if version else None))
    return without_contained(found)


def without_contained(found: list[Detection]) -> list[Detection]:
    """Detections by priority, then length, then place, but for those within one taken before; in order of place.

    Those taken that lie within no other one have rising starts and rising ends, so that a search finds the only one that
    can hold the next.
    """
    kept: list[Detection] = []
    starts: list[int] = []
    ends: list[int] = []
    for d in sorted(found, key=lambda d: (d.priority, d.start - d.end, d.start, d.label)):
        i = bisect_right(starts, d.start)
        if i and ends[i - 1] >= d.end:
            continue
        kept.append(d)
        first = i - (i > 0 and starts[i - 1] == d.start)
        last = bisect_right(ends, d.end)
        starts[first:last], ends[first:last] = [d.start], [d.end]
    return sorted(kept, key=lambda d: (d.start, d.end, d.priority, d.label))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licences that texts name.

    Returns id_col, n_words, n_base (places of base phrases), first_word and last_word (smallest and largest word at which
    one starts, from 0; null without any), base_labels, labels (those and the rules', each list distinct, sorted and
    comma-joined), score (the highest confidence of a detection, a base phrase counting 0.5; 0 without any) and detections
    (label, version, start, end in bytes of the UTF-8 text, confidence). Words are runs of letters a-z, digits and
    non-ASCII characters, A-Z lower-cased. A null text counts as empty. Rows stay as they are in number; ids may be null
    or repeat. Other columns are not read.
    """
    reachable(docs.sparkSession)
    span = pa.struct([("label", pa.string()), ("version", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("confidence", pa.float64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("detections", pa.list_(span))])
    names = list(BASE.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in list(schema)[1:]]
            for text in batch.column(1):
                low = (text.as_py() or "").encode().translate(LOWER)
                word = _WORD[np.frombuffer(low, np.uint8)]
                starts = word.copy()
                starts[1:] &= ~word[:-1]
                base = list(_base.finditer(low)) if b"cc" in low or b"license" in low else []
                before = np.cumsum(starts) if base else starts
                at = [int(before[m.start()]) - 1 for m in base]
                labels = {names[m.lastindex - 1] for m in base}
                found = detect(low)
                score = max([0.5 * bool(base), *(d.confidence for d in found)])
                spans = [{"label": d.label, "version": d.version, "start": d.start, "end": d.end, "confidence": d.confidence} for d in found]
                row = (int(np.count_nonzero(starts)), len(base), min(at, default=None), max(at, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | {d.label for d in found})), float(score), spans)
                for column, x in zip(out, row, strict=True):
                    column.append(x)
            yield pa.record_batch([batch.column(0), *(pa.array(c, f.type) for c, f in zip(out, list(schema)[1:], strict=True))], schema=schema)

    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    kinds = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, detections array<struct<label:string,version:string,start:long,end:long,confidence:double>>"
    return rows.mapInArrow(run, kinds).withColumnRenamed("doc_id", id_col)
