"""Licence recognition from normalised sentences, with built-in SQL functions only.

A text is normalised to lower-case ASCII letters and digits with single spaces.
Known sentences map to identifiers wherever they stand: over any number of lines
and inside longer sentences. A known sentence is a fixed one, or the name of a
licence after words that grant it ("licensed under the", an SPDX tag, or "or" and
"and" right after another known sentence). Where several begin at one place the
longest counts, and a sentence inside another one is not counted again. The
identifiers of a text, in order, are matched with ordered rules: a rule holds if
its identifiers occur in its order, whatever stands between them.

The clause on names in the third part of the BSD licence counts whoever is named in it.
A sentence or grant right after "not", "never" or "no longer" does not count.

Not seen: licences missing from the tables, reworded grants, and denials in other words.

Defined cases: a null text has no sentence and no licence; repeated rows are
judged alike; every licence whose rule holds is named, in the order of the rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalised licence sentences and their identifiers.
SENTENCES = {
    "released under the mit license": "mit-name",
    "licensed under the mit license": "mit-name",
    "this project is licensed under the mit license": "mit-name",
    "this work is licensed under the mit license": "mit-name",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "licensed under the apache license version 2 0": "apache2-name",
    "released under the apache license version 2 0": "apache2-name",
    "licensed under the apache license version 2 0 the license": "apache2-name",
    "this work is licensed under the apache license version 2 0": "apache2-name",
    "you may not use this file except in compliance with the license": "apache2-comply",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apache2-where",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "released under the bsd license": "bsd-name",
    "licensed under the bsd license": "bsd-name",
    "this work is licensed under the gnu general public license version 3": "gpl3-name",
    "licensed under the gnu general public license version 3": "gpl3-name",
    "released under the gnu general public license version 3": "gpl3-name",
    "this work is licensed under the gnu general public license version 2": "gpl2-name",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3-grant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2-grant",
    "licensed under the mozilla public license version 2 0": "mpl2-name",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl2-name",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by4-name",
    "this work is licensed under the creative commons attribution 4 0 international license": "cc-by4-name",
    "this is free and unencumbered software released into the public domain": "unlicense-name",
}

#: Fixed sentences of further licences.
SENTENCES |= {
    "you may obtain a copy of the license at https www apache org licenses license 2 0": "apache2-where",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "0bsd-grant",
    "has waived all copyright and related or neighboring rights to": "cc0-grant",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license": "bsl1-grant",
    "altered source versions must be plainly marked as such and must not be misrepresented as being the original software": "zlib-grant",
}
_GNU = {"gpl": "gnu general public license", "lgpl": "gnu lesser general public license", "agpl": "gnu affero general public license"}
_VERSIONS = {"gpl": ("2", "3"), "lgpl": ("2 1", "3"), "agpl": ("3",)}
for _k, _name in _GNU.items():
    for _v in _VERSIONS[_k]:
        _says, _id = f"redistribute it and or modify it under the terms of the {_name} as published by the free software foundation", f"{_k}{_v.replace(' ', '')}"
        SENTENCES[f"{_says} either version {_v} of the license or at your option any later version"] = f"{_id}-grant"
        SENTENCES[f"{_says} version {_v} of the license"] = SENTENCES[f"{_says} version {_v}"] = f"{_id}-name"


def _names() -> dict[str, str]:
    """Normalised names of licences, as they stand after words that grant them, and their identifiers."""
    out = {
        "mit license": "mit-name", "mit": "mit-name", "bsd license": "bsd-name", "isc license": "isc-name", "isc": "isc-name", "unlicense": "unlicense-name",
        "bsd 0 clause license": "0bsd-name", "0bsd": "0bsd-name", "boost software license": "bsl1-name", "boost software license 1 0": "bsl1-name", "bsl 1 0": "bsl1-name",
        "zlib license": "zlib-name", "zlib": "zlib-name", "wtfpl": "wtfpl-name", "public domain": "pd-name",
    }
    for n, i in (("2", "bsd2"), ("3", "bsd3")):
        out |= {f"bsd {n} clause license": f"{i}-name", f"bsd {n} clause": f"{i}-name", f"{n} clause bsd license": f"{i}-name", f"{n} clause bsd": f"{i}-name"}
    numbered = {
        "apache": ("apache2", ("apache license", "apache software license", "apache"), ("2 0",)), "mpl": ("mpl2", ("mozilla public license", "mpl"), ("2 0",)),
        "epl": ("epl2", ("eclipse public license", "epl"), ("2 0",)), "eupl": ("eupl12", ("european union public license", "eupl"), ("1 2",)), "artistic": ("artistic2", ("artistic license", "artistic"), ("2 0",)),
    }
    for k, (i, forms, versions) in numbered.items():
        for f in forms:
            out[f] = f"{k}-name"
            for v in versions:
                out |= {f"{f}{w}{x}": f"{i}-name" for w in (" ", " version ", " v", " v ") for x in (v, v.removesuffix(" 0"))}
    for k, name in _GNU.items():
        for v in _VERSIONS[k]:
            for f in (name, f"gnu {k}", k):
                out[f] = f"{k}-name"
                for w in (" ", " version ", " v", " v ", ""):
                    for x in (v, v if " " in v else f"{v} 0"):
                        i = f"{k}{v.replace(' ', '')}"
                        out |= {f"{f}{w}{x}{end}": f"{i}-name" for end in ("", " only")}
                        out |= {f"{f}{w}{x}{end}": f"{i}-grant" for end in (" or later", " or any later version", " or at your option any later version", " or newer")}
    parts = {"by": ["attribution"], "nc": ["noncommercial", "non commercial"], "sa": ["sharealike", "share alike"], "nd": ["noderivatives", "no derivatives", "noderivs"]}
    for kind in CC_KINDS:
        long = [""]
        for x in kind.split("-"):
            long = [f"{a} {b}" for a in long for b in parts[x]]
        for f in [f"cc {kind.replace('-', ' ')}", f"creative commons {kind.replace('-', ' ')}", *[f"creative commons{x}" for x in long]]:
            out |= {f: f"cc-{kind}-name", f"{f} license": f"cc-{kind}-name"}
            for v in CC_VERSIONS:
                i = f"cc-{kind}{v.removesuffix('.0')}-name"
                n = v.replace(".", " ")
                out |= {f"{f} {w}{n}{end}": i for w in ("", "version ", "license version ") for end in ("", " license", " international", " international license", " unported", " unported license", " generic license")}
    for f in ("cc0", "cc0 1 0", "cc0 1 0 universal", "creative commons zero", "creative commons zero v1 0 universal", "creative commons cc0 license", "creative commons cc0 1 0 universal", "cc zero"):
        out |= {f: "cc0-name", f"{f} license": "cc0-name", f"{f} public domain dedication": "cc0-name"}
    return out


CC_KINDS, CC_VERSIONS = ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd"), ("1.0", "2.0", "2.5", "3.0", "4.0")
NAMES = _names()

# Licences and the identifiers that must occur in this order.
RULES = [
    ("MIT", ["mit-grant", "mit-notice"]),
    ("MIT", ["mit-name"]),
    ("Apache-2.0", ["apache2-comply", "apache2-where"]),
    ("Apache-2.0", ["apache2-name"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("BSD", ["bsd-name"]),
    ("GPL-3.0", ["gpl3-name"]),
    ("GPL-3.0-or-later", ["gpl3-grant"]),
    ("GPL-2.0", ["gpl2-name"]),
    ("GPL-2.0-or-later", ["gpl2-grant"]),
    ("MPL-2.0", ["mpl2-name"]),
    ("CC-BY-4.0", ["cc-by4-name"]),
    ("Unlicense", ["unlicense-name"]),
    *[(f"CC-{k.upper()}-{v}", [f"cc-{k}{v.removesuffix('.0')}-name"]) for k in CC_KINDS for v in CC_VERSIONS if (k, v) != ("by", "4.0")],
    *[(f"CC-{k.upper()}", [f"cc-{k}-name"]) for k in CC_KINDS],
    ("CC0-1.0", ["cc0-name"]),
    ("CC0-1.0", ["cc0-grant"]),
    ("LGPL-2.1", ["lgpl21-name"]),
    ("LGPL-2.1-or-later", ["lgpl21-grant"]),
    ("LGPL-3.0", ["lgpl3-name"]),
    ("LGPL-3.0-or-later", ["lgpl3-grant"]),
    ("AGPL-3.0", ["agpl3-name"]),
    ("AGPL-3.0-or-later", ["agpl3-grant"]),
    ("ISC", ["isc-grant"]),
    ("ISC", ["isc-name"]),
    ("0BSD", ["0bsd-grant"]),
    ("0BSD", ["0bsd-name"]),
    ("BSD-2-Clause", ["bsd2-name"]),
    ("BSD-3-Clause", ["bsd3-name"]),
    ("BSL-1.0", ["bsl1-grant"]),
    ("BSL-1.0", ["bsl1-name"]),
    ("Zlib", ["zlib-grant"]),
    ("Zlib", ["zlib-name"]),
    *[(n, [f"{k}-name"]) for k, n in {"apache": "Apache", "gpl": "GPL", "lgpl": "LGPL", "agpl": "AGPL", "mpl": "MPL", "epl": "EPL", "eupl": "EUPL", "artistic": "Artistic"}.items()],
    ("EPL-2.0", ["epl2-name"]),
    ("EUPL-1.2", ["eupl12-name"]),
    ("Artistic-2.0", ["artistic2-name"]),
    ("WTFPL", ["wtfpl-name"]),
    ("public domain", ["pd-name"]),
]
#: Licences whose first rule does not hold where an earlier rule of the other licence does.
COVERED_BY = {"BSD-2-Clause": "BSD-3-Clause"}

#: Each known sentence holds one of these words; texts without any are done at once.
TRIGGERS = ("licen", "permission", "redistribut", "domain", "copyright", "released", "distributed", "available", "published", "provided", "misrepresented", "governed", "covered", "endorse")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Words that grant the licence whose name follows.
_GRANTS = (
    "(?:(?:licensed|released|distributed|available|published|provided) (?:under|into|with)(?: the terms(?: and conditions)? of)?(?: either)?|(?:governed|covered) by(?: the terms(?: and conditions)? of)?"
    "|redistribute (?:it|this software) under the terms of|spdx license identifier)(?: the| a| an)?"
)
#: Words right before a sentence or grant that deny it.
_DENIED = "(?<! not)(?<! never)(?<! no longer)"
#: Words that join a further name to a known sentence just before them.
_JOINS = "(?:or|and)(?: under)?(?: the| a| an)?"


def _longest_first(words) -> str:
    return "|".join(sorted(words, key=lambda w: (-len(w), w)))


def _sentence_ids(low: Column) -> Column:
    plus = F.regexp_replace(low, "(?<=[0-9])[+](?![a-z0-9])", " or later ")
    plain = F.concat(F.lit(" "), F.btrim(F.regexp_replace(plus, "[^a-z0-9]+", " ")), F.lit(" "))
    plain = F.replace(plain, F.lit("licence"), F.lit("license"))
    known = F.create_map(*[F.lit(x) for kv in {**NAMES, **SENTENCES}.items() for x in kv])
    names = _longest_first(NAMES)
    pattern = f"{_DENIED} (?:(?:{_longest_first(SENTENCES)})|{_GRANTS} (?:{names})|(?<=(?!^)\\G ){_JOINS} (?:{names}))(?= )"
    matches = F.regexp_extract_all(plain, F.lit(pattern), F.lit(0))
    name = lambda m: F.regexp_replace(m, f"^ (?:{_GRANTS}|{_JOINS}) ", "")
    return F.transform(matches, lambda m: F.coalesce(F.element_at(known, F.btrim(m)), F.element_at(known, name(m))))


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_sentences, sentence_ids, licenses): known sentences and licences of each text.

    A map over rows: nothing is shuffled, exploded or joined.
    """
    low = F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), _UPPER, _LOWER)
    slim = docs.select(F.col(key).alias("doc_id"), low.alias("__low"))
    hit = F.lit(False)
    for t in TRIGGERS:
        hit = hit | F.contains(F.col("__low"), F.lit(t))
    ids = F.when(hit, _sentence_ids(F.col("__low"))).otherwise(F.array().cast("array<string>"))
    joined = F.concat(F.lit(","), F.array_join("__ids", ","), F.lit(","))
    found: dict[str, Column] = {}
    for name, rule in RULES:
        holds = joined.rlike("," + ",(?:.*,)?".join(rule) + ",")
        if name in COVERED_BY and name not in found:
            holds = holds & ~found[COVERED_BY[name]]
        found[name] = found[name] | holds if name in found else holds
    names = F.array_compact(F.array(*[F.when(v, F.lit(k)) for k, v in found.items()]))
    return slim.select("doc_id", ids.alias("__ids")).select(
        "doc_id", F.size("__ids").cast("long").alias("n_sentences"), F.array_join("__ids", ",").alias("sentence_ids"), F.array_join(names, ",").alias("licenses")
    )
