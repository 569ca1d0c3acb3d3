"""License scans by ordered signature rules.

A rule is a regular expression over lower-case words, with a label, a priority, a confidence and a keyword
that any of its matches holds. A document is looked at only if it has one of the gate words, and a
rule is tried only if the document has its keyword. Detections are intervals of words; one that lies
within another is suppressed, and of equal intervals the one of higher priority stays.

The rules are the licenses' names set into phrasings. All of it are column expressions of one row: there is no
shuffle, and no detection leaves its document.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # letters, digits and everything beyond ASCII
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Phrases that count as base places, with their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# License names as words, "label | keyword | name". A keyword is part of every match.
NAMES = """
mit | mit | mit
mit | expat | expat
x11 | x11 | x11
apache-1.1 | apache | apache(?: software)?(?: license)?(?: version)? 1 1
apache-2 | apache2 | apache2(?: 0)?
apache-2 | apache | apache(?= )(?: software)?(?: public)?(?: license)?(?: version)?(?: v)? ?2(?: 0)?
apache | apache | apache(?: software)?
gpl-1 | general public | (?:gnu )?general public license(?: gpl)?(?: version| v) ?1(?: 0)?
gpl-2 | general public | (?:gnu )?general public license(?: gpl)?(?: version| v) ?2(?: 0)?
gpl-3 | general public | (?:gnu )?general public license(?: gpl)?(?: version| v) ?3(?: 0)?
gpl | general public | (?:gnu )?general public
gpl-2 | gpl | (?:gnu )?gpl(?: version| v)? 2(?: 0)?
gpl-3 | gpl | (?:gnu )?gpl(?: version| v)? 3(?: 0)?
gpl | gpl | (?:gnu )?gpl
lgpl-2.1 | lesser general | (?:gnu )?lesser general public license(?: lgpl)?(?: version| v) ?2(?: 1)?
lgpl-3 | lesser general | (?:gnu )?lesser general public license(?: lgpl)?(?: version| v) ?3(?: 0)?
lgpl | lesser general | (?:gnu )?lesser general public
lgpl | library general | (?:gnu )?library general public
lgpl-2.1 | lgpl | (?:gnu )?lgpl(?: version| v)? 2(?: 1)?
lgpl-3 | lgpl | (?:gnu )?lgpl(?: version| v)? 3(?: 0)?
lgpl | lgpl | (?:gnu )?lgpl
agpl-3 | affero | (?:gnu )?affero general public license(?: agpl)?(?: version| v) ?3(?: 0)?
agpl | affero | (?:gnu )?affero general public
agpl-3 | agpl | (?:gnu )?agpl(?: version| v)? 3(?: 0)?
agpl | agpl | (?:gnu )?agpl
gfdl | documentation | (?:gnu )?free documentation
mpl-1.1 | mozilla | mozilla public license(?: version| v)? 1(?: 1)?
mpl-2 | mozilla | mozilla public license(?: version| v)? 2(?: 0)?
mpl | mozilla | mozilla public
mpl-2 | mpl | mpl(?: version| v)? 2(?: 0)?
bsd-0 | 0bsd | 0bsd
bsd-2 | freebsd | freebsd
bsd-2 | bsd | (?:bsd 2 clause|(?:2|two) clause bsd|simplified bsd)
bsd-3 | bsd | (?:bsd 3 clause|(?:3|three) clause bsd|(?:new|modified|revised) bsd)
bsd-4 | bsd | (?:bsd 4 clause|(?:4|four) clause bsd|original bsd)
bsd | bsd | bsd
isc | isc | isc
zlib | zlib | zlib(?: libpng)?
boost-1 | boost | boost software(?: license)?(?: version)?(?: 1(?: 0)?)?
boost-1 | bsl | bsl 1 0
unlicense | unlicense | (?:the )?unlicense
wtfpl | wtfpl | wtfpl
cc0 | cc0 | (?:creative commons )?cc0(?: 1 0)?
cc-by | cc by | cc by(?: [1-4] [05])?
cc-by-sa | cc by sa | cc by sa(?: [1-4] [05])?
cc-by-nd | cc by nd | cc by nd(?: [1-4] [05])?
cc-by-nc | cc by nc | cc by nc(?: [1-4] [05])?
cc-by-nc-sa | cc by nc sa | cc by nc sa(?: [1-4] [05])?
cc-by-nc-nd | cc by nc nd | cc by nc nd(?: [1-4] [05])?
cc-by | creative commons | creative commons attribution(?: [1-4] [05])?
cc-by-sa | creative commons | creative commons attribution share ?alike(?: [1-4] [05])?
cc-by-nd | creative commons | creative commons attribution no ?deriv(?:ative)?s?(?: [1-4] [05])?
cc-by-nc | creative commons | creative commons attribution non ?commercial(?: [1-4] [05])?
cc-by-nc-sa | creative commons | creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?
cc-by-nc-nd | creative commons | creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: [1-4] [05])?
creative-commons | creative commons | creative commons
epl-1 | eclipse | eclipse public license(?: version| v)? 1(?: 0)?
epl-2 | eclipse | eclipse public license(?: version| v)? 2(?: 0)?
epl | eclipse | eclipse public
epl-2 | epl | epl(?: version| v)? 2(?: 0)?
edl-1 | eclipse | eclipse distribution
cddl-1 | cddl | cddl(?: 1 [01])?
cddl-1 | common development | common development and distribution
cpl-1 | common public | common public
artistic-1 | artistic | artistic license(?: version)? 1(?: 0)?
artistic-2 | artistic | artistic license(?: version)? 2(?: 0)?
artistic | artistic | artistic
eupl-1.2 | eupl | eupl(?: v)?(?: 1 [12])?
eupl-1.2 | european union | european union public
ofl-1.1 | sil open font | sil open font
ofl-1.1 | ofl | ofl(?: 1 1)?
odbl-1 | open database | (?:odc )?open database
odbl-1 | odbl | odbl(?: 1 0)?
odc-by-1 | odc by | odc by(?: 1 0)?
odc-by-1 | open data commons | open data commons attribution
pddl-1 | pddl | pddl(?: 1 0)?
cdla-permissive | cdla | cdla permissive(?: [12] 0)?
postgresql | postgresql | postgresql
psf | python software | python software foundation
psf | psf | psf(?: 2 0)?
ruby | ruby | ruby
php-3 | php | php(?: 3 01)?
openssl | openssl | openssl
ms-pl | microsoft | microsoft public
ms-rl | microsoft | microsoft reciprocal
ncsa | ncsa | (?:university of illinois )?ncsa(?: open source)?
afl-3 | academic free | academic free
osl-3 | open software | open software
cecill-2 | cecill | cecill(?: [bc])?(?: 2 [01])?
mulan-2 | mulan | mulan (?:psl|permissive software)(?: v2)?
unicode | unicode | unicode
bsl-1.1 | business source | business source
sspl-1 | server side | server side public
elastic-2 | elastic | elastic(?: license)?(?: 2 0)?
polyform | polyform | polyform (?:noncommercial|small business|shield|strict)(?: 1 0 0)?
openrail | openrail | (?:creativeml |bigscience )?openrail(?: [ms])?
llama | llama | llama(?: [234])? community
"""

# Phrasings in order of priority: regular expression with the name set in, and confidence.
PHRASINGS = (
    (r"spdx license identifier {name}", 1.0),
    (
        r"(?:licen[sc]ed|released|distributed|available|provided|published|shared|offered|covered)"
        r" under(?: the)?(?: terms(?: and conditions)? of)?(?: the)? {name}(?: licen[sc]e)?",
        0.95,
    ),
    (r"(?:subject to|governed by|terms of)(?: the)?(?: terms of)?(?: the)? {name} licen[sc]e", 0.9),
    (r"under(?: the)? {name} licen[sc]e", 0.9),
    (r"licen[sc]e(?: is)?(?: the)? {name}", 0.8),
    (r"{name} (?:public )?licen[sc]e", 0.7),
)
# Statements that are signatures as they stand, "label | keyword | expression | confidence".
STATEMENTS = """
mit | hereby granted | permission is hereby granted free of charge to any person obtaining a copy | 0.95
isc | and or distribute | permission to use copy modify and or distribute this software for any purpose | 0.95
bsd | binary forms | redistribution and use in source and binary forms with or without modification are permitted | 0.9
gpl | free software | this program is free software you can redistribute it and or modify it under the terms | 0.8
public-domain | public domain | (?:released|placed|dedicated)(?: in)?(?: in)?to the public domain | 0.9
public-domain | public domain | this (?:work|file|software) is in the public domain | 0.9
proprietary | all rights | all rights reserved | 0.4
"""
# Each match of a rule holds one of these words or beginnings of words.
GATES = ("licen", "spdx", "under", "permission", "redistribution", "software", "domain", "rights")
BASE_GATE = r"(?i)cc[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+by[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+nc"


def rules() -> list[tuple[int, str, str, str, float]]:
    """Priority, label, keyword, expression and confidence; statements come first, then phrasings."""
    out = []
    for line in STATEMENTS.strip().splitlines():
        label, keyword, expression, confidence = (x.strip() for x in line.split(" | "))
        out.append((len(out), label, keyword, expression, float(confidence)))
    for phrasing, confidence in PHRASINGS:
        for line in NAMES.strip().splitlines():
            label, keyword, name = (x.strip() for x in line.split(" | "))
            expression = phrasing.format(name=name)
            out.append((len(out), label, keyword, expression, confidence))
    return out


def _gate() -> Column:
    lower = F.lower("text")
    found = F.col("text").rlike(BASE_GATE)
    for word in GATES:
        found = found | F.contains(lower, F.lit(word))
    return F.coalesce(found, F.lit(False))


def _rule_array() -> Column:
    names = ("priority", "label", "keyword", "expression", "confidence")
    listed = [
        dict(zip(names, (priority, label, f" {keyword} ", f"(?<= ){expression}(?= )", confidence), strict=True))
        for priority, label, keyword, expression, confidence in rules()
    ]
    kind = "array<struct<priority: int, label: string, keyword: string, expression: string, confidence: double>>"
    return F.from_json(F.lit(json.dumps(listed)), kind)


def _places(phrase: str) -> str:
    tests = " and ".join(f"words[i + {k}] = '{w}'" for k, w in enumerate(phrase.split()))
    last = len(phrase.split())
    return (
        f"if(size(words) >= {last},"
        f" filter(sequence(0, size(words) - {last}), i -> {tests}), cast(array() as array<int>))"
    )


_COUNT = "size(filter(split({}, ' '), w -> w <> ''))"

# All matches of one rule as intervals of words: what stands between the matches is counted up.
_FOUND = f"""
flatten(transform(tried, r -> aggregate(
  arrays_zip(split(line, r.expression, -1), regexp_extract_all(line, r.expression, 0)),
  named_struct('at', 0, 'found', cast(array() as
    array<struct<start: int, back: int, priority: int, label: string, confidence: double>>)),
  (have, x) -> if(x.`1` is null, have, named_struct(
    'at', have.at + {_COUNT.format("x.`0`")} + {_COUNT.format("x.`1`")},
    'found', concat(have.found, array(named_struct(
      'start', have.at + {_COUNT.format("x.`0`")},
      'back', -(have.at + {_COUNT.format("x.`0`")} + {_COUNT.format("x.`1`")}),
      'priority', r.priority, 'label', r.label, 'confidence', cast(r.confidence as double)))))),
  have -> have.found)))
"""

# In order of start, longer first, then priority: one that ends no later than an earlier one lies in it.
_KEPT = """
aggregate(array_sort(found),
  named_struct('end', 0, 'labels', cast(array() as array<string>), 'confidence', 0D),
  (have, x) -> if(-x.back <= have.end, have, named_struct(
    'end', -x.back,
    'labels', array_union(have.labels, array(x.label)),
    'confidence', greatest(have.confidence, x.confidence))))
"""


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Words are runs of ASCII letters and digits and of everything beyond ASCII, in ASCII lower case. Base
    places are counted all, overlapping ones too; first_word and last_word are the smallest and
    largest word at which one starts, else null. ``labels`` adds those of the detections that stay. The
    score is the highest confidence, 0.95 at least with a base place and 0 without any detection. Null
    and empty texts have no words and no labels; repeated rows are scanned each. Further columns are
    ignored.
    """
    base = F.expr("array(" + ", ".join(_places(p) for p in BASE) + ")")
    gated = docs.select("doc_id", "text", _gate().alias("gate"))
    lower = F.translate("text", UPPER, LOWER)
    counted = gated.select(
        "doc_id",
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("n_words"),
        F.when(F.col("gate"), F.regexp_extract_all(lower, F.lit(f"({WORD})"), F.lit(1))).alias("words"),
    )
    placed = counted.select(
        "doc_id",
        "n_words",
        F.when(F.col("words").isNotNull(), base).alias("places"),
        F.when(
            F.col("words").isNotNull(),
            F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")),
        ).alias("line"),
    )
    tried = F.when(
        F.col("line").isNotNull(),
        F.filter(_rule_array(), lambda r: F.contains(F.col("line"), r["keyword"])),
    )
    found = placed.select("doc_id", "n_words", "places", "line", tried.alias("tried"))
    found = found.select(
        "doc_id", "n_words", "places", F.when(F.col("line").isNotNull(), F.expr(_FOUND)).alias("found")
    )
    kept = found.select(
        "doc_id",
        "n_words",
        F.flatten("places").alias("all_places"),
        F.filter(
            F.array(*[F.when(F.size(F.col("places")[i]) > 0, label) for i, label in enumerate(BASE.values())]),
            lambda x: x.isNotNull(),
        ).alias("base"),
        F.when(F.col("found").isNotNull(), F.expr(_KEPT)).alias("kept"),
    )
    no_labels = F.array().cast("array<string>")
    labels = F.array_union(F.col("base"), F.coalesce(F.col("kept.labels"), no_labels))
    return kept.select(
        "doc_id",
        "n_words",
        F.when(F.col("all_places").isNull(), 0).otherwise(F.size("all_places")).cast("long").alias("n_base"),
        F.array_min("all_places").cast("long").alias("first_word"),
        F.array_max("all_places").cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base")), ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"),
        F.greatest(
            F.coalesce("kept.confidence", F.lit(0.0)), F.when(F.size("base") > 0, 0.95).otherwise(0.0)
        ).alias("score"),
    )
