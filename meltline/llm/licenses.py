"""Licence detection by ordered signature rules, with DataFrame functions only.

A text is reduced to its lower-case words with single spaces. Rules are regular expressions over that form, each with a
label, a keyword and a priority: 3 for identifiers and full grants, 2 for names with a version, 1 for bare names and
hints. A rule runs only where its keyword occurs (and none where no keyword family occurs). Detections are intervals;
one that lies inside another of the same or a higher priority is suppressed, partly overlapping ones all stay.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Phrases whose places are counted, and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: label | keyword | pattern of the name. Patterns see lower-case words with single spaces; "v" stands for version words.
NAMES = r"""
apache-2.0 | apache | apache (?:software )?(?:foundation )?(?:license|licence|v)(?: v?ersion)?(?: v)? ?2(?: 0)?
apache-1.1 | apache | apache (?:software )?(?:license|licence)(?: v?ersion)?(?: v)? ?1 1
apache | apache | apache (?:software )?(?:license|licence)
gpl-3.0 | general public | gnu general public (?:license|licence)(?: v?ersion)?(?: v)? ?3(?: 0)?
gpl-2.0 | general public | gnu general public (?:license|licence)(?: v?ersion)?(?: v)? ?2(?: 0)?
gpl-1.0 | general public | gnu general public (?:license|licence)(?: v?ersion)?(?: v)? ?1(?: 0)?
gpl-3.0 | gpl | (?:gnu )?gpl(?: v?ersion)?(?: v| )?3(?: 0)?
gpl-2.0 | gpl | (?:gnu )?gpl(?: v?ersion)?(?: v| )?2(?: 0)?
lgpl-3.0 | lesser general | gnu lesser general public (?:license|licence)(?: v?ersion)?(?: v)? ?3(?: 0)?
lgpl-2.1 | lesser general | gnu lesser general public (?:license|licence)(?: v?ersion)?(?: v)? ?2 1
lgpl-2.0 | library general | gnu library general public (?:license|licence)(?: v?ersion)?(?: v)? ?2(?: 0)?
lgpl | lesser general | (?:gnu )?lesser general public (?:license|licence)
lgpl-2.1 | lgpl | (?:gnu )?lgpl(?: v?ersion)?(?: v| )?2 1
lgpl-3.0 | lgpl | (?:gnu )?lgpl(?: v?ersion)?(?: v| )?3(?: 0)?
agpl-3.0 | affero | (?:gnu )?affero general public (?:license|licence)(?: v?ersion)?(?: v)? ?3(?: 0)?
agpl-1.0 | affero | affero general public (?:license|licence)(?: v?ersion)?(?: v)? ?1(?: 0)?
agpl-3.0 | agpl | (?:gnu )?agpl(?: v?ersion)?(?: v| )?3(?: 0)?
fdl-1.3 | free documentation | gnu free documentation (?:license|licence)(?: v?ersion)?(?: v)? ?1 3
fdl-1.2 | free documentation | gnu free documentation (?:license|licence)(?: v?ersion)?(?: v)? ?1 2
fdl | free documentation | gnu free documentation (?:license|licence)
mit | mit | (?:the )?mit (?:x11 )?(?:license|licence)
mit-0 | mit no | mit no attribution
mit-0 | mit 0 | mit 0(?: license)?
x11 | x11 | x11 (?:license|licence)
x11 | x consortium | x consortium (?:license|licence)
bsd-2-clause | bsd | (?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd)(?: license| licence)?
bsd-3-clause | bsd | (?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd)(?: license| licence)?
bsd-4-clause | bsd | (?:original bsd|old bsd|bsd 4 clause|4 clause bsd|four clause bsd)(?: license| licence)?
bsd-0-clause | bsd | (?:zero clause bsd|bsd 0 clause|0bsd)(?: license| licence)?
bsd | bsd | bsd (?:style )?(?:license|licence)
isc | isc | isc (?:license|licence)
mpl-2.0 | mozilla | mozilla public (?:license|licence)(?: v?ersion)?(?: v)? ?2 0
mpl-1.1 | mozilla | mozilla public (?:license|licence)(?: v?ersion)?(?: v)? ?1 1
mpl-1.0 | mozilla | mozilla public (?:license|licence)(?: v?ersion)?(?: v)? ?1 0
mpl | mozilla | mozilla public (?:license|licence)
epl-2.0 | eclipse | eclipse public (?:license|licence)(?: v?ersion)?(?: v)? ?2 0
epl-1.0 | eclipse | eclipse public (?:license|licence)(?: v?ersion)?(?: v)? ?1 0
cddl-1.0 | common development | common development and distribution (?:license|licence)(?: v?ersion)?(?: v)? ?1 0
cddl-1.1 | common development | common development and distribution (?:license|licence)(?: v?ersion)?(?: v)? ?1 1
cpl-1.0 | common public | common public (?:license|licence)(?: v?ersion)?(?: v)? ?1 0
ipl-1.0 | ibm | ibm public (?:license|licence)(?: v?ersion)?(?: v)? ?1 0
eupl-1.2 | european union | european union public (?:license|licence)(?: v?ersion)?(?: v)? ?1 2
eupl-1.1 | european union | european union public (?:license|licence)(?: v?ersion)?(?: v)? ?1 1
cecill-2.1 | cecill | cecill(?: v?ersion)?(?: v)? ?2 1
cecill-b | cecill | cecill b
cecill-c | cecill | cecill c
artistic-2.0 | artistic | artistic (?:license|licence)(?: v?ersion)?(?: v)? ?2 0
artistic-1.0 | artistic | artistic (?:license|licence)(?: v?ersion)?(?: v)? ?1 0
perl | perl | same terms as perl(?: itself)?
psf-2.0 | python software | python software foundation (?:license|licence)(?: v?ersion)?(?: 2)?
zlib | zlib | (?:the )?zlib(?: libpng)? (?:license|licence)
libpng | libpng | libpng (?:license|licence)
bsl-1.0 | boost | boost software (?:license|licence)(?: v?ersion)?(?: v)?(?: 1 0)?
busl-1.1 | business source | business source (?:license|licence)(?: v?ersion)?(?: v)? ?1 1
sspl-1.0 | server side | server side public (?:license|licence)(?: v?ersion)?(?: v)?(?: 1)?
elastic-2.0 | elastic | elastic (?:license|licence)(?: v?ersion)?(?: v)? ?2(?: 0)?
unlicense | unlicense | (?:the )?unlicense
wtfpl | wtfpl | wtfpl
wtfpl | what the fuck | do what the fuck you want to public (?:license|licence)
cc0-1.0 | cc0 | cc0(?: 1 0)?(?: universal)?
cc0-1.0 | creative commons | creative commons (?:zero|cc0)(?: v?1 0)?(?: universal)?
cc-pdm-1.0 | public domain | public domain mark(?: 1 0)?
public-domain | public domain | (?:in|into|to) the public domain
ofl-1.1 | open font | (?:sil )?open font (?:license|licence)(?: v?ersion)?(?: v)?(?: 1 1)?
odbl-1.0 | database licen | open (?:data commons )?(?:open )?database (?:license|licence)(?: v?1 0)?
odc-by-1.0 | open data commons | open data commons attribution (?:license|licence)
pddl-1.0 | public domain dedication | public domain dedication and (?:license|licence)
ogl-3.0 | open government | open government (?:license|licence)(?: v?ersion)?(?: v)? ?3(?: 0)?
ogl | open government | open government (?:license|licence)
openssl | openssl | openssl (?:license|licence)
php-3.01 | php | php (?:license|licence)(?: v?ersion)?(?: v)? ?3 0?1
ruby | ruby | ruby (?:license|licence)
ms-pl | microsoft | microsoft public (?:license|licence)
ms-rl | microsoft | microsoft reciprocal (?:license|licence)
ncsa | illinois | university of illinois ncsa open source (?:license|licence)
postgresql | postgresql | postgresql (?:license|licence)
unicode | unicode | unicode (?:license agreement|license)
unicode | unicode terms | unicode terms of use
w3c | w3c | w3c software (?:notice and )?(?:license|licence)
afl-3.0 | academic free | academic free (?:license|licence)(?: v?ersion)?(?: v)?(?: 3 0)?
osl-3.0 | open software | open software (?:license|licence)(?: v?ersion)?(?: v)?(?: 3 0)?
qpl-1.0 | q public | q public (?:license|licence)(?: 1 0)?
sleepycat | sleepycat | sleepycat (?:license|licence)
vim | vim | vim (?:license|licence)
beerware | beer | (?:beer ?ware|the beer) (?:license|licence)
json | good not evil | shall be used for good not evil
upl-1.0 | universal permissive | universal permissive (?:license|licence)(?: v?1 0)?
blueoak-1.0.0 | blue oak | blue oak model (?:license|licence)(?: 1 0 0)?
polyform-nc | polyform | polyform noncommercial (?:license|licence)
commons-clause | commons clause | commons clause
llama | llama | llama (?:2|3|3 1)? ?community (?:license|licence)
rail | responsible ai | (?:open )?responsible ai (?:license|licence)
"""

#: Sentences that stand in the text of one licence, or that grant or reserve rights: label | keyword | pattern | priority.
SENTENCES = r"""
mit | permission is hereby | permission is hereby granted free of charge to any person obtaining a copy | 3
mit | the software is provided as is | the software is provided as is without warranty of any kind | 1
isc | permission to use copy modify | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted | 3
bsd | redistribution and use | redistribution and use in source and binary forms with or without modification are permitted | 3
bsd-3-clause | endorse or promote | may be used to endorse or promote products derived from this software | 2
apache-2.0 | you may not use this file | you may not use this file except in compliance with the license | 2
gpl | free software you can | this program is free software you can redistribute it and or modify | 3
lgpl | free software you can | this library is free software you can redistribute it and or modify | 3
gpl-or-later | any later version | (?:or )?at your option any later version | 2
zlib | altered source versions | altered source versions must be plainly marked as such | 3
mpl-2.0 | source code form | this source code form is subject to the terms of the mozilla public license | 3
unlicense | unencumbered | free and unencumbered software released into the public domain | 3
cc0-1.0 | waived all copyright | has waived all copyright and related | 3
public-domain | dedicated to | dedicated to the public domain | 2
reserved | rights reserved | (?:all|some|no) rights reserved | 1
reserved | unauthorized copying | unauthorized copying of this file | 2
proprietary | proprietary | proprietary and confidential | 2
proprietary | confidential | confidential and proprietary | 2
copyright | copyright | copyright (?:c )?(?:19|20)\d\d | 1
no-warranty | warranty | without (?:any )?warranty | 1
no-derivatives | derivative works | no derivative works | 1
"""

#: Creative Commons terms; versions and spellings are made from them.
CC_TERMS = ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd")
CC_WORDS = {"by": "attribution", "sa": "share ?alike", "nc": "non ?commercial", "nd": "no ?deriv(?:atives|s|ative works)"}
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
#: Words before a name that make it a grant.
GRANT = r"(?:(?:re)?(?:licensed|released|distributed|available|published|provided)(?: only)? (?:under|in accordance with)(?: the)?(?: terms of)?(?: the)?|licen[sc]e) "
#: Words of which most rules need one; families() adds what the others need.
FAMILIES = (
    "licen", "copyright", "rights reserved", "public domain", "gpl", "cc by", "cc0", "bsd", "spdx", "warranty", "permission", "redistribut",
    "creative commons", "wtfpl", "proprietary", "affero", "general public", "free software", "cecill", "commons clause", "same terms as perl",
    "good not evil", "endorse or promote", "altered source", "confidential", "derivative works", "later version", "unauthorized copying", "mit 0", "mit no", "source code form",
)


def rules() -> list[tuple[str, str, str, int]]:
    """(label, keyword, pattern, priority) of all rules, in order: a name alone, the name in a grant, terms, sentences."""
    out = []
    for line in NAMES.strip().splitlines():
        label, keyword, pattern = (x.strip() for x in line.split(" | ", 2))
        pattern = pattern.replace("v?ersion", "version").replace("(?: v)? ?", "(?: v| )?")
        out += [(label, keyword, pattern, 2 if any(c.isdigit() for c in label) else 1), (label, keyword, GRANT + pattern, 3)]
    for terms in CC_TERMS:
        label = "cc-" + terms.replace(" ", "-")
        names = " ".join(CC_WORDS[t] for t in terms.split())
        out += [(label, "cc by", f"cc {terms}", 1), (label, "creative commons", f"creative commons {names}", 1)]
        for v in CC_VERSIONS:
            with_v = f"{label}-{v.replace(' ', '.')}"
            out += [(with_v, "cc by", f"cc {terms} {v}", 2), (with_v, "cc by", GRANT + f"cc {terms} {v}", 3), (with_v, "creative commons", f"creative commons {names} (?:international |license |licence |v)*{v}", 2)]
    for label in sorted({r[0] for r in out}):
        out.append((label, "spdx", "spdx license identifier " + label.replace("-", " ").replace(".", " ") + "(?: only| or later)?", 3))
    for line in SENTENCES.strip().splitlines():
        label, keyword, pattern, priority = (x.strip() for x in line.split(" | "))
        out.append((label, keyword, pattern, int(priority)))
    return out


def families() -> list[str]:
    """Words of which one is in every match of every rule: FAMILIES, and the keywords of rules that match without them."""
    out = list(FAMILIES)
    for _, keyword, pattern, _ in rules():
        fixed = re.sub(r"\(\?:licen[cs]e(?: agreement)?\|licen[cs]e\)(?![?*])", "licen", pattern)
        while fixed != (fixed := re.sub(r"\((?:\?:)?[^()]*\)[?*]?", "|", fixed)):
            pass
        fixed = re.sub(r"\\d|\[[^]]*\]|.\?", "|", fixed)
        if keyword not in out and not any(f in fixed for f in FAMILIES):
            out.append(keyword)
    return out


def word_form(text: Column) -> Column:
    """Lower-case words, each with one space on both sides: empty, or ' w1 w2 '."""
    low = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    spaced = F.regexp_replace(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    return F.when(F.trim(spaced) == "", F.lit("")).otherwise(F.concat(F.lit(" "), F.trim(spaced), F.lit(" ")))


def _count(text: Column, part: str) -> Column:
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("long")


def _detections(form: Column, found: list[tuple[str, str, str, int]]) -> Column:
    """label, priority, start and end (in characters of the word form) of every match of every rule."""
    fixed = F.array(*[F.struct(F.lit(a).alias("label"), F.lit(k).alias("keyword"), F.lit(f"(?<= ){p}(?= )").alias("pattern"), F.lit(n).alias("priority")) for a, k, p, n in found])
    fit = F.filter(fixed, lambda r: F.contains(form, r.keyword))

    def places(r: Column) -> Column:
        hits = F.regexp_extract_all(form, r.pattern, F.lit(0))
        gaps = F.split(form, r.pattern, -1)
        zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

        def step(acc: Column, pair: Column) -> Column:
            start = acc.at + F.length(pair.gap)
            end = start + F.length(pair.hit)
            return F.struct(end.alias("at"), F.concat(acc.out, F.array(F.struct(start.alias("start"), end.alias("end")))).alias("out"))

        pairs = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
        spans = F.aggregate(pairs, zero, step, lambda acc: acc.out)
        return F.transform(spans, lambda s: F.struct(s.start.alias("start"), (-s.end).alias("minus_end"), (-r.priority).alias("minus_priority"), r.label.alias("label")))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(fit, places))))


def _suppressed(sorted_found: Column) -> Column:
    """Detections that don't lie inside one of the same or a higher priority. They come by start, longest first."""
    kind = "array<struct<start:int,minus_end:int,minus_priority:int,label:string>>"
    zero = F.struct(F.lit(-1).alias("e1"), F.lit(-1).alias("e2"), F.lit(-1).alias("e3"), F.array().cast(kind).alias("out"))

    def step(acc: Column, d: Column) -> Column:
        p, end = -d.minus_priority, -d.minus_end
        covered = F.greatest(F.when(p <= 1, acc.e1).otherwise(-1), F.when(p <= 2, acc.e2).otherwise(-1), acc.e3) >= end
        reach = [F.when((p == n) & ~covered, F.greatest(acc[f"e{n}"], end)).otherwise(acc[f"e{n}"]).alias(f"e{n}") for n in (1, 2, 3)]
        return F.struct(*reach, F.when(covered, acc.out).otherwise(F.concat(acc.out, F.array(d))).alias("out"))

    return F.aggregate(sorted_found, zero, step, lambda acc: acc.out)


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections for every row of docs.

    n_base counts all places of the PHRASES, first_word and last_word are the smallest and largest word at which one
    starts. labels are those of the detections that stay, and base_labels. detections holds label, priority and
    character span in the word form. score is 0 without detections, else grows with the highest priority (0.5, 0.75,
    1). Null and empty texts have no words, no detections and empty labels. Rows are scanned one by one, repeated ones
    too; an empty table gives an empty result; other columns aren't read.
    """
    rows = docs.select("doc_id", word_form(F.col("text")).alias("form"))
    form = F.col("form")
    any_family = form.rlike("|".join(families()))
    out = rows.withColumn("n_words", F.greatest(F.lit(0), F.length(form) - F.length(F.replace(form, F.lit(" "), F.lit(""))) - 1).cast("long"))
    out = out.withColumn("gate", any_family)
    doubled = F.when(form.rlike("|".join(f" {p} " for p, _ in PHRASES)), F.replace(form, F.lit(" "), F.lit("  "))).otherwise(F.lit(""))
    out = out.withColumn("doubled", doubled)
    counts, firsts, lasts = [], [], []
    for k, (phrase, label) in enumerate(PHRASES):
        mark = f" {phrase.replace(' ', '  ')} "
        spaces = lambda c: F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
        n = _count(F.col("doubled"), mark)
        counts.append(n)
        before, after = F.substring_index("doubled", mark, 1), F.substring_index("doubled", mark, -1)
        firsts.append(F.when(n > 0, ((spaces(before) - 1) / 2).cast("long")))
        lasts.append(F.when(n > 0, F.col("n_words") - len(phrase.split()) - ((spaces(after) - 1) / 2).cast("long")))
    base = F.array_compact(F.array(*[F.when(n > 0, F.lit(label)) for n, (_, label) in zip(counts, PHRASES)]))
    out = out.withColumns({
        "n_base": sum(counts[1:], counts[0]), "first_word": F.least(*firsts), "last_word": F.greatest(*lasts), "base": base,
        "found": F.when(F.col("gate"), _suppressed(_detections(form, rules()))),
    })
    labels = F.array_sort(F.array_distinct(F.concat("base", F.transform(F.coalesce("found", F.array().cast("array<struct<start:int,minus_end:int,minus_priority:int,label:string>>")), lambda d: d.label))))
    best = F.aggregate("found", F.lit(0), lambda a, d: F.greatest(a, -d.minus_priority))
    score = F.greatest(F.when(F.col("n_base") > 0, 0.5).otherwise(0.0), F.coalesce(F.when(best > 0, 0.25 + best * 0.25), F.lit(0.0)))
    return out.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join(F.array_sort("base"), ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        score.alias("score"),
        F.transform("found", lambda d: F.struct(d.label.alias("label"), (-d.minus_priority).alias("priority"), d.start.alias("start"), (-d.minus_end).alias("end"))).alias("detections"),
    )
