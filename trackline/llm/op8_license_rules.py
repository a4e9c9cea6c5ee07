"""License scans by sentence rules: normalised sentences become known identifiers, whose sequences match rules.

Only SQL functions, one pass per row, no shuffle: the tables of sentences and rules are constants.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackline.llm.common import table

# Licence sentences, lower-case letters and digits with single spaces between, by identifier.
SENTENCES = {
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-notice-long": "licensed under the apache license version 2 0 the license",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-basis": "unless required by applicable law or agreed to in writing software distributed under the license is "
                    "distributed on an as is basis without warranties or conditions of any kind either express or "
                    "implied",
    "apache-terms": "see the license for the specific language governing permissions and limitations under the license",
    "mit-notice": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and "
                 "associated documentation files the software to deal in the software without restriction including "
                 "without limitation the rights to use copy modify merge publish distribute sublicense and or sell "
                 "copies of the software and to permit persons to whom the software is furnished to do so subject to "
                 "the following conditions",
    "mit-keep": "the above copyright notice and this permission notice shall be included in all copies or substantial "
                "portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not "
                 "limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "gpl3-work": "this work is licensed under the gnu general public license version 3",
    "gpl3-notice": "licensed under the gnu general public license version 3",
    "gpl2-notice": "licensed under the gnu general public license version 2",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                "general public license as published by the free software foundation either version 3 of the license "
                "or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even "
                "the implied warranty of merchantability or fitness for a particular purpose",
    "gpl3-title": "gnu general public license version 3 29 june 2007",
    "gpl2-title": "gnu general public license version 2 june 1991",
    "gpl2-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                 "general public license as published by the free software foundation either version 2 of the license "
                 "or at your option any later version",
    "gpl2-only": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                 "general public license version 2 as published by the free software foundation",
    "agpl-title": "gnu affero general public license version 3 19 november 2007",
    "agpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu "
                 "affero general public license as published by the free software foundation either version 3 of the "
                 "license or at your option any later version",
    "agpl-notice": "licensed under the gnu affero general public license version 3",
    "lgpl3-title": "gnu lesser general public license version 3 29 june 2007",
    "lgpl21-title": "gnu lesser general public license version 2 1 february 1999",
    "lgpl21-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu "
                   "lesser general public license as published by the free software foundation either version 2 1 of "
                   "the license or at your option any later version",
    "lgpl3-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu "
                  "lesser general public license as published by the free software foundation either version 3 of the "
                  "license or at your option any later version",
    "lgpl-hope": "this library is distributed in the hope that it will be useful but without any warranty without even "
                 "the implied warranty of merchantability or fitness for a particular purpose",
    "epl2-title": "eclipse public license v 2 0",
    "epl2-available": "this program and the accompanying materials are made available under the terms of the eclipse "
                      "public license 2 0 which is available at",
    "epl2-accompanies": "this program and the accompanying materials are made available under the terms of the eclipse "
                        "public license v2 0 which accompanies this distribution",
    "apache-title": "apache license version 2 0 january 2004",
    "mpl-title": "mozilla public license version 2 0",
    "lgpl-notice": "licensed under the gnu lesser general public license version 3",
    "mpl-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "bsd-redistribute": "redistribution and use in source and binary forms with or without modification are permitted "
                        "provided that the following conditions are met",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                   "or promote products derived from this software without specific prior written permission",
    "bsd-no-endorse": "the name of the author may not be used to endorse or promote products derived from this software "
                      "without specific prior written permission",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is "
                 "hereby granted provided that the above copyright notice and this permission notice appear in all "
                 "copies",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "cc-by-nc-4": "licensed under cc by nc 4 0",
    "cc-by-4": "licensed under cc by 4 0",
    "cc-by-sa-4": "licensed under cc by sa 4 0",
    "cc0": "licensed under cc0 1 0",
}
# For each licence the sequences of identifiers that tell it, in order; other known sentences may stand
# between them only where the next rule says so. The first rule of a licence that matches is the one reported.
RULES = (
    ("Apache-2.0", "header", ("apache-notice-long", "apache-use", "apache-copy", "apache-basis", "apache-terms")),
    ("Apache-2.0", "notice", ("apache-notice",)),
    ("Apache-2.0", "notice", ("apache-notice-long",)),
    ("Apache-2.0", "title", ("apache-title",)),
    ("MIT", "text", ("mit-grant", "mit-keep", "mit-as-is")),
    ("MIT", "notice", ("mit-notice",)),
    ("MIT", "notice", ("mit-licensed",)),
    ("GPL-3.0", "header", ("gpl-free", "gpl-hope")),
    ("GPL-3.0", "notice", ("gpl3-work",)),
    ("GPL-3.0", "notice", ("gpl3-notice",)),
    ("GPL-3.0", "title", ("gpl3-title",)),
    ("GPL-2.0", "notice", ("gpl2-notice",)),
    ("GPL-2.0", "header", ("gpl2-free", "gpl-hope")),
    ("GPL-2.0", "header", ("gpl2-only",)),
    ("GPL-2.0", "title", ("gpl2-title",)),
    ("AGPL-3.0", "header", ("agpl-free", "gpl-hope")),
    ("AGPL-3.0", "notice", ("agpl-notice",)),
    ("AGPL-3.0", "title", ("agpl-title",)),
    ("LGPL-3.0", "notice", ("lgpl-notice",)),
    ("LGPL-3.0", "header", ("lgpl3-free", "lgpl-hope")),
    ("LGPL-3.0", "title", ("lgpl3-title",)),
    ("LGPL-2.1", "header", ("lgpl21-free", "lgpl-hope")),
    ("LGPL-2.1", "title", ("lgpl21-title",)),
    ("EPL-2.0", "header", ("epl2-available",)),
    ("EPL-2.0", "header", ("epl2-accompanies",)),
    ("EPL-2.0", "title", ("epl2-title",)),
    ("MPL-2.0", "notice", ("mpl-notice",)),
    ("MPL-2.0", "title", ("mpl-title",)),
    ("BSD-3-Clause", "text", ("bsd-redistribute", "bsd-endorse")),
    ("BSD-3-Clause", "text", ("bsd-redistribute", "bsd-no-endorse")),
    ("BSD-2-Clause", "text", ("bsd-redistribute",)),
    ("ISC", "text", ("isc-grant",)),
    ("Unlicense", "text", ("unlicense",)),
    ("CC-BY-NC-4.0", "notice", ("cc-by-nc-4",)),
    ("CC-BY-4.0", "notice", ("cc-by-4",)),
    ("CC-BY-SA-4.0", "notice", ("cc-by-sa-4",)),
    ("CC0-1.0", "notice", ("cc0",)),
)
#: Words of a sentence that stand for a name of up to SLOT_WORDS words, with ends of sentences in it ("Some Inc.").
SLOTS = {"bsd-endorse": "the copyright holder", "bsd-no-endorse": "the author"}
SLOT_WORDS = 12
#: Endings of a licence's name in a line "SPDX-License-Identifier: name"; of expressions with several names none is known.
TAG_ENDINGS = ("", "-only", "-or-later")
for _name in dict.fromkeys(name for name, _, _ in RULES):
    for _ending in TAG_ENDINGS:
        _words = re.sub("[^a-z0-9]+", " ", f"SPDX-License-Identifier {_name}{_ending}".lower())
        SENTENCES[f"tag-{_name}{_ending}"] = _words
        RULES += ((_name, "tag", (f"tag-{_name}{_ending}",)),)
#: A licence whose rule matched takes the place of the weaker ones its sentences are part of.
INSTEAD = {"BSD-3-Clause": "BSD-2-Clause"}
#: Rewrites of a text in lower case, in this order, that leave words, single spaces and three kinds of ends: "S" for the
#: end of a sentence or paragraph, "W" for a semicolon or colon, which may also stand inside a sentence, and "\n".
MARKS = (
    (r"[.!?](?=\s|$)", "S"),
    (r"[;:](?=\s|$)", "W"),
    (r"[^a-z0-9\nSW]+", " "),
    (r"[ W]*W[ W]*", "W"),
    (r"[ \nSW]*(?:S|\n[ W]?\n)[ \nSW]*", "S"),
    (r"[ \nW]*W[ \nW]*", "W"),
    (r" ?\n ?", "\n"),
)
NUMBERS = {name: k + 1 for k, name in enumerate(SENTENCES)}


def _pattern(name: str, gap: str, slot_gap: str) -> str:
    """A sentence's words with `gap` between; a slot's words with `slot_gap`."""
    words = SENTENCES[name]
    if name not in SLOTS:
        return words.replace(" ", gap)
    before, after = words.split(f" {SLOTS[name]} ")
    slot = f"{gap}[a-z0-9]+(?:{slot_gap}[a-z0-9]+){{0,{SLOT_WORDS - 1}}}?{slot_gap}"
    return before.replace(" ", gap) + slot + after.replace(" ", gap)


def _known(gap: str, slot_gap: str) -> str:
    """All sentences, the longest that begins at a place first; those of one first word share it."""
    first: dict[str, list[str]] = {}
    for name, words in sorted(SENTENCES.items(), key=lambda item: -len(item[1])):
        first.setdefault(words.split(" ")[0], []).append(name)
    return "(?:" + "|".join(word + "(?:" + "|".join(_pattern(name, gap, slot_gap)[len(word):] for name in names) + ")"
                            for word, names in first.items()) + ")"


#: A known sentence from one end to another, over any number of lines.
KNOWN = f"(?<![a-z0-9 ]){_known('[ \\nW]', '[ \\nSW]')}(?![a-z0-9 ])"


def _codes(names: tuple[str, ...]) -> str:
    return "".join(f",{NUMBERS[name]}," for name in names)


def identifiers(text: Column) -> Column:
    """The known sentences of a text as text, in their order: ",3,,7,". Sentences that are not known are left out.

    A sentence may go on in the next lines, from the beginning of a line or sentence to the end of one. Lines without a
    letter or digit end it.
    """
    known = F.create_map(*(F.lit(x) for name, words in SENTENCES.items() for x in (words, f",{NUMBERS[name]},")))

    def code(found: Column) -> Column:
        words = F.translate(found, "\nSW", "   ")
        slots = [F.when(words.rlike(f"^{_pattern(name, ' ', ' ')}$"), F.lit(f",{NUMBERS[name]},")) for name in SLOTS]
        return F.coalesce(F.element_at(known, words), *slots)

    plain = F.lower(text)
    for pattern, mark in MARKS:
        plain = F.regexp_replace(plain, pattern, mark)
    found = F.regexp_extract_all(F.trim(plain), F.lit(KNOWN), F.lit(0))
    return F.array_join(F.transform(found, code), "")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_sentences, licenses, rules) for every row of `docs`.

    `n_sentences` counts known sentences, `licenses` names the licences whose rules match, by the order of RULES,
    joined by commas, and `rules` says which: "name/kind".

    Null and empty texts have none: 0 and empty strings. Each row is scanned whole, whatever its id; very long texts
    and repeated rows are no exception, and rules that match twice are named once. An empty table gives no rows. Other
    columns play no part, whatever their names.
    """
    found = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(identifiers(F.col(text_col)), F.lit("")).alias("ids"))
    names = list(dict.fromkeys(name for name, _, _ in RULES))
    ways = {name: [(kind, _codes(ids)) for other, kind, ids in RULES if other == name] for name in names}
    kind_of = {}
    for name in names:
        first = F.lit(None).cast("string")
        for kind, codes in reversed(ways[name]):
            first = F.when(F.contains("ids", F.lit(codes)), F.lit(kind)).otherwise(first)
        kind_of[name] = first
    for strong, weak in INSTEAD.items():
        kind_of[weak] = F.when(kind_of[strong].isNull(), kind_of[weak])
    licenses = F.concat_ws(",", *(F.when(kind.isNotNull(), F.lit(name)) for name, kind in kind_of.items()))
    rules = F.concat_ws(",", *(F.concat(F.lit(f"{name}/"), kind) for name, kind in kind_of.items()))
    count = F.length("ids") - F.length(F.replace("ids", F.lit(","), F.lit("")))
    return found.select("doc_id", F.floor(count / 2).cast("long").alias("n_sentences"), licenses.alias("licenses"),
                        rules.alias("rules"))


def op8_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def _sql_kind(name: str) -> str:
    cases = " ".join(f"WHEN contains(ids, '{_codes(ids)}') THEN '{kind}'" for other, kind, ids in RULES
                     if other == name)
    return f"CASE {cases} END"


def _sql() -> str:
    names = list(dict.fromkeys(name for name, _, _ in RULES))
    weaker = {weak: strong for strong, weak in INSTEAD.items()}
    kinds = ", ".join(f"CASE WHEN ({_sql_kind(weaker[name])}) IS NULL THEN {_sql_kind(name)} END" if name in weaker
                      else _sql_kind(name) for name in names)
    values = ", ".join(f"('{words}', ',{NUMBERS[name]},')" for name, words in SENTENCES.items())
    slots = " ".join(f"WHEN regexp_full_match(words, '{_pattern(name, ' ', ' ')}') THEN ',{NUMBERS[name]},'"
                     for name in SLOTS)
    pairs = ", ".join(f"CASE WHEN kinds[{k + 1}] IS NOT NULL THEN '{name}' END" for k, name in enumerate(names))
    rules = ", ".join(f"'{name}/' || kinds[{k + 1}]" for k, name in enumerate(names))
    plain = "lower(coalesce(text, ''))"
    for pattern, mark in MARKS:
        # without looking ahead: what follows is put back; every end is doubled, so that neighbours need not share it
        if pattern.endswith(r"(?=\s|$)"):
            pattern, mark = pattern.replace(r"(?=\s|$)", r"([\t\n\x0B\f\r ]|$)"), mark + r"\1"
        mark = "chr(10)" if mark == "\n" else f"'{mark}'"
        plain = f"regexp_replace({plain}, '{pattern}', {mark}, 'g')"
    plain = rf"'S' || regexp_replace(trim({plain}), '([\nSW])', '\1\1', 'g') || 'S'"
    known = rf"[\nSW]{_known('(?: |WW|' + chr(92) + 'n' + chr(92) + 'n)', '(?: |SS|WW|' + chr(92) + 'n' + chr(92) + 'n)')}[\nSW]"
    return f"""
WITH known(sentence, code) AS (VALUES {values}
), found AS (SELECT doc_id, regexp_extract_all({plain}, '{known}') AS all_found FROM documents
), parts AS (
  SELECT doc_id, generate_subscripts(all_found, 1) AS pos,
         trim(regexp_replace(unnest(all_found), '[\\nSW]+', ' ', 'g')) AS words FROM found
), codes AS (
  SELECT doc_id, pos, coalesce(code, CASE {slots} END) AS code FROM parts LEFT JOIN known ON sentence = words
), ids AS (
  SELECT doc_id, coalesce(string_agg(code, '' ORDER BY pos), '') AS ids, count(code) AS n_sentences
  FROM (SELECT doc_id, NULL::BIGINT AS pos, NULL AS code FROM documents UNION ALL SELECT doc_id, pos, code FROM codes)
  GROUP BY doc_id
), marked AS (SELECT doc_id, n_sentences, [{kinds}] AS kinds FROM ids)
SELECT doc_id, n_sentences, concat_ws(',', {pairs}) AS licenses, concat_ws(',', {rules}) AS rules FROM marked
"""


SQL = _sql()
