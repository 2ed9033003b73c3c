"""Licence scan: sentences that licences are made of are recognised, and their sequence is matched to licence rules.

Texts are unwrapped and cut into sentences, sentences reduced to lower-case words, and known ones replaced by their
identifiers; a run of others is one ``_``. Rules are sequences of identifiers; they are tried in order, the longer ones
first, and what a rule has matched is not matched again. All of it is DataFrame expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names in the words that follow "licensed under", with the licence that they are.
NAMES = {
    "the mit license": "MIT",
    "the apache license version 2.0": "Apache-2.0",
    "the apache 2.0 license": "Apache-2.0",
    "the bsd 2 clause license": "BSD-2-Clause",
    "the bsd 3 clause license": "BSD-3-Clause",
    "the isc license": "ISC",
    "the zlib license": "Zlib",
    "the unlicense": "Unlicense",
    "the boost software license version 1.0": "BSL-1.0",
    "the mozilla public license version 2.0": "MPL-2.0",
    "the eclipse public license version 1.0": "EPL-1.0",
    "the eclipse public license version 2.0": "EPL-2.0",
    "cc0 1.0": "CC0-1.0",
}
# Beginnings that a name follows.
LINES = ("licensed under", "released under", "distributed under", "this work is licensed under", "this software is licensed under",
         "this project is licensed under")
# The GNU family, (name, words, versions).
GNU = (
    ("GPL", "gnu general public license", ("2", "3")),
    ("LGPL", "gnu lesser general public license", ("2.1", "3")),
    ("LGPL", "gnu library general public license", ("2",)),
    ("AGPL", "gnu affero general public license", ("3",)),
)
# The parts of Creative Commons licences in words.
COMMONS = {
    "BY": "attribution", "BY-SA": "attribution sharealike", "BY-NC": "attribution noncommercial",
    "BY-NC-SA": "attribution noncommercial sharealike", "BY-ND": "attribution noderivatives",
    "BY-NC-ND": "attribution noncommercial noderivatives",
}

# Sentences of public licences and notices, in the form that `normalised` gives them.
TEXTS = {
    "licensed under the apache license version 2.0 the license": "ApacheGrant",
    "you may not use this file except in compliance with the license": "ApacheUse",
    "you may obtain a copy of the license at http www.apache.org licenses license 2.0": "ApacheCopy",
    "you may obtain a copy of the license at": "ApacheCopy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "ApacheWarranty",
    "see the license for the specific language governing permissions and limitations under the license": "ApacheSee",
    "mit license": "MitTitle",
    "the mit license": "MitTitle",
    "the mit license mit": "MitTitle",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MitGrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MitNotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MitWarranty",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "MitLiability",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BsdGrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BsdSource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BsdBinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BsdName",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "BsdWarranty",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "IscGrant",
    "this software is provided as is without any express or implied warranty": "ZlibWarranty",
    "in no event will the authors be held liable for any damages arising from the use of this software": "ZlibLiability",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "ZlibGrant",
    "boost software license version 1.0 august 17th 2003": "BoostTitle",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following": "BoostGrant",
    "this is free and unencumbered software released into the public domain": "UnlicenseTitle",
    "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means": "UnlicenseGrant",
    "this source code form is subject to the terms of the mozilla public license version 2.0": "MplGrant",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0 which is available at https www.eclipse.org legal epl 2.0": "Epl2Grant",
    "this program and the accompanying materials are made available under the terms of the eclipse public license version 2.0 which accompanies this distribution": "Epl2Grant",
    "this program and the accompanying materials are made available under the terms of the eclipse public license version 1.0 which accompanies this distribution": "Epl1Grant",
    "this program is free software": "GnuFree",
    "this library is free software": "GnuFree",
    "this program is distributed in the hope that it will be useful but without any warranty": "GnuWarranty",
    "this library is distributed in the hope that it will be useful but without any warranty": "GnuWarranty",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "GnuWarranty",
    "all rights reserved": "Reserved",
}
#: Beginnings of sentences of which the rest varies.
BEGINNINGS = {"copyright ": "Copyright", "c copyright ": "Copyright"}

# Ordered rules. A rule stands before those that its parts would match.
TEXT_RULES = [
    ("ApacheGrant ApacheUse ApacheCopy ApacheWarranty ApacheSee", "Apache-2.0"),
    ("ApacheGrant ApacheUse ApacheCopy", "Apache-2.0"),
    ("MitGrant MitNotice MitWarranty MitLiability", "MIT"),
    ("MitGrant MitNotice", "MIT"),
    ("IscGrant", "ISC"),
    ("BsdGrant BsdSource BsdBinary BsdName", "BSD-3-Clause"),
    ("BsdGrant BsdSource BsdBinary", "BSD-2-Clause"),
    ("ZlibWarranty ZlibLiability ZlibGrant", "Zlib"),
    ("ZlibGrant", "Zlib"),
    ("BoostTitle BoostGrant", "BSL-1.0"),
    ("BoostGrant", "BSL-1.0"),
    ("UnlicenseTitle UnlicenseGrant", "Unlicense"),
    ("UnlicenseTitle", "Unlicense"),
    ("MplGrant", "MPL-2.0"),
    ("Epl2Grant", "EPL-2.0"),
    ("Epl1Grant", "EPL-1.0"),
    ("Copyright Reserved", "LicenseRef-all-rights-reserved"),
]


def _catalogue() -> tuple[dict[str, str], list[tuple[str, str]]]:
    """All sentences with their identifiers, and all rules in order: the fixed ones and those of the families."""
    names, sentences, rules = dict(NAMES), dict(TEXTS), []
    for part, words in COMMONS.items():
        names[f"cc {part.lower().replace('-', ' ')} 4.0"] = f"CC-{part}-4.0"
        names[f"a creative commons {words} 4.0 international license"] = f"CC-{part}-4.0"
        names[f"the creative commons {words} 4.0 international license"] = f"CC-{part}-4.0"
    for name, words, versions in GNU:
        terms = f"you can redistribute it and or modify it under the terms of the {words}"
        published = "as published by the free software foundation"
        sentences[f"{terms} {published}"] = f"{name}/terms"
        sentences[f"see the {words} for more details"] = f"{name}/see"
        sentences |= {f"you should have received a copy of the {words} along with this {x}": f"{name}/copy" for x in ("program", "library")}
        for version in versions:
            only, later = (f"{name}-{version if '.' in version else version + '.0'}-{x}" for x in ("only", "or-later"))
            names |= {f"the {words} version {version}": only, f"the {words} version {version} only": only, f"the {words} version {version} or later": later}
            any_later = f"either version {version} of the license or at your option any later version"
            sentences[any_later] = f"later-than-{version}"
            sentences[f"{terms} {published} {any_later}"] = f"{later}/terms"
            sentences |= {f"this {x} is free software {terms} {published} {any_later}": f"{later}/terms" for x in ("program", "library")}
            sentences[f"{terms} version {version} {published}"] = sentences[f"{terms} version {version} only {published}"] = f"{only}/terms"
            rules += [(f"{name}/terms later-than-{version}", later), (f"{later}/terms", later), (f"{only}/terms", only)]
    for words, name in names.items():
        sentences |= {f"{line} {words}": f"{name}/line" for line in LINES}
    for name in sorted({name for _, name in TEXT_RULES + rules if not name.startswith("LicenseRef")} | set(names.values())):
        sentences["spdx license identifier " + re.sub(NOT_WORDS, " ", name.lower())] = f"{name}/tag"
        rules += [(f"{name}/line", name), (f"{name}/tag", name)]
    # a rule comes once, though two families lead to it
    return sentences, list(dict.fromkeys(TEXT_RULES + rules))


#: A word of every known sentence, so a text without any has none; one word each, as a line may end between two.
TRIGGER = r"(?i)licen[cs]e|permission|distribut|warrant|copyright|liable|reserved|free\b|\bcc\b|cc0"

#: Marks of comments and quotations that may begin a line.
_MARKS = r"[ \t]*\r?\n[ \t]*[/*#;%!>|-]*[ \t]*"
#: Words that no sentence ends with, and words that names of licences go on with.
_GOES_ON = r"a|an|the|this|of|on|under|by|to|with|and|or|for|in|at|either|gnu|general|lesser|library|affero|apache|mozilla|eclipse|boost|public|software|free|creative|commons|international"
_NAME = r"GNU|General|Lesser|Library|Affero|Public|License|Software|Foundation|Free|Apache|Mozilla|Eclipse|Boost|MIT|BSD|ISC|CC|Creative|Commons|Attribution"
#: What is put on one line before sentences are cut. A tag is a sentence to the end of its line. A line end is within a
#: sentence where lower case goes on below, or capitals below capitals, or a line ends with a word that must go on and a
#: licence's name goes on below. Then versions, whose marks end no sentence.
WRAPS = [
    (r"(SPDX-License-Identifier):[ \t]*([^\r\n]*)", "$1 $2."),
    (rf"(Attribution[A-Za-z-]*){_MARKS}(4\.0)", "$1 $2"),
    (rf"(4\.0){_MARKS}(International)", "$1 $2"),
    (rf"([A-Za-z0-9,)\"]){_MARKS}([a-z(])", "$1 $2"),
    (rf"([A-Z]{{2,}}[,\"]?|\sA){_MARKS}([A-Z]{{2,}})", "$1 $2"),
    (rf"(,){_MARKS}(Version|[\"0-9])", "$1 $2"),
    (rf"([\s(\"](?i:{_GOES_ON})){_MARKS}((?:{_NAME})\b|[\"0-9])", "$1 $2"),
    (rf"([ \t(])(?i:v|v\.|version)(?:{_MARKS}|[ \t]*)([0-9])", "$1version $2"),
]
#: Ends of sentences: a line end, or a mark before white space.
ENDS = r"\n|[.!?:;]+(?:\s+|$)"
#: A number or letter that an item of a list begins with, in brackets, and one that stands alone.
ITEM = r"^[^A-Za-z0-9(]*\(?(?:[0-9]{1,2}|[A-Za-z])\)[ \t]+"
ITEM_ALONE = r"^(?:[0-9]{1,2}|[a-z])$"
NOT_WORDS = r"[^a-z0-9.+]+"

SENTENCES, RULES = _catalogue()


def normalised(sentence: Column) -> Column:
    """Lower-case words, digits, points and pluses, one blank between, without the number of a list's item."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(sentence, ITEM, "")), NOT_WORDS, " "), F.lit(" ."))


def sentence_ids(text: Column) -> Column:
    """The identifiers of a text's sentences, in order, blank before and after each; ``_`` for a run of others."""
    for pattern, by in WRAPS:
        text = F.regexp_replace(text, pattern, by)
    known = F.str_to_map(F.lit("\n".join(f"{s}={i}" for s, i in SENTENCES.items())), F.lit("\n"), F.lit("="))

    def identifier(sentence: Column) -> Column:
        found = F.try_element_at(known, sentence)
        for start, name in BEGINNINGS.items():
            found = F.coalesce(found, F.when(sentence.startswith(start), F.lit(name)))
        return F.coalesce(found, F.lit("_"))

    words = F.filter(F.transform(F.split(text, ENDS), normalised), lambda s: (s != "") & ~s.rlike(ITEM_ALONE))
    ids = F.array_join(F.transform(words, identifier), "  ")
    return F.regexp_replace(F.concat(F.lit(" "), ids, F.lit(" ")), r"( _ )+", " _ ")


def licence_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, licenses, sentences) for the rows of ``docs`` with a known sentence.

    ``licenses``: names that the rules found, sorted, joined by " AND "; ``LicenseRef-unknown`` where known sentences
    match no rule. ``sentences``: the identifiers in order. Null, empty and other texts have no row; rows that repeat
    are scanned each. No shuffle; other columns, whatever their names, are not looked at.
    """
    # out of an array of one: a filter on an expression would compute it twice, and a plain explode adds such a filter
    known = F.filter(F.array(sentence_ids(F.col("text"))), lambda ids: ids.rlike("[A-Za-z]"))
    scanned = (
        docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
        .filter(F.col("text").rlike(TRIGGER))
        .select("doc_id", F.explode_outer(known).alias("sentences"))
        .filter("sentences IS NOT NULL")
    )
    rules = F.array(*[F.struct(F.lit(" " + sequence.replace(" ", "  ") + " ").alias("part"), F.lit(name).alias("name")) for sequence, name in RULES])
    start = F.struct(F.col("sentences").alias("left"), F.array().cast("array<string>").alias("found"))

    def matched(state: Column, rule: Column) -> Column:
        found = F.when(F.contains(state["left"], rule["part"]), F.array_append(state["found"], rule["name"])).otherwise(state["found"])
        return F.struct(F.replace(state["left"], rule["part"], F.lit(" _ ")).alias("left"), found.alias("found"))

    def named(state: Column) -> Column:
        names = F.array_join(F.array_sort(F.array_distinct(state["found"])), " AND ")
        return F.when(F.size(state["found"]) > 0, names).otherwise("LicenseRef-unknown")

    licenses = F.aggregate(rules, start, matched, named)
    return scanned.select("doc_id", licenses.alias("licenses"), F.trim(F.regexp_replace("sentences", " +", " ")).alias("sentences"))


def duckdb_sql(table: str = "documents") -> str:
    """The same scan in DuckDB SQL."""

    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    text = "text"
    for pattern, by in WRAPS:
        text = f"regexp_replace({text}, {quoted(pattern)}, {quoted(by.replace('$', chr(92)))}, 'g')"
    known = ", ".join(f"({quoted(s)}, {quoted(i)})" for s, i in SENTENCES.items())
    starts = " ".join(f"WHEN starts_with(s, {quoted(b)}) THEN {quoted(i)}" for b, i in BEGINNINGS.items())
    steps, at = [], "matched0"
    for k, (sequence, name) in enumerate(RULES, 1):
        part = quoted(" " + sequence.replace(" ", "  ") + " ")
        steps.append(
            f"matched{k} AS (SELECT doc_id, ids, replace(rest, {part}, ' _ ') AS rest, "
            f"CASE WHEN contains(rest, {part}) THEN list_append(found, {quoted(name)}) ELSE found END AS found FROM {at})"
        )
        at = f"matched{k}"
    return f"""
    WITH cut AS (SELECT doc_id, string_split_regex({text}, {quoted(ENDS)}) AS parts FROM {table}
                 WHERE regexp_matches(text, {quoted(TRIGGER)})),
    placed AS (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS i FROM cut),
    words AS (SELECT doc_id, i, trim(regexp_replace(lower(regexp_replace(part, {quoted(ITEM)}, '')), {quoted(NOT_WORDS)}, ' ', 'g'), ' .') AS s FROM placed),
    known(sentence, id) AS (VALUES {known}),
    named AS (SELECT doc_id, i, coalesce(id, CASE {starts} END, '_') AS id FROM words LEFT JOIN known ON s = sentence
              WHERE s <> '' AND NOT regexp_matches(s, {quoted(ITEM_ALONE)})),
    joined AS (SELECT doc_id, regexp_replace(' ' || string_agg(id, '  ' ORDER BY i) || ' ', '( _ )+', ' _ ', 'g') AS ids
               FROM named GROUP BY doc_id),
    matched0 AS (SELECT doc_id, ids, ids AS rest, CAST([] AS VARCHAR[]) AS found FROM joined WHERE regexp_matches(ids, '[A-Za-z]')),
    {", ".join(steps)}
    SELECT doc_id, CASE WHEN len(found) > 0 THEN array_to_string(list_sort(list_distinct(found)), ' AND ')
                        ELSE 'LicenseRef-unknown' END AS licenses,
           trim(regexp_replace(ids, ' +', ' ', 'g')) AS sentences
    FROM {at}
    """
