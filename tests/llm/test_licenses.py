"""Licence notices as they stand in files: the same texts wrapped, commented, numbered and punctuated in other ways."""

import random
import re
import textwrap

import duckdb

from barloom.llm import licenses

# Public notices, paragraph by paragraph, and what they are.
NOTICES = {
    "MIT": [
        "MIT License",
        "Copyright (c) 2020 Some Body",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.',
    ],
    "Apache-2.0": [
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at',
        "http://www.apache.org/licenses/LICENSE-2.0",
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "BSD-2-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "(a) Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "(b) Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt)"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License v2.0 which accompanies this distribution."],
    "GPL-2.0-or-later": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "GPL-3.0-or-later": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "GPL-2.0-only": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation."],
    "LGPL-2.1-or-later": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."],
    "LGPL-3.0-or-later": ["This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "AGPL-3.0-or-later": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "CC-BY-SA-4.0": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "GPL-3.0-only": ["This work is licensed under the GNU General Public License, version 3."],
    "LicenseRef-all-rights-reserved": ["Copyright 2019 Some Body. All rights reserved."],
}

#: Sentences about licences that grant nothing.
TALK = [
    "The MIT License was discussed at length by the board.", "We asked for permission to use the hall on Monday.",
    "Licensed under the stars, released under pressure.", "Her driving license expired in version 3 of the story.",
    "The warranty covers parts; distribution in source and binary forms is another matter.",
    "He is free to copy the recipe.", "This library is free on Sundays.", "A copy of the GNU manual lay on the table.",
    "All rights are reserved to the owner of the land.", "Redistributions of land were made under the law of 1920.",
    "cc: the board", "The Apache License, Version 2.0, is long.",
]


def wrapped(paragraphs, width, mark="", first="", last="", end="\n"):
    lines = [line for p in paragraphs for line in [*textwrap.wrap(p, width, break_long_words=False, break_on_hyphens=False), ""]]
    return end.join(x for x in [first, *(f"{mark}{line}" for line in lines[:-1]), last] if x or mark == "")


def forms(paragraphs):
    yield "lines", "\n\n".join(paragraphs)
    for width in (40, 55, 72, 79):
        yield f"wrapped {width}", wrapped(paragraphs, width)
        yield f"block {width}", wrapped(paragraphs, width, " * ", "/*", " */")
        yield f"hash {width}", wrapped(paragraphs, width, "# ")
        yield f"slashes {width}", wrapped(paragraphs, width, "// ")
        yield f"percent, crlf {width}", wrapped(paragraphs, width, "%% ", end="\r\n")
    yield "wide", wrapped(paragraphs, 72).replace(" ", "  ")
    yield "quotes", "\n\n".join(paragraphs).replace('"', "``").replace("'", "`")
    yield "no commas", "\n\n".join(p.replace(",", "") for p in paragraphs)
    yield "within prose", "The sea was calm that day.\n\n" + wrapped(paragraphs, 65) + "\n\nNobody came. The sea was calm."
    yield "upper case", "\n\n".join(paragraphs).upper()


CASES = [(name, form, text) for name, paragraphs in NOTICES.items() for form, text in forms(paragraphs)]


def test_recall_on_labelled_notices(docs_of):
    found = {r.doc_id: r.licenses for r in licenses.licence_scan(docs_of([text for *_, text in CASES])).collect()}
    missed = [(name, form, found.get(k)) for k, (name, form, _) in enumerate(CASES) if name not in str(found.get(k)).split(" AND ")]
    wrong = [(name, form, found[k]) for k, (name, form, _) in enumerate(CASES) if k in found and set(found[k].split(" AND ")) - {name, "LicenseRef-unknown"}]
    assert 1 - len(missed) / len(CASES) >= 0.97, "\n".join(map(str, missed))
    assert not wrong


def test_tags_name_every_licence(docs_of):
    names = sorted({name for _, name in licenses.RULES if not name.startswith("LicenseRef")})
    texts = [f"// SPDX-License-Identifier: {name}\nint main;" for name in names]
    found = {r.doc_id: r.licenses for r in licenses.licence_scan(docs_of(texts)).collect()}
    assert [found.get(k) for k in range(len(names))] == names and {"LGPL-2.1-only", "AGPL-3.0-or-later", "EPL-2.0"} <= set(names)


def test_talk_about_licences_is_none(docs_of):
    rng = random.Random(3)
    texts = TALK + [" ".join(rng.sample(TALK, 5)) for _ in range(40)] + ["\n".join(rng.sample(TALK, 6)) for _ in range(40)]
    assert [r for r in licenses.licence_scan(docs_of(texts)).collect()] == []


def test_a_known_sentence_has_a_trigger():
    assert [s for s in licenses.SENTENCES if not re.search(licenses.TRIGGER, s)] == []
    assert all(re.sub(licenses.NOT_WORDS, " ", s).strip(" .") == s for s in licenses.SENTENCES)


def test_a_wrapped_trigger_is_seen(docs_of):
    text = "/* Copyright 2019 Some Body. All rights\n * reserved */"
    assert [r.licenses for r in licenses.licence_scan(docs_of([text])).collect()] == ["LicenseRef-all-rights-reserved"]


def test_a_line_that_begins_a_sentence_is_not_joined(docs_of):
    texts = [f"It went on {end}\nLicensed under CC BY-NC 4.0." for end in ("the,", "the", "of,", "and", "under", "free", "nothing", "THE")]
    assert [r.licenses for r in licenses.licence_scan(docs_of(texts)).collect()] == ["CC-BY-NC-4.0"] * len(texts)


def test_sql_agrees_on_the_notices(docs_of):
    texts = [text for *_, text in CASES] + TALK + ["", None, "1.\n2.\n(a) MIT License"]
    docs = docs_of(texts)
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toPandas())
    theirs = sorted(con.execute(licenses.duckdb_sql()).fetchall())
    assert sorted(map(tuple, licenses.licence_scan(docs).collect())) == theirs


def test_two_notices_of_one_text_are_both_found(docs_of):
    names = sorted(NOTICES)
    texts = ["\n\n".join([*NOTICES[name], "Something else stands here.", *NOTICES["ISC"]]) for name in names]
    found = {r.doc_id: r.licenses for r in licenses.licence_scan(docs_of(texts)).collect()}
    assert [set(found[k].split(" AND ")) for k in range(len(names))] == [{name, "ISC"} for name in names]
