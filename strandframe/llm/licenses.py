"""License scans: whole texts looked up by the digest of their canonical form.

Canonical form: lower case, copyright notices dropped, equivalent spellings
unified (licence, web addresses, quotation marks, list marks), everything but
letters and digits reduced to single blanks, so that it does not depend on line
breaks. A notice is "copyright" or its sign with a sign, a year or a
placeholder behind; it ends where the paragraph goes on with one of a few phrases
that licenses open with, else with its line. The MD5 digests of the known
licenses' canonical forms are a small fixed table (``KNOWN`` holds short texts,
``DIGESTS`` the digests of long ones); documents are hash-joined to it by their
own digest, entire text against entire text.

A license notice is often one line of a longer text, so each line of a document
is looked up too, as an entire text of its own: ``notices`` lists the licenses
named by such lines. Lines are looked up where they stand, without a shuffle;
only lines that can be known texts (they hold one of a few words, derived from
the table so that every known text holds one) are put in canonical form.

Outputs are named ``__license``, ``__digest`` and ``__notices``; an input column of
such a name is kept with ``_in`` appended. Defined cases: null and empty texts, and
texts whose canonical form is empty, match nothing and have no notices. Repeated
rows and null ids are looked up row by row; an empty table gives an empty one.
Texts are looked up whole, however long. Licenses that the table lacks are null.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandframe.llm._names import col, make_room, prefix

# What makes a copyright notice, and the phrases that licenses open with.
_NOTICE = (
    r"(?:copyright[\s:,]*(?:\(c\)|©|<|\[|\{|[12][0-9]{3}|yyyy)|(?:\(c\)|©)\s*(?:copyright|<|\[|\{|[12][0-9]{3}|yyyy))"
)
_OPENINGS = (
    "permission is hereby granted", "permission is granted", "permission to use", "redistribution and use",
    "this software is provided", "this is free and unencumbered", "this program is free", "this program comes",
    "this library is free", "everyone is permitted",
    "all rights reserved", "licensed under", "released under", "spdx license identifier",
)
_OPENING = "(" + "|".join(p.replace(" ", "[^a-z0-9]+") for p in _OPENINGS) + ")"
# Words of license texts that follow "copyright", and further phrases that end a notice paragraph.
_NO_NOTICE = (
    "and", "act", "disclaimer", "holder", "holders", "infringement", "interest", "interests", "is", "law", "laws", "license", "licenses",
    "licence", "licences", "notice", "notices", "or", "owner", "owners", "protection", "rights", "statement", "statements", "treaty", "under",
)
_BEHIND = (
    "distributed under", "this source code form", "this file is", "this work is", "this project is", "use of this source code",
    "to the extent possible", "the above copyright notice", "licensees", "boost software license", "mit license", "the mit license",
)
_GOES_ON = "|".join(p.replace(" ", "[^a-z0-9P]+") for p in (*_OPENINGS, *_BEHIND) if p != "all rights reserved")
# Fixed values: (pattern, replacement) of the canonical form, applied in this order to lower-case text; {1} is the first group.
# A capital P, which lower-case text lacks, marks both ends of a blank stretch while notice paragraphs are dropped.
STEPS = (
    (r"\r", ""),
    (r"(\n[^a-z0-9]*\n)", "P{1}P"),
    (r"copyright([^a-z0-9]+(?:" + "|".join(_NO_NOTICE) + r")\b)", "copyright-{1}"),
    (r"(?:^|P)[^a-z0-9P]*copyright[ \t:,(©][^P]*?(" + _GOES_ON + r"|P|$)", "P {1}"),
    (r"\n[^a-z0-9\nP]*copyright[ \t:,(©][^\nP]*(P|$)", "{1}"),
    (r"P", ""),
    (_NOTICE + r"(?:[^\n]|\n[^\n]){0,300}?\n?" + _OPENING, " {1}"),
    (_NOTICE + r"[^\n]*", " "),
    (r"all[^a-z0-9]+rights[^a-z0-9]+reserved", " "),
    (r"licence", "license"),
    (r"sub-[^a-z0-9]*license", "sublicense"),
    (r"non-[^a-z0-9]*commercial", "noncommercial"),
    (r"merchantibility", "merchantability"),
    (r"https?://", " "),
    (r"[^a-z0-9]+", " "),
)

# The wording of the BSD licenses. Clauses stand with numbers or other list marks.
_BSD_OPEN = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
"""
_BSD_SOURCE = """Redistributions of source code must retain the above copyright notice, this list of conditions and the
following disclaimer."""
_BSD_BINARY = """Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the
following disclaimer in the documentation and/or other materials provided with the distribution."""
_BSD_NAME = """Neither the name of {} nor the names of its contributors may be used to endorse or promote products derived from
this software without specific prior written permission."""
_BSD_CLOSE = """THIS SOFTWARE IS PROVIDED BY THE {} "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO,
THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE {} BE
LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON
ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY
WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD_PARTIES = (
    ("the copyright holder", "COPYRIGHT HOLDERS AND CONTRIBUTORS", "COPYRIGHT HOLDER OR CONTRIBUTORS"),
    ("the copyright holder", "COPYRIGHT HOLDERS AND CONTRIBUTORS", "COPYRIGHT OWNER OR CONTRIBUTORS"),
    ("the University", "REGENTS AND CONTRIBUTORS", "REGENTS OR CONTRIBUTORS"),
)


def _bsd(*clauses: str) -> tuple[str, ...]:
    """The texts with the given clauses: numbered or not, for the usual parties."""
    out = []
    for name, by, shall in _BSD_PARTIES:
        for marks in (("1. ", "2. ", "3. "), ("* ", "* ", "* ")):
            listed = [m + c.format(name) for m, c in zip(marks, clauses, strict=False)]
            out.append("\n".join([_BSD_OPEN, *listed, "", _BSD_CLOSE.format(by, shall)]))
    return tuple(out)


def _titled(text: str, *titles: str) -> tuple[str, ...]:
    """A text alone and below each of its usual titles, with a notice between."""
    return (text, *(f"{t}\n\nCopyright (c) <year> <copyright holders>\n\n{text}" for t in titles))


# The wording of short licenses and notices.
KNOWN = {
    "MIT": (
        *_titled(
            """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
            "MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "Expat License",
        ),
        "Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT",
    ),
    "ISC": (
        *_titled(
            """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
            "ISC License", "The ISC License",
        ),
        "Licensed under the ISC License.", "SPDX-License-Identifier: ISC",
    ),
    "Apache-2.0": (
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an
"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.""",
        "Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License v3.0.", "SPDX-License-Identifier: GPL-3.0",
        "SPDX-License-Identifier: GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-NC-4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "Zlib": (
        *_titled(
            """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If
you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
            "zlib License", "The zlib License",
        ),
        "Licensed under the zlib License.", "SPDX-License-Identifier: Zlib",
    ),
    "0BSD": (
        *_titled(
            """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF
THIS SOFTWARE.""",
            "BSD Zero Clause License", "Zero-Clause BSD",
        ),
        "SPDX-License-Identifier: 0BSD",
    ),
    "MIT-0": (
        *_titled(
            """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
            "MIT No Attribution",
        ),
        "SPDX-License-Identifier: MIT-0",
    ),
    "BSD-2-Clause": (
        *(t for text in _bsd(_BSD_SOURCE, _BSD_BINARY) for t in _titled(text, "BSD 2-Clause License", "The BSD 2-Clause License")),
        "Licensed under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-2-Clause",
    ),
    "BSD-3-Clause": (
        *(t for text in _bsd(_BSD_SOURCE, _BSD_BINARY, _BSD_NAME) for t in _titled(text, "BSD 3-Clause License", "The BSD 3-Clause License")),
        "Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "Unlicense": (
        """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright
interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the
detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of
all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT
OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>""",
        "SPDX-License-Identifier: Unlicense",
    ),
    "BSL-1.0": (
        """Boost Software License - Version 1.0 - August 17th, 2003

Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and
accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and
transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software
is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and
the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works
of the Software, unless such copies or derivative works are solely in the form of machine-executable object code
generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE
COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT,
TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.""",
        "Distributed under the Boost Software License, Version 1.0.", "SPDX-License-Identifier: BSL-1.0",
    ),
    "MPL-2.0": (
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
        "Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0",
    ),
    "GPL-2.0": ("SPDX-License-Identifier: GPL-2.0", "SPDX-License-Identifier: GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-or-later"),
    "LGPL-2.1": ("SPDX-License-Identifier: LGPL-2.1", "SPDX-License-Identifier: LGPL-2.1-only", "SPDX-License-Identifier: LGPL-2.1-or-later"),
    "LGPL-3.0": ("SPDX-License-Identifier: LGPL-3.0", "SPDX-License-Identifier: LGPL-3.0-only", "SPDX-License-Identifier: LGPL-3.0-or-later"),
    "CC0-1.0": ("SPDX-License-Identifier: CC0-1.0",),
    "EPL-2.0": ("SPDX-License-Identifier: EPL-2.0",),
    "CC-BY-4.0": ("SPDX-License-Identifier: CC-BY-4.0", "Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0."),
    "CC-BY-SA-4.0": ("SPDX-License-Identifier: CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0.", "This work is licensed under CC BY-SA 4.0."),
    "BSD-4-Clause": ("SPDX-License-Identifier: BSD-4-Clause",),
    "Python-2.0": ("SPDX-License-Identifier: Python-2.0", "SPDX-License-Identifier: PSF-2.0"),
}

# MD5 of the canonical forms of long licenses, entire and up to the end of their terms. All hold the word license.
DIGESTS = {
    "Apache-2.0": ("df39b8d4fc3e54e48d722d79c1398b9a", "ce36663597a6b79e9551f08427dfcae0", "d1d3cdf041c0b67a6181241542e4537a"),
    "GPL-1.0": ("e5fd842fec56252356c4b59ff4c25396", "dbf3c47f5a8f127e58d08cabc1ebb916", "21fa8693acc5194a648fe02e11f65a72", "fc612179e94c9cb3923841860cfa9a4e", "afac96b8c62558cadd07811086828eb9", "ed18f57e6f8be34d9ff1e08bcf9104cb", "3aecf3f85b2a7e1cf719c688a1c214fa"),
    "GPL-2.0": ("cb1eb18b44b31180cc7a0abc196d0eb5", "08fc7904273686408e9b590734de5b14", "1e83b1b574a812bb7576a0263f6c43f4", "67c1be874bd60f18ad25eef20e31722c"),
    "GPL-3.0": ("a76fdf9cb02340d2ac76e603fe1941d9", "444f95dc767ede978b60cfb20fbd0bca", "17e434cc6db7003444b088cb4cc81e91"),
    "LGPL-2.0": ("0a25d2aecfda735541d43229ff8080bd", "2ea042204e231b3b068b34aabcb576c6", "d752037074cd8d64e1f84d039d32252e"),
    "LGPL-2.1": ("289ba0a8647a7ad2647bd232a2712184", "779e2ace56e0d116674a950a1728889b", "3d336ae8378f651a02209b0a2d01c86d"),
    "LGPL-3.0": ("b31b7335bc37919e8cdd79154e04d88d",),
    "MPL-1.1": ("3664f42c13876fdcbbc7d02531c13483",),
    "MPL-2.0": ("5e59b00d82a24f1bc086685d079e4b4b",),
    "CC0-1.0": ("93a180096f6cfcf2c0dd24f75c2eec48",),
    "Artistic-1.0-Perl": ("a8b0fb0c6e43a3b36bdc159e59dbfd1e",),
    "GFDL-1.2": ("fbd57360f6c7409e032aff7be36a1db5",),
    "GFDL-1.3": ("30faa36a542ecab1d25007dad318f6d8",),
}


def canonical_text(text: str) -> str:
    text = text.lower()
    for pattern, new in STEPS:
        text = re.sub(pattern, new.replace("{1}", r"\1"), text, flags=re.ASCII)
    return text.strip(" ")


def canonical(text: Column) -> Column:
    out = F.lower(text)
    for pattern, new in STEPS:
        out = F.regexp_replace(out, pattern, new.replace("{1}", "$1"))
    return F.trim(out)


def digest_of(text: str) -> str:
    return hashlib.md5(canonical_text(text).encode()).hexdigest()


#: (number of steps, what a text must hold, one of it, for these steps to change it), up to the last step.
_HELD = (
    (1, ("\r",)), (5, ("copyright",)), (2, ("copyright", "(c)", "©")), (1, ("rights",)), (1, ("licence",)), (1, ("sub-",)), (1, ("non-",)),
    (1, ("merchantibility",)), (1, ("http",)),
)


def with_canonical(docs: DataFrame, text: Column, name: str) -> DataFrame:
    """docs with the canonical form; steps that cannot change a text are not tried on it."""
    out, at = docs.withColumn(name, F.lower(text)), 0
    for steps, held in _HELD:
        some = reduce(Column.__or__, (F.contains(F.col(name), F.lit(h)) for h in held))
        changed = F.col(name)
        for pattern, new in STEPS[at : at + steps]:
            changed = F.regexp_replace(changed, pattern, new.replace("{1}", "$1"))
        out, at = out.withColumn(name, F.when(some, changed).otherwise(F.col(name))), at + steps
    return out.withColumn(name, F.trim(F.regexp_replace(name, *STEPS[-1])))


def known_digests(known: dict = KNOWN, digests: dict = DIGESTS) -> list[tuple[str, str]]:
    rows = {digest_of(t): name for name, texts in known.items() for t in texts}
    rows.update({d: name for name, some in digests.items() for d in some})
    return sorted(rows.items())


def hints(known: dict = KNOWN) -> list[str]:
    """Few strings of which every known text holds one, in any of its spellings."""
    # Respelt words are cut to what all their spellings share; all others stand in a raw text as they are.
    stems = {"license": "licen", "sublicense": "licen", "noncommercial": "commercial", "merchantability": "merchant"}

    def stem(word: str) -> str:
        return next((new for old, new in stems.items() if old in word), word)

    left, out = [{stem(w) for w in canonical_text(t).split()} for texts in known.values() for t in texts], []
    left = [words for words in left if words]
    while left:
        count = Counter(w for words in left for w in words)
        out.append(max(count, key=lambda w: (count[w], len(w), w)))
        left = [words for words in left if out[-1] not in words]
    return out


def scan(docs: DataFrame, text_col: str = "text", known: dict = KNOWN, digests: dict = DIGESTS) -> DataFrame:
    """docs with __license (of the entire text), __digest (canonical) and __notices (licenses of lines).

    digests: those of further texts, by license, all of which hold the word license.
    """
    docs = make_room(docs, ["__license", "__digest", "__notices"], [text_col])
    p = prefix(docs)
    rows = known_digests(known, digests)
    some = sorted({*hints(known), *(["licen"] if digests else [])})
    table = F.broadcast(docs.sparkSession.createDataFrame(rows, f"{p}known string, __license string"))
    named = F.create_map(*(F.lit(x) for r in rows for x in r))
    out = with_canonical(docs, col(text_col).cast("string"), f"{p}bare")
    out = out.withColumn("__digest", F.when(F.length(f"{p}bare") > 0, F.md5(F.col(f"{p}bare").cast("binary")))).drop(f"{p}bare")
    lines = F.filter(F.split(col(text_col), "\n"), lambda x: reduce(Column.__or__, (F.lower(x).contains(h) for h in some), F.lit(False)))
    lines = F.transform(lines, lambda x: F.element_at(named, F.md5(canonical(x).cast("binary"))))
    out = out.withColumn("__notices", F.array_sort(F.array_distinct(F.filter(F.coalesce(lines, F.array().cast("array<string>")), lambda x: x.isNotNull()))))
    return out.join(table, F.col("__digest") == F.col(f"{p}known"), "left").drop(f"{p}known")


def oracle() -> str:
    """The scan in DuckDB SQL, which canonicalises the known texts itself and looks up every line."""

    def nest(x: str) -> str:
        out = f"lower({x})"
        for pattern, new in STEPS:
            new = new.replace("{1}", chr(92) + "1")
            out = f"regexp_replace({out}, '{pattern}', '{new}', 'g')"
        return f"trim({out}, ' ')"

    quoted = lambda t: t.replace("'", "''")
    texts = ", ".join(f"('{quoted(t)}', '{name}')" for name, some in KNOWN.items() for t in some)
    long = ", ".join(f"('{d}', '{name}')" for name, some in DIGESTS.items() for d in some)
    return f"""
WITH known(digest, name) AS (SELECT DISTINCT md5({nest('t')}), name FROM (VALUES {texts}) k(t, name) UNION VALUES {long}),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
notices AS (SELECT doc_id, string_agg(DISTINCT name, ',' ORDER BY name) AS notices
            FROM lines JOIN known ON md5({nest('line')}) = digest GROUP BY doc_id),
whole AS (SELECT doc_id, {nest('text')} AS bare FROM documents)
SELECT w.doc_id, CASE WHEN bare <> '' THEN md5(bare) END AS digest, known.name AS license, coalesce(notices, '') AS notices
FROM whole w LEFT JOIN known ON md5(bare) = digest AND bare <> '' LEFT JOIN notices n ON n.doc_id = w.doc_id
"""
