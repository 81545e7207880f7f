"""License scans: canonical digests of entire texts looked up among those of known licences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from corpusloom.llm.common import full_text, guarded, staged

#: Known licences are copied to the executors only up to this many; a longer list is joined by shuffle.
COPIED = 50_000

#: Spellings that count as the same, after lower-casing; patterns of both Java and RE2.
SPELLINGS = [("licence", "license"), ("licencing", "licensing"), ("favour", "favor"), ("copyright owner", "copyright holder"), ("https://", "http://"), ("per cent", "percent"), ("&", " and ")]
COPYRIGHT_LINE = "(?m)^[\\t #*/;-]*(copyright|\\(c\\)|©)[^\\n]*$"
PUNCTUATION = "[^\\p{L}\\p{N}]+"

_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished
to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE
FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION
WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:

"""
_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL
THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)
HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD_ITEMS = (
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
)
_ZLIB = """This software is provided "as-is", without any express or implied warranty. In no event will the authors be held liable for any
damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this
software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the
software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and
successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this
software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES
OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR
THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_UNLICENSE_LINK = "For more information, please refer to <https://unlicense.org>"
_ISC, _0BSD = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
)


def _bsd(items: tuple[str, ...]) -> list[str]:
    """The text with its conditions numbered, and with marks that are no letters."""
    return [_BSD_HEAD + "\n".join(f"{mark(i)} {item}" for i, item in enumerate(items, 1)) + "\n" + _BSD_TAIL for mark in ("{}.".format, lambda i: "*")]


#: Entire licences as they are published, with the title line that comes first in many copies, or without.
TEXTS = [
    *[("MIT", title + _MIT) for title in ("", "MIT License\n\n", "The MIT License (MIT)\n\n", "The MIT License\n\n")],
    *[("BSD-2-Clause", title + t) for title in ("", "BSD 2-Clause License\n\n") for t in _bsd(_BSD_ITEMS[:2])],
    *[("BSD-3-Clause", title + t) for title in ("", "BSD 3-Clause License\n\n") for t in _bsd(_BSD_ITEMS)],
    *[("ISC", title + _ISC + "\n\n" + _AS_IS) for title in ("", "ISC License\n\n", "The ISC License\n\n")],
    *[("0BSD", title + _0BSD + "\n\n" + _AS_IS) for title in ("", "BSD Zero Clause License\n\n", "Zero-Clause BSD\n\n")],
    *[("Zlib", title + _ZLIB) for title in ("", "zlib License\n\n")],
    *[("Unlicense", _UNLICENSE + end) for end in ("", "\n\n" + _UNLICENSE_LINK, "\n\n" + _UNLICENSE_LINK.replace(">", "/>").replace("https", "http"))],
]

#: Notices, which stand on a line of their own; no text has an apostrophe, which the SQL would not take.
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("ISC", _ISC),
    ("0BSD", _0BSD),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.
You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("GPL-3.0-or-later", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""),
]

KNOWN = [*NOTICES, *TEXTS]

OUTPUTS = ["canonical_sha256", "whole_license", "license_lines", "n_license_lines"]


def canonical(text: Column) -> Column:
    """Lower case, no copyright lines, one spelling, and single blanks instead of everything but letters and digits."""
    plain = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "")
    for one, other in SPELLINGS:
        plain = F.replace(plain, F.lit(one), F.lit(other))
    return F.trim(F.regexp_replace(plain, PUNCTUATION, " "))


def license_hits(documents: DataFrame, known: DataFrame, text: str = "text", copied: int = COPIED) -> DataFrame:
    """All rows and columns of `documents` with canonical_sha256, whole_license, license_lines and n_license_lines.

    The entire text, and each entire line of it (notices stand on a line of their own), is looked up by the SHA-256 of its
    canonical form in `known` (license_id, text). Only forms as long as a known one need their digest joined. Of several
    licences with one digest the first id counts; known rows without an id or letters fit nothing. Null texts are empty;
    empty texts fit nothing; repeated rows and copies get the same result.
    """
    return guarded(documents, OUTPUTS, lambda rows, name: _license_hits(rows, known, name(text), copied))


def _license_hits(documents: DataFrame, known: DataFrame, text: str, copied: int) -> DataFrame:
    form = canonical(full_text("text"))
    forms = known.filter("license_id is not null").select("license_id", form.alias("form")).filter("form != ''")
    digests = forms.groupBy(F.sha2("form", 256).alias("digest")).agg(F.min("license_id").alias("license_id"), F.min(F.length("form")).alias("size")).persist()
    # Lengths of known forms, at most as many as there are licences.
    facts = digests.agg(F.count("*").alias("n"), F.sort_array(F.collect_set("size")).alias("sizes")).first()
    side = F.broadcast(digests) if facts["n"] <= copied else digests
    source = documents.select(*documents.columns, canonical(full_text(text)).alias("_form"), F.sha2(full_text(text), 256).alias("_key"))
    lengths = F.array(*[F.lit(n) for n in facts["sizes"]]).cast("array<int>")
    lines = F.filter(F.transform(F.split(full_text(text), "\n"), canonical), lambda f: F.array_contains(lengths, F.length(f)))
    found = (
        documents.select(F.sha2(full_text(text), 256).alias("_key"), F.explode(lines).alias("f"))
        .groupBy("_key", F.sha2("f", 256).alias("digest")).agg(F.count("*").alias("n"))
    )
    # A copy of a text counts its lines again; the number of copies divides them out.
    copies = documents.select(F.sha2(full_text(text), 256).alias("_key")).groupBy("_key").agg(F.count("*").alias("copies"))
    per_text = found.join(side.select("digest", "license_id"), "digest").groupBy("_key").agg(F.sum("n").alias("n"), F.sort_array(F.collect_set("license_id")).alias("ids"))
    per_text = staged(per_text.join(copies, "_key").select(F.col("_key").alias("_text_key"), (F.col("n") / F.col("copies")).cast("bigint").alias("n"), "ids"))
    digest = F.sha2("_form", 256)
    whole = side.select(F.col("digest").alias("_digest"), F.col("license_id").alias("whole_license"))
    return (
        source.withColumn("canonical_sha256", digest).drop("_form").join(whole, F.col("canonical_sha256") == F.col("_digest"), "left")
        .join(per_text, F.col("_key") == F.col("_text_key"), "left")
        .select(*documents.columns, "canonical_sha256", "whole_license", F.coalesce("ids", F.array().cast("array<string>")).alias("license_lines"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n_license_lines"))
    )
