"""License scans by canonical digests.

A text is brought to a canonical form: lower case, without copyright lines
and "all rights reserved", equivalent spellings made one, every run of other
characters than letters and digits one space. The SHA-256 of the canonical
form of an entire text is joined to the digests of known licence texts; the
same is done for entire paragraphs (between blank lines) and entire lines, so
that a licence notice inside a document is found too. A part of a licence is
no match: what is looked up is always a whole unit. Known are the texts in
``license_texts`` with their usual titles and short forms, MIT, ISC and some
one-line notices.

Only DataFrame functions, row by row. The known digests are a fixed table
(``KNOWN``, or one of at most ``MOST_KNOWN`` texts that the caller gives), so
its broadcast is bounded.

Defined results: a null or empty text has no licence; repeated rows are
scanned each; the columns ``license_id``, ``notices`` and ``n_notices`` are
new or replace columns of those names, further ones stay; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from importlib import resources

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import unused



MOST_KNOWN = 10_000

#: A line that states a copyright.
COPYRIGHT_LINE = r"(^|\n)[ \t*#/;-]*(?:copyright[ \t]*(?:\(c\)|©|[0-9]{4}|<)|\(c\)[ \t]*[0-9]{4}|©)[^\n]*"
#: A line that names a holder after the word alone; read before letters are
#: made small, so that a wrapped "copyright holder" or "COPYRIGHT OWNER" is none.
NAMED_LINE = r"(^|\n)[ \t*#/;-]*Copyright:?[ \t]+(?:by[ \t]+)?(?!(?:Holder|Owner|Licen[cs]e|Notice|Law|Act|Statement)s?\b)[A-Z][^\n]*"
#: Runs that become one space.
BETWEEN = r"[^0-9a-z\x{80}-\x{10FFFF}]+"
# Equivalent spellings, after punctuation is gone.
SPELLINGS = (
    ("all rights reserved", ""),
    ("licence", "license"),
    ("licences", "licenses"),
    ("licenced", "licensed"),
    ("sub license", "sublicense"),
    ("non infringement", "noninfringement"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("v2 0", "version 2 0"),
)

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""

_TITLES = {
    "Apache-2.0": ("Apache License 2.0",),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "BSD 2-Clause \"Simplified\" License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "BSD 3-Clause \"New\" or \"Revised\" License", "New BSD License", "BSD License", "The BSD License"),
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "MIT"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "ISC"),
    "Unlicense": ("The Unlicense", "Unlicense"),
}


def _read(name: str) -> str:
    return resources.files(__package__).joinpath("license_texts", f"{name}.txt").read_text(encoding="utf-8")


def _bsd() -> list[tuple[str, str]]:
    """The BSD licences with three and two clauses, numbered or with other marks."""
    three = _read("BSD-3-Clause")
    start, end = three.index("3. Neither"), three.index("THIS SOFTWARE IS PROVIDED")
    out = []
    for name, text in (("BSD-3-Clause", three), ("BSD-2-Clause", three[:start] + three[end:])):
        for holders in (text, text.replace("copyright holder nor", "copyright holders nor")):
            of_all = re.sub(r"COPYRIGHT\s+HOLDER\s+OR", "COPYRIGHT OWNER OR", holders)
            for form in (holders, of_all):
                marks = re.sub(r"(?m)^[123]\.", "*", form)
                letters = re.sub(r"(?m)^([123])\.", lambda m: "abc"[int(m[1]) - 1] + ".", form)
                out += [(name, form), (name, marks), (name, letters)]
    return out


def _complete() -> list[tuple[str, str]]:
    """Complete licence texts, without and with a title."""
    plain = [("MIT", _MIT), ("ISC", _ISC), ("ISC", _ISC.replace("and/or distribute", "and distribute")), *_bsd()]
    for name in ("Apache-2.0", "GPL-2.0-only", "GPL-3.0-only", "LGPL-2.1-only", "LGPL-3.0-only", "MPL-2.0", "CC0-1.0", "Unlicense"):
        text = _read(name)
        plain.append((name, text))
        # without what follows the terms, with and without the line that ends them
        for end in re.finditer("END OF TERMS AND CONDITIONS", text):
            plain += [(name, text[: end.end()]), (name, text[: end.start()])]
    unlicense = _read("Unlicense")
    plain += [("Unlicense", unlicense.replace("https://unlicense.org", u)) for u in ("http://unlicense.org", "http://unlicense.org/", "https://unlicense.org/")]
    return plain + [(name, f"{title}\n\n{text}") for name, text in plain for title in _TITLES.get(name, ())]


# Licence texts and notices by identifier.
KNOWN = (
    ("MIT", "MIT License\n\n" + _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("Apache-2.0", _APACHE_NOTICE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has dedicated all copyright to this work to the public domain under the CC0 1.0 license."),
    *_complete(),
)

#: Every known text has one of these words, in any spelling; others are skipped.
ANCHOR = r"(?i)licen[cs]|permission|redistribution"


def canonical(text: Column) -> Column:
    c = F.regexp_replace(text, NAMED_LINE, "$1")
    c = F.regexp_replace(F.lower(c), COPYRIGHT_LINE, "$1")
    c = F.regexp_replace(c, BETWEEN, " ")
    for odd, usual in SPELLINGS:
        c = F.regexp_replace(c, rf"\b{odd}\b", usual)
    return F.trim(F.regexp_replace(c, " +", " "))


def canonical_text(text: str) -> str:
    """``canonical`` of one Python string (for the table of known texts)."""
    c = re.sub(COPYRIGHT_LINE, r"\1", re.sub(NAMED_LINE, r"\1", text).lower())
    c = re.sub("[^0-9a-z\x80-\U0010ffff]+", " ", c)
    for odd, usual in SPELLINGS:
        c = re.sub(rf"\b{odd}\b", usual, c)
    return re.sub(" +", " ", c).strip(" ")


def known_digests(texts: tuple[tuple[str, str], ...] = KNOWN) -> dict[str, str]:
    """Digest to identifier; of equal texts the identifier that sorts first."""
    if len(texts) > MOST_KNOWN:
        raise ValueError(f"more than {MOST_KNOWN} known texts")
    found = sorted((hashlib.sha256(canonical_text(t).encode()).hexdigest(), name) for name, t in texts)
    return {d: name for d, name in reversed(found)}


def anchor_of(texts: tuple[tuple[str, str], ...]) -> str | None:
    """A pattern that the lower-case form of every document with one of
    ``texts`` matches: ``ANCHOR``, and for each text without it its longest
    word that no other spelling leads to. None if a text has no such word."""
    made = {w for _, usual in SPELLINGS for w in usual.split()}
    more = set()
    for _, t in texts:
        c = canonical_text(t)
        if not re.search(ANCHOR, c):
            usable = [w for w in c.split(" ") if re.fullmatch("[a-z0-9]+", w) and w not in made]
            if not usable:
                return None
            more.add(max(usable, key=lambda w: (len(w), w)))
    return "|".join([ANCHOR, *sorted(more)])


def scan(docs: DataFrame, texts: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """The rows with ``license_id`` (the licence that the entire text is),
    ``notices`` (sorted identifiers of all whole units that are one) and
    ``n_notices`` (such units)."""
    known = known_digests(texts)
    spark = docs.sparkSession
    table = spark.createDataFrame(sorted(known.items()), "known_digest string, known_id string")
    lengths = sorted({len(canonical_text(t)) for _, t in texts})
    text = F.coalesce("text", F.lit(""))
    anchor = anchor_of(texts)
    has = F.lit(True) if anchor is None else F.lower(text).rlike(anchor)
    digest = lambda c: F.sha2(c, 256)
    units = F.concat(F.split(text, r"\n[ \t\r]*\n", -1), F.split(text, "\n", -1))
    # of the whole units only those as long as a known text are digested
    digests = F.transform(F.filter(F.transform(units, canonical), lambda c: F.length(c).isin(*lengths)), digest)
    none = F.array().cast("array<string>")
    of_whole, of_units = unused("_whole", docs), unused("_units", docs)
    marked = docs.withColumns({
        of_whole: F.when(has, digest(canonical(text))),
        of_units: F.when(has, F.filter(digests, lambda d: d.isin(*known))).otherwise(none),
    })
    joined = marked.join(F.broadcast(table), marked[of_whole] == table["known_digest"], "left")
    names = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    ids = F.transform(marked[of_units], lambda d: names[d])
    whole = table["known_id"]
    all_ids = F.concat(ids, F.when(whole.isNull(), none).otherwise(F.array(whole)))
    new = {
        "license_id": whole,
        "notices": F.array_sort(F.array_distinct(all_ids)),
        "n_notices": F.size(F.array_distinct(marked[of_units])).cast("long"),
    }
    return joined.select(*[marked[c] for c in docs.columns if c not in new], *[c.alias(n) for n, c in new.items()])


def report(docs: DataFrame) -> DataFrame:
    return scan(docs.select("doc_id", "text")).select(
        "doc_id", "license_id", F.array_join("notices", ",").alias("notices"), "n_notices"
    )
