"""Licence scan by canonical digest: texts in one spelling are hash-joined to the digests of known licences.

Canonical form: lower case; copyright lines go; equivalent spellings become one; everything but letters and digits becomes one
space.  A document is looked up as a whole, and so is each of its lines, and each place where a known text begins with a line and
goes on over several: however its lines and blocks are cut, and whatever stands before and after.  The known licences are a small
table given by the caller (their digests, lengths and first words are broadcast).

Null text: as the empty text, which is no licence.  Several licences with one digest: the smallest name.  Repeated rows are looked
up each on its own; an empty table gives an empty result.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: lines that state a copyright, spellings that count as one, and known licence texts
COPYRIGHT_LINE = r"(?m)^[ \t]*(copyright|\(c\)|©|all rights reserved)[^\n]*"
SPELLINGS = (
    ("licence", "license"),
    ("sub-license", "sublicense"),
    ("non-commercial", "noncommercial"),
    ("acknowledgement", "acknowledgment"),
    ("organisation", "organization"),
    ("fulfilment", "fulfillment"),
    ("https://", "http://"),
)
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
KNOWN = (
    ("MIT", _MIT),
    ("MIT", "MIT License\n" + _MIT),
    ("ISC", _ISC),
    ("ISC", "ISC License\n" + _ISC),
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
)


#: Words by which a place where a known text may begin is found.
BEGIN_WORDS = 3
#: What follows the terms of some licences, and need not be there.
_END_OF_TERMS = "END OF TERMS AND CONDITIONS"


def known_texts() -> tuple[tuple[str, str], ...]:
    """KNOWN and the files of ``license_texts`` (name of the licence before ``.header``, ``.bullets`` or ``.txt``), whole and up to
    the end of their terms."""
    found = list(KNOWN)
    for file in sorted((Path(__file__).parent / "license_texts").glob("*.txt")):
        name, text = file.name.removesuffix(".txt").removesuffix(".header").removesuffix(".bullets"), file.read_text(encoding="utf-8")
        found.append((name, text))
        terms, end, _ = text.partition(_END_OF_TERMS)
        if end:
            found += [(name, terms), (name, terms + end)]
    return tuple(found)


def canonical_lines(text: Column) -> Column:
    """The canonical text with its line ends."""
    text = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, "")
    for old, new in SPELLINGS:
        text = F.replace(text, F.lit(old), F.lit(new))
    return F.regexp_replace(text, r"[^\p{L}\p{N}\n]+", " ")


def whole(lines: Column) -> Column:
    return F.trim(F.regexp_replace(lines, r"[ \n]+", " "))


def known_digests(spark: SparkSession, known=KNOWN) -> DataFrame:
    """(_digest, license_id, _size, _begin), one row per digest."""
    table = spark.createDataFrame([(name, text) for name, text in known], "license_id string, text string")
    table = table.select("license_id", whole(canonical_lines(F.col("text"))).alias("text"))
    names = table.groupBy(F.md5(F.col("text").cast("binary")).alias("_digest"))
    return names.agg(F.min("license_id").alias("license_id"), F.max(F.length("text")).alias("_size"), F.max(F.substring_index("text", " ", BEGIN_WORDS)).alias("_begin"))


def scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, line, digest, license_id: one row for each document (line null; license_id null if unknown), one for each line
    (from 1) that is a known licence, and one for each known licence over several lines, at its first line."""
    begins = [r[0] for r in known.select("_begin").distinct().collect()]
    names = F.broadcast(known.select("_digest", "license_id"))
    text = docs.select(F.col(id_col), canonical_lines(F.col(text_col)).alias("_text"))
    documents = text.select(id_col, F.lit(None).cast("int").alias("line"), F.md5(whole(F.col("_text")).cast("binary")).alias("digest"))
    documents = documents.join(names, F.col("digest") == F.col("_digest"), "left")
    lines = text.select(id_col, F.posexplode(F.split("_text", "\n")).alias("_at", "_line")).select(id_col, (F.col("_at") + 1).alias("line"), F.trim("_line").alias("_line"))
    lines = lines.filter(F.col("_line") != "").select(id_col, "line", F.md5(F.col("_line").cast("binary")).alias("digest"))
    lines = lines.join(names, F.col("digest") == F.col("_digest"))
    found = documents.unionByName(lines).select(id_col, "line", "digest", "license_id")
    return found.unionByName(_passages(text, known, begins, id_col)) if begins else found


def _passages(text: DataFrame, known: DataFrame, begins: list[str], id_col: str) -> DataFrame:
    """Known licences that begin with a line and go on over the next ones.  Only texts from such a line on are read again."""
    numbered = F.transform(F.split("_text", "\n"), lambda line, i: F.struct((i + 1).alias("line"), F.trim(line).alias("text")))
    cut = text.select(id_col, F.filter(numbered, lambda x: x["text"] != "").alias("_lines"))
    firsts = {w.split(" ")[0] for w in begins}
    may = F.filter(F.transform("_lines", lambda x, i: F.struct((i + 1).alias("at"), x["line"].alias("line"), x["text"].alias("text"))), lambda x: F.substring_index(x["text"], " ", 1).isin(*firsts))
    at = cut.select(id_col, "_lines", F.explode(may).alias("_m"))
    rest = F.array_join(F.slice("_lines.text", F.col("_m.at"), F.size("_lines")), " ")
    # as many lines have as many words at least
    head = F.array_join(F.slice("_lines.text", F.col("_m.at"), F.lit(BEGIN_WORDS)), " ")
    at = at.filter(F.substring_index(head, " ", BEGIN_WORDS).isin(*begins))
    at = at.select(id_col, "_m.line", F.length("_m.text").alias("_first"), rest.alias("_rest"))
    joined = at.join(F.broadcast(known), F.substring_index("_rest", " ", BEGIN_WORDS) == F.col("_begin"))
    piece = F.col("_rest").substr(F.lit(1), F.col("_size"))
    ends = F.col("_rest").substr(F.col("_size") + 1, F.lit(1)).isin("", " ")
    joined = joined.filter((F.col("_first") < F.col("_size")) & ends & (F.md5(piece.cast("binary")) == F.col("_digest")))
    return joined.select(id_col, "line", F.col("_digest").alias("digest"), "license_id")


def oracle(known=KNOWN) -> str:
    """The same in DuckDB over the table ``documents``."""
    def canonical(column: str) -> str:
        text = f"regexp_replace(lower(coalesce({column}, '')), '{COPYRIGHT_LINE}', '', 'g')"
        for old, new in SPELLINGS:
            text = f"replace({text}, '{old}', '{new}')"
        return f"regexp_replace({text}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"

    def joined(column: str) -> str:
        return f"trim(regexp_replace({column}, '[ \\n]+', ' ', 'g'), ' ')"

    rows = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in known)
    return f"""
with known as (
  select md5({joined(canonical('text'))}) as known_digest, min(license_id) as license_id
  from (values {rows}) t(license_id, text) group by 1
), t as (select doc_id, {canonical('text')} as body from documents),
d as (select doc_id, cast(null as integer) as line, md5({joined('body')}) as digest from t),
s as (select doc_id, string_split(body, chr(10)) as parts from t),
l as (select doc_id, unnest(range(1, len(parts) + 1)) as line, unnest(parts) as part from s),
m as (select doc_id, cast(line as integer) as line, md5(trim(part, ' ')) as digest from l where trim(part, ' ') <> '')
select doc_id, line, digest, license_id from d left join known on digest = known_digest
union all
select doc_id, line, digest, license_id from m join known on digest = known_digest"""
