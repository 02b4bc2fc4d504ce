"""License scans over a positional rare-token index, natively.

The index holds every word of every licence template with its place.  Document
frequencies of the licence words over the whole corpus give their IDF.  A match
may lack some words; words that no file has are surely lacking, and a template
that lacks too many of them can't be met.  Of the other places a template's
anchors are the rarest, two more than a match may still lack: any text that holds
the template at one shift well enough to be accepted agrees with two anchors.  A file's words are looked up, and
their postings in the template are intersected by relative position: anchors that
agree on the same shift make a candidate.  A candidate's score is the share of
the template's words that stand within `SLIP` places of where the shift puts
them, so that a few inserted or lost words do no harm; it must also hold the
template's mandatory key phrases.

Odd inputs: null and empty texts have no words, no labels and score 0.0;
repeated rows each get the result of a single one; an empty corpus gives no rows.
"""

from __future__ import annotations

import re
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..storage import small_side, stored
from .common import lower_for_ascii
from .decontaminate import _row_key, words_of

_GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
_AS_IS = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_NO_ENDORSEMENT = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_DISCLAIMER = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."


def _gnu(name: str, version: str) -> str:
    """The notice of a GNU licence."""
    return (
        f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. "
        f"This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details. "
        f"You should have received a copy of the GNU {name} along with this program. If not, see"
    )


# Label, wording, mandatory key phrases.
TEMPLATES = [
    ("mit", "Released under the MIT License", ["mit license"]),
    ("mit", f"{_GRANT} The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. {_AS_IS}", ["permission is hereby granted free of charge", "the above copyright notice and this permission notice"]),
    ("mit-0", f"{_GRANT.removesuffix(', subject to the following conditions:')}. {_AS_IS}", ["permission is hereby granted free of charge", "is furnished to do so the software is provided"]),
    ("apache", "Licensed under the Apache License, Version 2.0", ["apache license"]),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.", ["apache license", "except in compliance with the license"]),
    ("gpl", "licensed under the GNU General Public License, version", ["gnu general public license"]),
    ("gpl", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", ["gnu general public license", "free software foundation"]),
    ("gpl-2.0", _gnu("General Public License", "2"), ["gnu general public license", "either version 2 of the license"]),
    ("gpl-3.0", _gnu("General Public License", "3"), ["gnu general public license", "either version 3 of the license"]),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", ["gnu lesser general public license"]),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation", ["gnu affero general public license"]),
    ("lgpl-3.0", _gnu("Lesser General Public License", "3"), ["gnu lesser general public license", "either version 3 of the license"]),
    ("agpl-3.0", _gnu("Affero General Public License", "3"), ["gnu affero general public license", "either version 3 of the license"]),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.", ["mozilla public license"]),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("bsd-2-clause", f"{_BSD} {_DISCLAIMER}", ["redistribution and use in source and binary forms", "with the distribution this software is provided"]),
    ("bsd-3-clause", f"{_BSD} {_NO_ENDORSEMENT} {_DISCLAIMER}", ["redistribution and use in source and binary forms", "may be used to endorse or promote"]),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.", ["with or without fee is hereby granted"]),
    ("0bsd", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE", ["with or without fee is hereby granted the software"]),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:", ["alter it and redistribute it freely"]),
    ("bsl-1.0", "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so", ["accompanying documentation covered by this license"]),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.", ["released into the public domain"]),
    ("unlicense", "This is free and unencumbered software released into the public domain", ["released into the public domain"]),
    ("cc-by", "Licensed under CC BY 4.0", ["cc by 4 0"]),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0", ["cc by sa"]),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ["cc by nc"]),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", ["creative commons attribution 4 0"]),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", ["attribution sharealike"]),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial", ["attribution noncommercial"]),
]
#: Base phrases (their last word is always `license`) and their labels.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
MIN_SCORE = 0.8
#: Places by which a template's word may be off its shift.
SLIP = 2


def bodies(min_score: float = MIN_SCORE) -> list[tuple[int, str, list[str], list[str], int]]:
    """Template number, label, words, key phrases in spaces, and words that a match may lack."""
    out = []
    for i, (label, text, keys) in enumerate(TEMPLATES):
        body = re.findall(r"[a-z0-9]+", text.lower())
        may_lack = int(len(body) * (1 - Fraction(str(min_score))))
        out.append((i, label, body, [f" {k} " for k in keys], may_lack))
    return out


def template_table(spark: SparkSession, min_score: float = MIN_SCORE) -> DataFrame:
    """Templates as a table of fixed size."""
    return spark.createDataFrame(bodies(min_score), "template int, label string, body array<string>, keys array<string>, may_lack int")


def _words(text: Column | str) -> Column:
    return words_of(lower_for_ascii(F.col(text) if isinstance(text, str) else text))


def rare_token_index(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """(term, template, label, body, keys, at) for each template's rarest places."""
    templates = template_table(docs.sparkSession, min_score)
    vocabulary = sorted({w for _, _, body, _, _ in bodies(min_score) for w in body})
    listed = F.array(*[F.lit(w) for w in vocabulary])
    present = docs.select(F.array_intersect(_words("text"), listed).alias("has"))
    frequency = present.select(F.explode("has").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    places = templates.select("*", F.posexplode("body").alias("at", "term")).join(F.broadcast(frequency), "term", "left")
    whole = Window.partitionBy("template")
    rank = F.row_number().over(whole.orderBy(F.col("df").asc_nulls_last(), "term", "at"))  # by falling IDF
    still = F.col("may_lack") - F.count_if(F.col("df").isNull()).over(whole)
    ranked = places.withColumns({"rank": rank, "still": still})
    return ranked.where("df is not null and still >= 0 and rank <= still + 2").select("term", "template", "label", "body", "keys", "at")


def license_matches(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """Verified template matches: doc_id, _text_hash, label, start, score."""
    index = stored(rare_token_index(docs, min_score), "rare-tokens")
    by_term = index.groupBy("term").agg(F.collect_list(F.struct("template", "at")).alias("postings"))
    each = _row_key(docs).select("doc_id", "_text_hash", _words("text").alias("words")).select("doc_id", "_text_hash", F.posexplode("words").alias("pos", "term"))
    met = each.join(F.broadcast(by_term), "term").select("doc_id", "_text_hash", "pos", F.explode("postings").alias("p"))
    shifts = met.groupBy("doc_id", "_text_hash", "p.template", (F.col("pos") - F.col("p.at")).alias("shift")).agg(F.size(F.collect_set("p.at")).alias("n")).where("n >= 2")
    by_doc = shifts.groupBy("doc_id", "_text_hash").agg(F.collect_set(F.struct("template", "shift")).alias("found"))
    by_doc = stored(by_doc.select(F.col("doc_id").alias("_id"), F.col("_text_hash").alias("_hash"), "found"), "candidates")
    same_row = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash"))
    texts = _row_key(docs).join(small_side(by_doc), same_row).dropDuplicates(["doc_id", "_text_hash"])
    at = texts.select("doc_id", "_text_hash", _words("text").alias("words"), F.explode("found").alias("f")).select("doc_id", "_text_hash", "words", "f.*")
    at = at.join(F.broadcast(template_table(docs.sparkSession, min_score)), "template")
    span = F.expr(f"slice(words, greatest(shift - {SLIP}, 0) + 1, greatest(size(body) + {SLIP} + shift - greatest(shift - {SLIP}, 0), 0))")
    near = " or ".join(f"coalesce(get(span, i + cast(least(shift, {SLIP}) as int) + {d}) = body[i], false)" for d in sorted(range(-SLIP, SLIP + 1), key=abs))
    same = F.expr(f"size(filter(sequence(0, size(body) - 1), i -> {near}))")
    verified = at.withColumn("span", span).withColumn("score", same / F.size("body")).withColumn("joined", F.concat(F.lit(" "), F.array_join("span", " "), F.lit(" ")))
    return verified.where(F.expr("forall(keys, k -> contains(joined, k))") & (F.col("score") >= min_score)).select("doc_id", "_text_hash", "label", F.greatest("shift", F.lit(0)).cast("long").alias("start"), "score")


def _phrase_at(words: str, i: str, phrase: str) -> str:
    parts = phrase.split()
    return "(" + " and ".join(f"coalesce(get({words}, {i} + {j}) = '{w}', false)" for j, w in enumerate(parts)) + ")"


def license_scan(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    found = license_matches(docs, min_score).groupBy("doc_id", "_text_hash").agg(F.collect_set("label").alias("more"), F.max("score").alias("score"))
    words = _row_key(docs).select("doc_id", "_text_hash", _words("text").alias("words"))
    at = {label: f"filter(sequence(0, size(words) - 1), i -> {_phrase_at('words', 'i', phrase)})" for phrase, label in PHRASES}
    starts = F.when(F.array_contains("words", "license"), F.struct(*[F.expr(e).alias(k) for k, e in at.items()]))
    base = words.select("doc_id", "_text_hash", F.size("words").cast("long").alias("n_words"), starts.alias("at"))
    every = F.concat(*[F.col(f"at.{label}") for _, label in PHRASES])
    own = F.array_compact(F.array(*[F.when(F.size(f"at.{label}") > 0, F.lit(label)) for _, label in PHRASES]))
    base = base.select("doc_id", "_text_hash", "n_words", F.coalesce(F.when(F.col("at").isNotNull(), F.size(every)), F.lit(0)).cast("long").alias("n_base"), F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"), F.array_sort(own).alias("own"))
    joined = base.alias("b").join(found.alias("f"), F.col("b.doc_id").eqNullSafe(F.col("f.doc_id")) & (F.col("b._text_hash") == F.col("f._text_hash")), "left")
    labels: Column = F.array_sort(F.array_union("b.own", F.coalesce("f.more", F.array().cast("array<string>"))))
    return joined.select("b.doc_id", "b.n_words", "b.n_base", "b.first_word", "b.last_word", F.array_join("b.own", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), F.coalesce("f.score", F.lit(0.0)).alias("score"))
