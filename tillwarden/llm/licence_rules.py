"""Licence recognition by sentence rules.

1. Sentences.  A text is read twice: as running prose, cut at end marks and blank lines, with line ends,
   comment signs and indents as blanks; and line by line, for notices that stand alone.
2. Normalisation: lower case, one blank between words, no other marks; numbers become {v}, of which the
   first is kept as the sentence's version.
3. Identifiers: a normalised sentence is looked up in a table of known sentences.
4. Rules: the identifiers of a text, in order, are matched against rules, longest first.  A rule's
   identifiers must follow one another; matched ones are used up.  Identifiers that no rule
   takes are counted.

All is column expressions over the row: no shuffle, no explode.  Only texts that hold a word which every
known sentence holds one of are cut up; the table states those words.

Cases: a null or empty text has no identifiers; repeated sentences give repeated identifiers and each
licence once; a text of any length is read whole; every row is returned, repeated ones too; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Known sentences, normalised, with their identifiers.  {v} stands for a number.
SENTENCES = {
    "released under the mit license": "mit-notice",
    "licensed under the mit license": "mit-notice",
    "this project is licensed under the mit license": "mit-notice",
    "mit license": "mit-title",
    "the mit license": "mit-title",
    "the mit license mit": "mit-title",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation "
    "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
    "permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions "
    "of the software": "mit-condition",
    "the software is provided as is without warranty of any kind express or implied including but not limited to "
    "the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-warranty",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether "
    "in an action of contract tort or otherwise arising from out of or in connection with the software or the use "
    "or other dealings in the software": "mit-liability",
    "licensed under the apache license version {v}": "apache-notice",
    "licensed under the apache license version {v} the license": "apache-notice",
    "licensed under the apache license version {v} the license you may not use this file except in compliance "
    "with the license": "apache-notice",
    "you may not use this file except in compliance with the license": "apache-use",
    "you may obtain a copy of the license at": "apache-copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is "
    "distributed on an as is basis without warranties or conditions of any kind either express or implied":
    "apache-warranty",
    "see the license for the specific language governing permissions and limitations under the license":
    "apache-limits",
    "apache license": "apache-title",
    "apache license version {v}": "apache-notice",
    "this work is licensed under the gnu general public license version {v}": "gpl-only",
    "licensed under the gnu general public license version {v}": "gpl-only",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
    "public license as published by the free software foundation either version {v} of the license or at your "
    "option any later version": "gpl-later",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
    "general public license as published by the free software foundation either version {v} of the license or at "
    "your option any later version": "lgpl-later",
    "this program is distributed in the hope that it will be useful but without any warranty without even the "
    "implied warranty of merchantability or fitness for a particular purpose": "gpl-warranty",
    "see the gnu general public license for more details": "gpl-details",
    "licensed under cc by nc {v}": "cc-by-nc",
    "licensed under cc by {v}": "cc-by",
    "licensed under cc by sa {v}": "cc-by-sa",
    "this work is licensed under a creative commons attribution {v} international license": "cc-by",
    "this work is licensed under a creative commons attribution noncommercial {v} international license": "cc-by-nc",
    "this work is licensed under a creative commons attribution sharealike {v} international license": "cc-by-sa",
    "redistribution and use in source and binary forms with or without modification are permitted provided that "
    "the following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the "
    "following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
    "following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission": "bsd-names",
    "this source code form is subject to the terms of the mozilla public license v {v}": "mpl-notice",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
    "granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "this is free and unencumbered software released into the public domain": "unlicense-grant",
}

# A licence's name and the identifiers that make it up, longest first; {v} is the version of the first.
RULES = [
    ("MIT", ["mit-title", "mit-grant", "mit-condition", "mit-warranty", "mit-liability"]),
    ("MIT", ["mit-grant", "mit-condition", "mit-warranty", "mit-liability"]),
    ("Apache-{v}", ["apache-notice", "apache-use", "apache-copy", "apache-warranty", "apache-limits"]),
    ("Apache-{v}", ["apache-notice", "apache-copy", "apache-warranty", "apache-limits"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("GPL-{v}-or-later", ["gpl-later", "gpl-warranty", "gpl-details"]),
    ("GPL-{v}-or-later", ["gpl-later"]),
    ("LGPL-{v}-or-later", ["lgpl-later"]),
    ("GPL-{v}-only", ["gpl-only"]),
    ("Apache-{v}", ["apache-notice"]),
    ("Apache", ["apache-title"]),
    ("MIT", ["mit-notice"]),
    ("MIT", ["mit-title"]),
    ("CC-BY-NC-{v}", ["cc-by-nc"]),
    ("CC-BY-SA-{v}", ["cc-by-sa"]),
    ("CC-BY-{v}", ["cc-by"]),
    ("MPL-{v}", ["mpl-notice"]),
    ("ISC", ["isc-grant"]),
    ("Unlicense", ["unlicense-grant"]),
]

# Every known sentence holds one of these.
CUES = ("licen[cs]e", "permission", "warrant", "copyright", "redistribut", "public domain", "liab")
NUMBER = r"[0-9]+(?:\.[0-9]+)*"


def _sentences(text: Column) -> Column:
    """Running prose cut at end marks, then single lines; each in the order of the text."""
    plain = F.regexp_replace(text, r"(?m)^[ \t]*(?:/\*+|\*+/?|//+|#+|--+|;+)[ \t]*", "")
    lines = F.split(plain, "\n")
    prose = F.regexp_replace(plain, r"\n[ \t]*\n", ". ")
    prose = F.regexp_replace(prose, r"\n[ \t]*", " ")
    # a full stop inside a number is none: the mark must be followed by white space
    prose = F.split(F.regexp_replace(prose, r"([.!?;:])+\s+", "\n"), "\n")
    return F.struct(prose.alias("prose"), lines.alias("lines"))


def _identified(sentences: Column) -> Column:
    """Identifiers with versions ("gpl-only:3") of the known ones among sentences."""
    known = F.create_map(*(F.lit(x) for pair in SENTENCES.items() for x in pair))

    def normal(sentence: Column) -> Column:
        kept = F.regexp_replace(F.lower(sentence), r"[^a-z0-9.]+", " ")
        return F.regexp_replace(F.trim(kept), r"\.+$|\.(?= )", "")

    def identify(sentence: Column) -> Column:
        plain = normal(sentence)
        name = F.try_element_at(known, F.regexp_replace(plain, NUMBER, "{v}"))
        return F.concat(name, F.lit(":"), F.regexp_extract(plain, NUMBER, 0))

    likely = F.filter(sentences, lambda s: s.rlike("(?i)" + "|".join(CUES)))
    return F.filter(F.transform(likely, identify), lambda x: x.isNotNull())


def _matched(identifiers: Column) -> Column:
    """Licences by the ordered rules, and the identifiers no rule took."""
    rules = F.array(
        *(
            F.struct(
                F.lit(r"\|" + "".join(f"{i}:([^|]*)\\|" if n == 0 else f"{i}:[^|]*\\|" for n, i in enumerate(ids))).alias(
                    "pattern"
                ),
                F.lit(name).alias("name"),
            )
            for name, ids in RULES
        )
    )
    # "|id:v|id:v|"; a match leaves "|", so that neighbours stay neighbours of nothing used up
    text = F.concat(F.lit("|"), F.array_join(identifiers, "|"), F.lit("|"))
    start = F.struct(text.alias("rest"), F.array().cast("array<string>").alias("names"))

    def apply(state: Column, rule: Column) -> Column:
        versions = F.regexp_extract_all(state["rest"], rule["pattern"], F.lit(1))
        named = F.transform(versions, lambda v: F.replace(rule["name"], F.lit("{v}"), v))
        return F.struct(
            F.regexp_replace(state["rest"], rule["pattern"], F.lit("|#|")).alias("rest"),
            F.concat(state["names"], named).alias("names"),
        )

    return F.aggregate(rules, start, apply)


def licences(docs: DataFrame) -> DataFrame:
    """doc_id, sentence_ids, licences and n_unmatched of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    none = F.array().cast("array<string>")
    likely = text.rlike("(?i)" + "|".join(CUES))
    cut = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.when(likely, _sentences(text)).alias("sentences")
    )
    read = cut.select(
        "doc_id",
        _identified(F.col("sentences.prose")).alias("prose"),
        _identified(F.col("sentences.lines")).alias("lines"),
    )
    # lines tell only what prose has not told
    ids = F.concat("prose", F.array_except("lines", "prose"))
    named = read.select("doc_id", F.coalesce(ids, none).alias("sentence_ids"))
    matched = named.select(
        "doc_id", "sentence_ids", F.when(F.size("sentence_ids") > 0, _matched(F.col("sentence_ids"))).alias("found")
    )
    left = F.size(F.regexp_extract_all("found.rest", F.lit("[a-z]:"), F.lit(0)))
    return matched.select(
        "doc_id",
        "sentence_ids",
        F.coalesce(F.array_sort(F.array_distinct("found.names")), none).alias("licences"),
        F.when(F.col("found").isNotNull(), left).otherwise(0).alias("n_unmatched"),
    )
