"""Licence recognition by sentence rules, in DataFrame functions only.

A text is normalised to lower-case words, with a cut at line ends and after
punctuation and a blank. Known licence sentences are found where they begin and
end at a cut, however many lines they are wrapped over and whatever comment marks
the lines have; short notices (``MID``) may begin at any word but a negated one.
Of sentences that begin at one place the longest is meant. The identifiers found,
in text order, are matched against ordered licence rules: a rule holds where its
identifiers occur in its order, other licence sentences between them allowed.
A notice that reserves all rights is one of the licences, LicenseRef-proprietary;
it is named next to others that the text holds.

Nulls: a null or empty text has no sentence and no licence. Repeated rows
give repeated results, an empty table an empty result; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Openings of well-known public licences and notices.
SENTENCES: dict[str, str] = {
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-notice-long": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache-comply": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-asis": 'distributed under the License is distributed on an "AS IS" BASIS,',
    "apache-copy-at": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-copy-at-tls": "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0",
    "apache-copy-unless": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
                          "Unless required by applicable law or agreed to in writing,",
    "apache-copy-unless-tls": "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0 "
                              "Unless required by applicable law or agreed to in writing,",
    "mit-notice": "Released under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy",
    "mit-keep": "The above copyright notice and this permission notice shall be included in all",
    "mit-asis": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR',
    "mit-grant-whole": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                       'associated documentation files (the "Software"),',
    "mit-keep-whole": "The above copyright notice and this permission notice shall be included in all copies or "
                      "substantial portions of the Software.",
    "mit-asis-whole": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,',
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "bsd-source": "Redistributions of source code must retain the above copyright notice",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice",
    "bsd-grant-whole": "Redistribution and use in source and binary forms, with or without modification, are permitted "
                       "provided that the following conditions are met:",
    "bsd-source-whole": "Redistributions of source code must retain the above copyright notice, this list of conditions "
                        "and the following disclaimer.",
    "bsd-binary-whole": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
                        "and the following disclaimer in the documentation and/or other materials provided with the "
                        "distribution.",
    "bsd-endorse": "may be used to endorse or promote products derived from this software without specific prior written "
                   "permission.",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify",
    "gpl-terms": "it under the terms of the GNU General Public License as published by",
    "gpl-head": "free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
                "as published by the Free Software Foundation,",
    "gpl2-either": "either version 2 of the License,",
    "gpl2-version": "version 2 of the License",
    "gpl3-either": "either version 3 of the License,",
    "gpl3-version": "version 3 of the License",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-notice": "Licensed under CC BY-SA 4.0.",
    "reserved-notice": "All rights reserved.",
}
#: Sentences that may begin at any word: what stands before them is a name, or said in many ways.
MID = sorted([sid for sid in SENTENCES if sid.endswith("-notice")] + ["bsd-endorse", "gpl-head"])
_BSD = ["bsd-grant[a-z-]*", "bsd-source[a-z-]*", "bsd-binary[a-z-]*"]
# The sentences of each licence, in order; a sentence and its longer wordings by the start of their names.
RULES: dict[str, list[list[str]]] = {
    "Apache-2.0": [["apache-notice"], ["apache-notice-long", "apache-comply", "apache-copy[a-z-]*"]],
    "BSD-2-Clause": [_BSD],
    "BSD-3-Clause": [[*_BSD, "bsd-endorse"]],
    "CC-BY-4.0": [["cc-by-notice"]],
    "CC-BY-NC-4.0": [["cc-by-nc-notice"]],
    "CC-BY-SA-4.0": [["cc-by-sa-notice"]],
    "GPL-2.0": [["gpl-head", "gpl2-(either|version)"], ["gpl-free", "gpl-terms", "gpl2-(either|version)"]],
    "GPL-3.0": [["gpl3-notice"], ["gpl-head", "gpl3-(either|version)"], ["gpl-free", "gpl-terms", "gpl3-(either|version)"]],
    "LicenseRef-proprietary": [["reserved-notice"]],
    "MIT": [["mit-notice"], ["mit-grant[a-z-]*", "mit-keep[a-z-]*", "mit-asis[a-z-]*"]],
}
#: A licence whose sentences are all among those of another is named only where the other does not hold.
UNLESS = {"BSD-2-Clause": "BSD-3-Clause"}


def normalised(sentence: Column) -> Column:
    """Lower-case letters and digits, one blank between the words."""
    return F.trim(F.regexp_replace(F.lower(sentence), r"[^a-z0-9]+", " "))


def cut_words(text: Column) -> Column:
    """The words of a text, one blank between them, or a line end where the text is cut."""
    cut = F.regexp_replace(text, r"([.!?;:,)\]|]) +| [-\u2013\u2014]+ ", "$1\n")
    words = F.regexp_replace(F.lower(cut), r"[^a-z0-9\n]+", " ")
    return F.concat(F.lit("\n"), F.regexp_replace(words, r" ?\n[ \n]*", "\n"), F.lit("\n"))


def sentence_pattern(named: dict[str, str], mid: list[str] = MID) -> str:
    """Matches any known sentence in cut words, longer ones first."""
    def any_of(some: list[str]) -> str:
        return "|".join(s.replace(" ", "[ \n]") for s in sorted(some, key=lambda s: (-len(s), s)))
    begin = {r"(?<=\n)": [s for s, sid in named.items() if sid not in mid],
             r"(?<=[ \n])(?<![ \n](?:not|never|nor)[ \n])": [s for s, sid in named.items() if sid in mid]}
    return "|".join(f"{at}(?:{any_of(some)})(?= ?\n)" for at, some in begin.items() if some)


def sentence_table(spark: SparkSession, known: dict[str, str]) -> DataFrame:
    """The known sentences, normalised: ``sentence, sid``; as many rows as the rules name."""
    rows = spark.createDataFrame(sorted(known.items()), "sid string, sentence string")
    return rows.select(normalised(F.col("sentence")).alias("sentence"), "sid")


def _rule(orders: list[list[str]], trail: Column) -> Column:
    hit = F.lit(False)
    for order in orders:
        hit = hit | trail.rlike(" " + " (.* )?".join(order) + " ")
    return hit


def scan_licenses(docs: DataFrame, known: dict[str, str] = SENTENCES, rules: dict[str, list[list[str]]] = RULES,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_sentences, sentence_ids, licenses`` of every row.

    ``sentence_ids`` lists the licence sentences in text order, ``licenses``
    the licences whose rule holds, by name, both joined by commas. The known
    sentences are turned into a map literal of the plan, whose size the rules
    bound; the scan is one narrow pass, whatever a source or text repeats.
    """
    spark = docs.sparkSession
    named = {r["sentence"]: r["sid"] for r in sentence_table(spark, known).collect()}  # the rule table, not data
    lookup = F.create_map(*[F.lit(x) for pair in sorted(named.items()) for x in pair])
    # A text without the longest word of any known sentence has no such sentence.
    marks = sorted({min(s.split(), key=lambda w: (-len(w), w)) for s in named})
    may = F.col(text_col).rlike("(?iu)" + "|".join(marks)) if marks else F.lit(False)
    hits = F.regexp_extract_all(cut_words(F.col(text_col)), F.lit(sentence_pattern(named)), F.lit(0)) if named else F.array()
    found = F.transform(hits, lambda s: F.element_at(lookup, F.translate(s, "\n", " ")))
    ids = F.when(may, found).otherwise(F.array().cast("array<string>"))
    rows = docs.select(F.col(id_col), F.coalesce(ids, F.array().cast("array<string>")).alias("_ids"))
    trail = F.concat(F.lit(" "), F.array_join("_ids", " "), F.lit(" "))
    holds = {name: _rule(orders, trail) for name, orders in rules.items()}
    named_by = {name: hit & ~holds[UNLESS[name]] if UNLESS.get(name) in holds else hit for name, hit in holds.items()}
    held = F.array(*[F.when(hit, F.lit(name)) for name, hit in sorted(named_by.items(), key=lambda x: x[0])])
    return rows.select(id_col, F.size("_ids").cast("long").alias("n_sentences"),
                       F.array_join("_ids", ",").alias("sentence_ids"), F.array_join(held, ",").alias("licenses"))
