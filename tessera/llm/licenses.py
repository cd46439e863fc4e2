"""License recognition by sentence rules, in DataFrame expressions only.

A text is cut into sentences, each normalised to lower-case words; known
sentences become identifiers, all others vanish. The sequence of identifiers is
matched against ordered rules, the longest first: each match names a license
and is taken out of the sequence, and what remains is reported as unmatched.
Sentences are cut both at every line end and at paragraph ends only, so that
one-line notices and wrapped license texts are both seen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Identifier of each known sentence, written as it is after normalisation. The wording of public licenses.
SENTENCES = {
    "apache_short": "licensed under the apache license version 2 0",
    "apache_grant": "licensed under the apache license version 2 0 the license",
    "apache_use": "you may not use this file except in compliance with the license",
    "apache_copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache_basis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache_see": "see the license for the specific language governing permissions and limitations under the license",
    "mit_short": "released under the mit license",
    "mit_under": "licensed under the mit license",
    "mit_title": "the mit license mit",
    "mit_grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit_notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit_warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "isc_grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "gpl3_short": "this work is licensed under the gnu general public license version 3",
    "gpl_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl_hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "bsd_intro": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd_source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd_binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd_endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "mpl2": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "ccbync4_short": "licensed under cc by nc 4 0",
    "ccby4": "this work is licensed under a creative commons attribution 4 0 international license",
    "ccbysa4": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "cc0": "this work is dedicated to the public domain under cc0 1 0",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "reserved": "all rights reserved",
    "spdx_mit": "spdx license identifier mit",
    "spdx_apache": "spdx license identifier apache 2 0",
    "spdx_gpl3": "spdx license identifier gpl 3 0 or later",
    "spdx_bsd3": "spdx license identifier bsd 3 clause",
}

#: (license, identifiers in order). Rules are tried from the longest to the shortest; of equal length, as listed.
RULES = [
    ("Apache-2.0", ["apache_grant", "apache_use", "apache_copy", "apache_basis", "apache_see"]),
    ("BSD-3-Clause", ["bsd_intro", "bsd_source", "bsd_binary", "bsd_endorse"]),
    ("BSD-2-Clause", ["bsd_intro", "bsd_source", "bsd_binary"]),
    ("MIT", ["mit_grant", "mit_notice", "mit_warranty"]),
    ("GPL-3.0-or-later", ["gpl_free", "gpl_hope"]),
    ("GPL-2.0-or-later", ["gpl2_free", "gpl_hope"]),
    ("ISC", ["isc_grant"]),
    ("Apache-2.0", ["apache_short"]),
    ("Apache-2.0", ["spdx_apache"]),
    ("MIT", ["mit_short"]),
    ("MIT", ["mit_under"]),
    ("MIT", ["mit_title"]),
    ("MIT", ["spdx_mit"]),
    ("GPL-3.0-only", ["gpl3_short"]),
    ("GPL-3.0-or-later", ["spdx_gpl3"]),
    ("BSD-3-Clause", ["spdx_bsd3"]),
    ("MPL-2.0", ["mpl2"]),
    ("CC-BY-NC-4.0", ["ccbync4_short"]),
    ("CC-BY-4.0", ["ccby4"]),
    ("CC-BY-SA-4.0", ["ccbysa4"]),
    ("CC0-1.0", ["cc0"]),
    ("Unlicense", ["unlicense"]),
    ("Proprietary", ["reserved"]),
]

#: What the cuts make of the standard Apache header: its first two lines are one sentence of a paragraph, an empty line
#: parts the address from its sentence, and a comment sign on that line joins address and the next sentence.
HEADER_SENTENCES = {
    "apache_grant_use": f"{SENTENCES['apache_grant']} {SENTENCES['apache_use']}",
    "apache_at": "you may obtain a copy of the license at",
    "apache_address": "http www apache org licenses license 2 0",
    "apache_copy_basis": f"{SENTENCES['apache_copy']} {SENTENCES['apache_basis']}",
}
HEADER_RULES = [
    ("Apache-2.0", ["apache_grant", "apache_use", "apache_at", "apache_address", "apache_basis", "apache_see"]),
    ("Apache-2.0", ["apache_grant_use", "apache_at", "apache_address", "apache_basis", "apache_see"]),
    ("Apache-2.0", ["apache_grant_use", "apache_copy", "apache_basis", "apache_see"]),
    ("Apache-2.0", ["apache_grant_use", "apache_copy_basis", "apache_see"]),
]

#: Where a sentence ends: after its full stop, exclamation or question mark, or at a line end or paragraph end.
AFTER_MARK = "[.!?]+(?:[ \\t\\r\\n]+|$)"
BY_LINE = f"{AFTER_MARK}|\\n"
BY_PARAGRAPH = f"{AFTER_MARK}|\\n[ \\t\\r]*\\n"
#: Every sentence that the SQL knows has one of these, written with one blank; the SQL looks at texts with one only.
TRIGGERS = ["licens", "permi", "redistribut", "warrant", "copyright", "public domain", "all rights reserved", "free software"]
NOT_WORD = "[^0-9a-z]+"
#: Every known sentence has one of these, however its words are parted, so texts without any have no sentences to look up.
SEEN = "|".join(t.replace(" ", NOT_WORD) for t in TRIGGERS)


def identifiers(text: Column, cut: str, sentences: dict[str, str]) -> Column:
    """The known sentences of a text as one string ``;id;;id;``, in order."""
    table = F.create_map(*(F.lit(x) for name, words in sentences.items() for x in (words, name)))
    clean = lambda s: F.trim(F.regexp_replace(s, NOT_WORD, " "))
    found = F.filter(F.transform(F.split(text, cut), lambda s: F.element_at(table, clean(s))), lambda x: x.isNotNull())
    return F.array_join(F.transform(found, lambda x: F.concat(F.lit(";"), x, F.lit(";"))), "")


def apply_rules(df: DataFrame, ids: str, out: str, rules: list[tuple[str, list[str]]]) -> DataFrame:
    """Add ``out`` (array of license names, one per rule that matched) and take the matches out of ``ids``."""
    hits = []
    for k, (_, parts) in enumerate(sorted(rules, key=lambda r: -len(r[1]))):
        pattern = F.lit("".join(f";{p};" for p in parts))
        df = df.withColumn(f"_hit{k}", F.contains(F.col(ids), pattern)).withColumn(ids, F.replace(ids, pattern, F.lit("|")))
        hits.append(f"_hit{k}")
    names = [name for name, _ in sorted(rules, key=lambda r: -len(r[1]))]
    named = F.filter(F.array(*(F.when(F.col(h), F.lit(n)) for h, n in zip(hits, names, strict=True))), lambda x: x.isNotNull())
    return df.withColumn(out, named).drop(*hits)


def license_scan(df: DataFrame, key: str = "doc_id", text: str = "text", sentences: dict[str, str] | None = None, rules: list | None = None) -> DataFrame:
    """One row per row of ``df``: (key, licenses, n_sentences, unmatched).

    licenses: names in alphabetical order, joined by commas, '' for none.
    n_sentences: known sentences found, under the cut that finds more.
    unmatched: identifiers of known sentences that no rule took, in order, '' for none.
    Null and empty texts have no license; whole texts are scanned, however
    long; repeated rows give repeated rows, an empty table none. Other columns
    are ignored. There is no shuffle and no Python on the way.
    """
    own = sentences is not None
    sentences, rules = sentences or SENTENCES | HEADER_SENTENCES, rules or RULES + HEADER_RULES
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    rows = df.select(F.col(key), low.alias("_low"))
    if not own:  # a caller's sentences need not have any of these words
        rows = rows.withColumn("_low", F.when(F.col("_low").rlike(SEEN), F.col("_low")))
    for name, cut in (("_line", BY_LINE), ("_para", BY_PARAGRAPH)):
        rows = rows.withColumn(name, F.coalesce(identifiers(F.col("_low"), cut, sentences), F.lit("")))
    rows = rows.withColumn("_more", F.length(F.regexp_replace("_para", "[^;]", "")) > F.length(F.regexp_replace("_line", "[^;]", "")))
    rows = rows.withColumn("_ids", F.when(F.col("_more"), F.col("_para")).otherwise(F.col("_line"))).drop("_low")
    rows = rows.withColumn("n_sentences", F.floor(F.length(F.regexp_replace("_ids", "[^;]", "")) / 2).cast("long"))
    rows = apply_rules(apply_rules(rows, "_line", "_by_line", rules), "_para", "_by_para", rules)
    left = F.when(F.col("_more"), F.col("_para")).otherwise(F.col("_line"))
    left = F.array_join(F.filter(F.split(left, r"[;|]+"), lambda x: x != ""), ",")
    names = F.array_join(F.array_sort(F.array_distinct(F.concat("_by_line", "_by_para"))), ",")
    return rows.select(key, names.alias("licenses"), "n_sentences", left.alias("unmatched"))


def op2_license_scan(spark, sf_dir: str) -> DataFrame:
    return license_scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    case = "CASE s " + " ".join(f"WHEN {quote(w)} THEN {quote(n)}" for n, w in SENTENCES.items()) + " END"
    ids = lambda cut: (
        f"coalesce(list_aggregate(list_transform(list_filter(list_transform(list_transform(string_split_regex(low, {quote(cut)}), "
        f"lambda x: trim(regexp_replace(x, '{NOT_WORD}', ' ', 'g'))), lambda s: {case}), lambda y: y IS NOT NULL), lambda z: ';' || z || ';'), 'string_agg', ''), '')"
    )
    ordered = sorted(RULES, key=lambda r: -len(r[1]))
    steps, line, para, prev = [], "line0", "para0", "ids"
    names = []
    for k, (name, parts) in enumerate(ordered):
        p = quote("".join(f";{x};" for x in parts))
        steps.append(f"r{k} AS (SELECT * EXCLUDE (line, para), contains(line, {p}) OR contains(para, {p}) AS hit{k}, replace(line, {p}, '|') AS line, replace(para, {p}, '|') AS para FROM {prev})")
        names.append(f"CASE WHEN hit{k} THEN {quote(name)} END")
        prev = f"r{k}"
    count = lambda c: f"length(regexp_replace({c}, '[^;]', '', 'g'))"
    return f"""
WITH low AS (SELECT doc_id, CASE WHEN regexp_matches(lower(text), '{"|".join(TRIGGERS)}') THEN lower(text) ELSE '' END AS low FROM documents),
ids AS (SELECT doc_id, {ids(BY_LINE)} AS line, {ids(BY_PARAGRAPH)} AS para, line AS line0, para AS para0 FROM low),
{", ".join(steps)}
SELECT doc_id,
       coalesce(list_aggregate(list_sort(list_distinct(list_filter([{", ".join(names)}], lambda x: x IS NOT NULL))), 'string_agg', ','), '') AS licenses,
       ({count("CASE WHEN " + count("para0") + " > " + count("line0") + " THEN para0 ELSE line0 END")} // 2)::BIGINT AS n_sentences,
       coalesce(list_aggregate(list_filter(string_split_regex(CASE WHEN {count("para0")} > {count("line0")} THEN para ELSE line END, '[;|]+'), lambda x: x <> ''), 'string_agg', ','), '') AS unmatched
FROM {prev}"""


ORACLE_SQL = {"op2_license_scan": _sql()}
