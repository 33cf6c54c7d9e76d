"""Licence recognition by sentences and ordered rules, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Known sentences after normalisation (lower case; runs of other characters than a-z 0-9 . + - are one
# space; no full stops, hyphens or spaces at the ends), with their identifiers.
SENTENCES = {
    "licensed under the apache license version 2.0": "apache-2-named",
    "licensed under the apache license version 2.0 the license": "apache-2-named",
    "you may not use this file except in compliance with the license": "apache-comply",
    "you may obtain a copy of the license at http www.apache.org licenses license-2.0": "apache-2-copy",
    "you may obtain a copy of the license at https www.apache.org licenses license-2.0": "apache-2-copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an"
    " as is basis without warranties or conditions of any kind either express or implied": "apache-disclaim",
    "see the license for the specific language governing permissions and limitations under the license": "apache-see",
    "released under the mit license": "mit-named",
    "licensed under the mit license": "mit-named",
    "the mit license mit": "mit-title",
    "mit license": "mit-title",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
    " documentation files the software to deal in the software without restriction including without limitation the"
    " rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit"
    " persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of"
    " the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the"
    " warranties of merchantability fitness for a particular purpose and noninfringement": "mit-disclaim",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an"
    " action of contract tort or otherwise arising from out of or in connection with the software or the use or other"
    " dealings in the software": "mit-liability",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the"
    " following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following"
    " disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following"
    " disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
    " products derived from this software without specific prior written permission": "bsd-endorse",
    "this work is licensed under the gnu general public license version 3": "gpl-3-named",
    "licensed under the gnu general public license version 3": "gpl-3-named",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public"
    " license as published by the free software foundation either version 2 of the license or at your option any later"
    " version": "gpl-2-later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public"
    " license as published by the free software foundation either version 3 of the license or at your option any later"
    " version": "gpl-3-later",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied"
    " warranty of merchantability or fitness for a particular purpose": "gpl-hope",
    "see the gnu general public license for more details": "gpl-see",
    "you should have received a copy of the gnu general public license along with this program": "gpl-received",
    "licensed under cc by-nc 4.0": "cc-by-nc-4-named",
    "licensed under cc by 4.0": "cc-by-4-named",
    "licensed under cc by-sa 4.0": "cc-by-sa-4-named",
    "spdx-license-identifier apache-2.0": "spdx-apache-2",
    "spdx-license-identifier mit": "spdx-mit",
    "spdx-license-identifier bsd-3-clause": "spdx-bsd-3",
    "spdx-license-identifier gpl-3.0-only": "spdx-gpl-3",
    "spdx-license-identifier gpl-3.0-or-later": "spdx-gpl-3-later",
    "all rights reserved": "reserved",
}
# Every known sentence holds one of these, so a text with none of them needs no reading.
ANCHORS = ("licen", "permi", "redistribut", "warrant", "free software", "liable", "rights reserved")
# Ordered rules: the identifiers, in this order and next to each other among the known ones, mean the licence. An earlier
# rule takes its identifiers away from later ones.
RULES = (
    ("Apache-2.0", ("apache-2-named", "apache-comply", "apache-2-copy", "apache-disclaim", "apache-see")),
    ("MIT", ("mit-grant", "mit-notice", "mit-disclaim", "mit-liability")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("GPL-3.0-or-later", ("gpl-3-later", "gpl-hope", "gpl-see", "gpl-received")),
    ("GPL-3.0-or-later", ("gpl-3-later",)),
    ("GPL-2.0-or-later", ("gpl-2-later", "gpl-hope", "gpl-see", "gpl-received")),
    ("GPL-2.0-or-later", ("gpl-2-later",)),
    ("Apache-2.0", ("apache-2-named",)),
    ("Apache-2.0", ("spdx-apache-2",)),
    ("MIT", ("mit-title",)),
    ("MIT", ("mit-named",)),
    ("MIT", ("spdx-mit",)),
    ("BSD-3-Clause", ("spdx-bsd-3",)),
    ("GPL-3.0-only", ("gpl-3-named",)),
    ("GPL-3.0-only", ("spdx-gpl-3",)),
    ("GPL-3.0-or-later", ("spdx-gpl-3-later",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-named",)),
    ("CC-BY-4.0", ("cc-by-4-named",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-named",)),
    ("Proprietary", ("reserved",)),
)
CUT = "\x01"
# a full stop and its like before white space, a colon at the end of a line, a blank line
END_OF_SENTENCE, OTHER = r"[.!?;]+[ \t\r\n]+|:[ \t\r]*\n|\n[ \t\r]*\n", rf"[^a-z0-9.+{CUT}-]+"


def _identifiers(lowered: Column, lines_end: bool) -> Column:
    """Identifiers of the known sentences in turn; ``lines_end`` says whether a line end is an end of sentence or a space."""
    cut = F.regexp_replace(lowered, END_OF_SENTENCE, CUT)
    cut = F.translate(cut, "\n", CUT) if lines_end else cut
    sentences = F.transform(F.split(F.regexp_replace(cut, OTHER, " "), CUT), lambda s: F.btrim(s, F.lit(" .-")))
    known = F.filter(sentences, lambda s: s.isin(*SENTENCES))
    names = F.create_map(*(F.lit(x) for pair in SENTENCES.items() for x in pair))
    return F.transform(known, lambda s: F.element_at(names, s))


def _written(identifiers: Column) -> Column:
    return F.array_join(F.transform(identifiers, lambda i: F.concat(F.lit("<"), i, F.lit(">"))), "")


def scan_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, sequence, licences, n_licences, left_over.

    ``sequence`` has the identifiers of known sentences in turn, once with line ends as ends of sentences and, after a
    bar, once with line ends as spaces (wrapped licence texts). ``licences`` are the names of the rules that match in
    either reading, in the order of the rules, each once. ``left_over`` is true if known sentences remain that no rule
    took. A projection without shuffle; only texts with one of the anchors are split. Null and empty texts have an
    empty sequence and no licences; null ids and repeated rows stay; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.lower(F.col(text_col).cast("string")), F.lit("")).alias("t"))
    worth = F.lit(False)
    for anchor in ANCHORS:
        worth = worth | F.contains("t", F.lit(anchor))
    read = rows.withColumn("worth", worth).select(
        "doc_id",
        *(F.when(F.col("worth"), _written(_identifiers(F.col("t"), lines_end))).otherwise("").alias(name)
          for name, lines_end in (("by_line", True), ("by_stop", False))))
    read, matched = read.withColumns({"line_seen": F.col("by_line"), "stop_seen": F.col("by_stop")}), []
    for k, (name, steps) in enumerate(RULES):  # a rule leaves a bar where its identifiers were
        wanted = "".join(f"<{s}>" for s in steps)
        read = read.withColumns({
            f"r{k}": F.contains("by_line", F.lit(wanted)) | F.contains("by_stop", F.lit(wanted)),
            "by_line": F.replace("by_line", F.lit(wanted), F.lit("|")), "by_stop": F.replace("by_stop", F.lit(wanted), F.lit("|"))})
        matched.append(F.when(F.col(f"r{k}"), name))
    found = F.array_distinct(F.array_compact(F.array(*matched)))
    return read.select(
        "doc_id", F.concat_ws("|", "line_seen", "stop_seen").alias("sequence"), F.array_join(found, ",").alias("licences"),
        F.size(found).cast("long").alias("n_licences"),
        (F.contains("by_line", F.lit("<")) | F.contains("by_stop", F.lit("<"))).alias("left_over"))


def scan_sql(table: str = "documents") -> str:
    """The same in DuckDB SQL."""
    def text(value: str) -> str:
        return "'" + value.replace("'", "''") + "'"

    names = f"MAP {{{', '.join(f'{text(s)}: {text(i)}' for s, i in SENTENCES.items())}}}"

    def identifiers(lines_end: bool) -> str:
        cut = f"regexp_replace(t, '{END_OF_SENTENCE}', chr(1), 'g')"
        cut = f"replace({cut}, chr(10), chr(1))" if lines_end else cut
        parts = f"string_split(regexp_replace({cut}, '[^a-z0-9.+\\x01-]+', ' ', 'g'), chr(1))"
        known = f"list_filter(list_transform({parts}, lambda s: trim(s, ' .-')), lambda s: s IN ({', '.join(map(text, SENTENCES))}))"
        return f"coalesce(array_to_string(list_transform({known}, lambda s: '<' || {names}[s] || '>'), ''), '')"

    steps = [f"s0 AS (SELECT doc_id, {identifiers(True)} AS by_line, {identifiers(False)} AS by_stop FROM base)"]
    flags: list[str] = []
    for k, (_, rule) in enumerate(RULES):
        wanted = text("".join(f"<{s}>" for s in rule))
        seen = "by_line AS line_seen, by_stop AS stop_seen" if k == 0 else "line_seen, stop_seen"
        steps.append(
            f"s{k + 1} AS (SELECT doc_id, {seen}, replace(by_line, {wanted}, '|') AS by_line, replace(by_stop, {wanted}, '|') AS by_stop, "
            f"{''.join(f'{x}, ' for x in flags)}(contains(by_line, {wanted}) OR contains(by_stop, {wanted})) AS r{k} FROM s{k})")
        flags.append(f"r{k}")
    whens = ", ".join(f"CASE WHEN r{k} THEN {text(name)} END" for k, (name, _) in enumerate(RULES))
    order = f"list_filter([{whens}], lambda x: x IS NOT NULL)"
    found = f"list_filter(list_transform(range(1, len({order}) + 1), lambda i: CASE WHEN list_position({order}, {order}[i]) = i THEN {order}[i] END), lambda x: x IS NOT NULL)"
    return (
        f"WITH base AS (SELECT doc_id, coalesce(lower(text), '') AS t FROM {table}), {', '.join(steps)} "
        f"SELECT doc_id, line_seen || '|' || stop_seen AS sequence, coalesce(array_to_string({found}, ','), '') AS licences, "
        f"CAST(len({found}) AS BIGINT) AS n_licences, (contains(by_line, '<') OR contains(by_stop, '<')) AS left_over FROM s{len(RULES)}")
