"""Licence scans by sentence rules. DataFrame functions only.

A text is cut into sentences (a mark of end followed by white space or the
end, but not the stop of ``v. 2.0``), each normalised to lower-case ASCII
letters and digits with single spaces.  A sentence becomes the identifiers of
the known licence sentences that it holds between word borders, from left to
right without overlap (of several that begin at one word the first listed), or
``-`` without any.  A known sentence may have slots, ``{n}`` for up to n words:
names of persons and works.  Version clauses ("either version 2 of the
license", "any later version") are sentences of their own, as are SPDX lines.
A grant that is negated ("not licensed under ...") is none.

The identifier sequence is matched against ordered rules, longest first: a rule
claims its identifiers where they stand one after another, with at most
``GAP`` unknown sentences between two of them, and claimed identifiers serve no
later rule.  Identifiers that no rule claims are reported as unmatched.

Defined results: a null or empty text has no identifiers and no licence; line
breaks inside a sentence do not matter; texts of any length are read whole;
repeated notices are reported once in ``licenses`` and counted in ``n_sentences``;
repeated rows and null keys stay; an empty table gives no rows; only the key and the
text are read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GAP = 20                           # unknown sentences that may stand between two of a rule

# fixed values: licences whose SPDX line is known
SPDX = ("MIT", "ISC", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0", "GPL-2.0-or-later", "GPL-2.0-only", "GPL-2.0",
        "GPL-3.0-or-later", "GPL-3.0-only", "GPL-3.0", "LGPL-2.1-or-later", "LGPL-2.1-only", "LGPL-3.0-or-later",
        "LGPL-3.0-only", "AGPL-3.0-or-later", "AGPL-3.0-only", "CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0", "Unlicense")
# fixed values: the names of the GNU licences' families, and their versions
FAMILIES = (("LGPL", "gnu lesser general public license", ("2.1", "3.0")), ("LGPL", "gnu library general public license", ("2.0",)),
            ("AGPL", "gnu affero general public license", ("3.0",)), ("GPL", "gnu general public license", ("2.0", "3.0")))
# fixed values: normalised licence sentences and their identifiers
SENTENCES = (
    ("licensed under {1}apache license {1}2 0", "Apache2Grant"),
    ("you may not use this {3}except in compliance with the license", "ApacheUse"),
    ("you may obtain a copy of the license at", "ApacheCopy"),
    ("distributed on an as is basis without warranties or conditions of any kind", "ApacheAsIs"),
    ("see the license for the specific language governing permissions", "ApacheSee"),
    ("released under {1}mit license", "MITGrant"),
    ("licensed under {1}mit license", "MITGrant"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "MITPermission"),
    ("the above copyright notice and this permission notice shall be included", "MITNotice"),
    ("the software is provided as is without warranty of any kind", "MITAsIs"),
    ("permission to use copy modify and {1}distribute this software {2}for any purpose with or without fee is hereby granted",
     "ISCPermission"),
    ("the software is provided as is and {4}disclaims all warranties", "ISCAsIs"),
    ("licensed under the gnu lesser general public license version 3", "LGPL3Grant"),
    ("licensed under the gnu affero general public license version 3", "AGPL3Grant"),
    ("licensed under the gnu general public license version 3", "GPL3Grant"),
    ("licensed under the gnu general public license version 2", "GPL2Grant"),
    ("this {3}is free software you can redistribute it", "GPLFree"),
    ("without even the implied warranty of merchantability or fitness", "GPLWarranty"),
    ("version 2 1 of the license", "Version21"),
    ("version 2 of the license", "Version20"),
    ("version 3 of the license", "Version30"),
    ("any later version", "AnyLater"),
    ("licensed under cc by nc sa 4 0", "CCBYNCSAGrant"),
    ("licensed under cc by nc nd 4 0", "CCBYNCNDGrant"),
    ("licensed under cc by nc 4 0", "CCBYNCGrant"),
    ("licensed under cc by sa 4 0", "CCBYSAGrant"),
    ("licensed under cc by 4 0", "CCBYGrant"),
    ("redistribution and use in source and binary forms", "BSDRedistribute"),
    ("neither the name {12}nor the names of {6}contributors", "BSDEndorse"),
    ("the name of {8}may not be used to endorse or promote", "BSDEndorse"),
    ("this software is provided by {12}as is", "BSDAsIs"),
    ("subject to the terms of the mozilla public license v 2 0", "MPL2Grant"),
)
SENTENCES += tuple(pair for family, name, _ in FAMILIES for pair in (
    (f"under the terms of the {name}", f"{family}Terms"),
    (f"you should have received a copy of the {name}", f"{family}Received")))
SENTENCES += tuple((f"spdx license identifier {re.sub('[^a-z0-9]+', ' ', name.lower())}",
                    f"Spdx{re.sub('[^A-Za-z0-9]', '', name)}") for name in SPDX)
# fixed values: ordered rules, identifiers in sequence and the licence they mean
RULES = (
    (("Apache2Grant", "ApacheUse", "ApacheCopy", "ApacheAsIs", "ApacheSee"), "Apache-2.0"),
    (("MITPermission", "MITNotice", "MITAsIs"), "MIT"),
    (("ISCPermission", "ISCAsIs"), "ISC"),
    (("GPL3Grant", "GPLFree", "GPLWarranty", "GPLReceived"), "GPL-3.0"),
    (("BSDRedistribute", "BSDEndorse", "BSDAsIs"), "BSD-3-Clause"),
    (("BSDRedistribute", "BSDAsIs"), "BSD-2-Clause"),
    (("BSDRedistribute", "BSDAsIs", "BSDEndorse"), "BSD-3-Clause"),
    (("Apache2Grant",), "Apache-2.0"),
    (("MITGrant",), "MIT"),
    (("MITPermission",), "MIT"),
    (("ISCPermission",), "ISC"),
    (("LGPL3Grant",), "LGPL-3.0"),
    (("AGPL3Grant",), "AGPL-3.0"),
    (("GPL3Grant",), "GPL-3.0"),
    (("GPL2Grant",), "GPL-2.0"),
    (("CCBYNCSAGrant",), "CC-BY-NC-SA-4.0"),
    (("CCBYNCNDGrant",), "CC-BY-NC-ND-4.0"),
    (("CCBYNCGrant",), "CC-BY-NC-4.0"),
    (("CCBYSAGrant",), "CC-BY-SA-4.0"),
    (("CCBYGrant",), "CC-BY-4.0"),
    (("MPL2Grant",), "MPL-2.0"),
)
for _family, _, _versions in FAMILIES:
    for _version in _versions:
        _clause = (f"{_family}Terms", f"Version{_version.replace('.', '')}")
        for _later, _which in ((("AnyLater",), "or-later"), ((), "only")):
            RULES += (((*_clause, *_later), f"{_family}-{_version}-{_which}"),
                      (("GPLFree", *_clause, *_later, "GPLWarranty", f"{_family}Received"), f"{_family}-{_version}-{_which}"))
    RULES += ((("GPLFree", f"{_family}Terms", "GPLWarranty", f"{_family}Received"), _family), ((f"{_family}Terms",), _family))
RULES += tuple(((f"Spdx{re.sub('[^A-Za-z0-9]', '', name)}",), name) for name in SPDX)
#: longer rules before their own beginnings; one rule for each sequence
RULES = tuple(sorted(dict.fromkeys(RULES), key=lambda rule: -len(rule[0])))

# the stop of an abbreviated "version" before its number, in a comment or not, ends nothing
END = r"[.!?]+(?!(?<=\b(?i:v|ver|vers)\.)[ \t\n\r\f#*/;-]+[0-9])([ \t\n\r\f]+|\z)"
OTHER = r"[^A-Za-z0-9]+"
NEGATED = r"\b(?:not|never|no longer|nor|cannot be)(?: [a-z0-9]+){0,2} (?:licensed|released|available|distributed) under\b"
# every known sentence has one of these; texts without any are not cut
HINT = "(?i)licen|permission|redistribut|warrant|contributor|software|version|copyright|spdx|terms|endorse"


def pattern(sentence: str) -> str:
    """The regular expression of a known sentence with slots."""
    return re.sub(r"\{(\d+)\}", r"(?:[a-z0-9]+ ){0,\1}?", sentence)


def sentences(text: Column) -> Column:
    """Normalised sentences, each between single spaces."""
    cut = F.split(F.regexp_replace(text, END, "\x01"), "\x01", -1)
    return F.transform(cut, lambda s: F.concat(
        F.lit(" "), F.regexp_replace(F.lower(F.trim(F.regexp_replace(s, OTHER, " "))), NEGATED, "negated"), F.lit(" ")))


def one_of(known=SENTENCES) -> str:
    """The expression of any known sentence."""
    return rf"\b(?:{'|'.join(pattern(s) for s, _ in known)})\b"


def identifiers(text: Column, known=SENTENCES) -> Column:
    """The identifiers of each sentence in order, ``-`` for unknown ones."""
    plain = {s: name for s, name in reversed(known) if "{" not in s}
    name_of = F.create_map(*[F.lit(x) for pair in plain.items() for x in pair])

    def named(words: Column) -> Column:
        name = F.try_element_at(name_of, words)
        for s, identifier in known:
            if "{" in s:
                name = F.coalesce(name, F.when(F.regexp_like(words, F.lit(f"^{pattern(s)}$")), F.lit(identifier)))
        return name

    def of_sentence(sentence: Column) -> Column:
        found = F.regexp_extract_all(sentence, F.lit(one_of(known)), F.lit(0))
        return F.when(F.size(found) > 0, F.transform(found, named)).otherwise(F.array(F.lit("-")))
    ids = F.flatten(F.transform(sentences(text), of_sentence))
    return F.when(F.regexp_like(text, F.lit(HINT)), ids).otherwise(F.expr("cast(array() as array<string>)"))


def sequence_pattern(sequence: tuple[str, ...], gap: int = GAP) -> str:
    """A rule over identifiers that stand between bars, with unknown sentences between them."""
    return rf"(?:\|-\|){{0,{gap}}}".join(rf"\|{i}\|" for i in sequence)


def license_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   known=SENTENCES, rules=RULES) -> DataFrame:
    """doc_id, licenses (rule order, comma-joined), sentence_ids (in text order,
    unknown sentences left out), n_sentences (known ones), unmatched."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    doc = docs.select(F.col(id_col).alias("doc_id"), identifiers(text, known).alias("ids"))
    seen = F.filter("ids", lambda i: i != "-")
    # every identifier stands between bars of its own, so rules match whole ones
    doc = doc.withColumn("left", F.array_join(F.transform(
        "ids", lambda i: F.concat(F.lit("|"), i, F.lit("|"))), ""))
    names: dict[str, Column] = {}
    for k, (sequence, licence) in enumerate(rules):
        expression = sequence_pattern(sequence)
        # the first identifier tells most documents without a regular expression
        held = F.contains(F.col("left"), F.lit(f"|{sequence[0]}|"))
        doc = doc.withColumn(f"hit_{k}", held & F.regexp_like(F.col("left"), F.lit(expression)))
        doc = doc.withColumn("left", F.when(F.col(f"hit_{k}"), F.regexp_replace("left", expression, "|*|")).otherwise(F.col("left")))
        names[licence] = names[licence] | F.col(f"hit_{k}") if licence in names else F.col(f"hit_{k}")
    found = F.concat_ws(",", *[F.when(hit, F.lit(name)) for name, hit in names.items()])
    unclaimed = F.filter(F.split("left", r"\|+"), lambda i: ~i.isin("", "-", "*"))
    return doc.select("doc_id", found.alias("licenses"), F.array_join(seen, ",").alias("sentence_ids"),
                      F.size(seen).cast("long").alias("n_sentences"),
                      F.size(unclaimed).cast("long").alias("unmatched"))
