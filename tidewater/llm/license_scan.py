"""License scans by ordered signature rules, in built-in expressions alone."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word: letters and digits of ASCII and everything above it. A-Z count as lower case.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: The base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: What the SQL asks of a text before its rules. It is narrower than the rules, so the scan asks for GATE.
SQL_GATE = rf"(?i)licen[cs]|lizenz|copyleft|copyright|warrant|redistribut|spdx|rights|public{GAP}domain|creative{GAP}commons|cc{GAP}(by|0|zero)|gpl"

#: Strength of a detection by the kind of its rule, strongest first; its place is the rule's priority.
STRENGTHS = (1.0, 0.9, 0.7, 0.4)

#: Licenses that are found by name: label, the word or words a text must hold, the name, its versions.
#: Names are patterns over normalised text: lower-case words joined by one space.
NAMES = (
    ("apache", "apache", r"apache(?: software)?", ("1 0", "1 1", "2 0", "2")),
    ("mit", "mit", r"(?:mit|expat|mit x11|x11)", ()),
    ("bsd", "bsd", r"(?:(?:original|simplified|modified|new|revised) )?bsd", ("2 clause", "3 clause", "4 clause", "zero clause")),
    ("gpl", "gnu", r"gnu (?:gpl|general public)", ("1", "2", "3", "1 0", "2 0", "3 0")),
    ("gpl", "gpl", r"gpl", ("1", "2", "3", "2 0", "3 0")),
    ("lgpl", "lesser", r"(?:gnu )?(?:lgpl|lesser general public)", ("2 1", "3", "3 0")),
    ("lgpl", "lgpl", r"lgpl", ("2", "2 1", "3", "3 0")),
    ("agpl", "affero", r"(?:gnu )?affero general public", ("1", "3", "3 0")),
    ("agpl", "agpl", r"(?:gnu )?agpl", ("3", "3 0")),
    ("gfdl", "documentation", r"gnu free documentation", ("1 1", "1 2", "1 3")),
    ("mpl", "mozilla", r"mozilla public", ("1 0", "1 1", "2 0", "2")),
    ("epl", "eclipse", r"eclipse public", ("1 0", "2 0", "2")),
    ("edl", "eclipse", r"eclipse distribution", ("1 0",)),
    ("cddl", "cddl", r"cddl", ("1 0", "1 1")),
    ("cddl", "distribution", r"common development and distribution", ("1 0", "1 1")),
    ("cpl", "common", r"common public", ("1 0",)),
    ("eupl", "european", r"european union public", ("1 0", "1 1", "1 2")),
    ("osl", "open software", r"open software", ("1 0", "2 0", "2 1", "3 0")),
    ("afl", "academic", r"academic free", ("1 1", "2 0", "2 1", "3 0")),
    ("artistic", "artistic", r"(?:perl )?artistic", ("1 0", "2 0", "2")),
    ("bsl", "boost", r"boost software", ("1 0",)),
    ("isc", "isc", r"isc", ()),
    ("zlib", "zlib", r"zlib(?: libpng)?", ()),
    ("unlicense", "unlicense", r"the unlicense", ()),
    ("wtfpl", "wtfpl", r"(?:wtfpl|do what the fuck you want to public)", ("1", "2")),
    ("ofl", "open font", r"(?:sil )?open font", ("1 0", "1 1")),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)?", ()),
    ("python", "python", r"python software foundation", ("2",)),
    ("php", "php", r"php", ("3 0", "3 01")),
    ("postgresql", "postgresql", r"postgresql", ()),
    ("ruby", "ruby", r"ruby", ()),
    ("vim", "vim", r"vim", ()),
    ("odbl", "database", r"open (?:data commons open )?database", ("1 0",)),
    ("ms-pl", "microsoft", r"microsoft public", ()),
    ("ms-rl", "microsoft", r"microsoft reciprocal", ()),
    ("ipl", "ibm", r"ibm public", ("1 0",)),
    ("qpl", "public", r"q public", ("1 0",)),
    ("lppl", "latex", r"latex project public", ("1 3c",)),
    ("upl", "universal", r"universal permissive", ("1 0",)),
    ("bluer-oak", "blue oak", r"blue oak model", ("1 0 0",)),
    ("mulan", "mulan", r"mulan (?:permissive software|psl)", ("1", "2")),
    ("cecill", "cecill", r"cecill", ("1 0", "2 0", "2 1")),
    ("elastic", "elastic", r"elastic", ("2 0",)),
    ("sspl", "server side", r"server side public", ("1",)),
    ("busl", "business", r"business source", ("1 1",)),
)
#: Creative Commons: elements by label.
COMMONS = (
    ("by-nc-sa", r"(?:by nc sa|attribution non ?commercial share ?alike)"),
    ("by-nc-nd", r"(?:by nc nd|attribution non ?commercial no ?deriv(?:atives|s))"),
    ("by-nc", r"(?:by nc|attribution non ?commercial)"),
    ("by-nd", r"(?:by nd|attribution no ?deriv(?:atives|s))"),
    ("by-sa", r"(?:by sa|attribution share ?alike)"),
    ("by", r"(?:by|attribution)"),
)
#: Sentences of the licenses' own texts: label, keyword, pattern.
TEXTS = (
    ("mit", "permission", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("isc", "permission", r"permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "endorse", r"may be used to endorse or promote products derived from this software without"),
    ("apache-2", "apache", r"you may obtain a copy of the license at https? www apache org licenses license 2 0"),
    ("gpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("agpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("mpl-2", "mozilla", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("zlib", "as is", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("public-domain", "public domain", r"(?:released|placed|dedicated|is) (?:in|into|to) the public domain"),
    ("cc0-1", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc0-1", "cc zero", r"cc zero(?: 1 0)?"),
    ("proprietary", "all rights", r"all rights reserved"),
    ("proprietary", "confidential", r"confidential and proprietary"),
)
LICENSE = r"licen[cs]e"
UNDER = r"(?:licensed|released|distributed|available) under"
SPDX = "spdx license identifier"
HINT = rf"(?:under|see|accept) (?:the|this|a) {LICENSE}"


class Rule(NamedTuple):
    keyword: str  # the SQL tries the pattern where the text holds it; the scan goes by ``part``
    label: str
    priority: int  # 0 wins
    pattern: str
    part: str  # a pattern whose words lie in every match


def rules() -> list[Rule]:
    """All signature rules in order: license texts and base phrases, named versions, names, hints.

    A family gives a rule for each of its versions with the word "license", one for each short form,
    and one without a version.
    """
    found = [Rule(k, label, 0, p, p) for label, k, p in TEXTS]
    found += [Rule(p, label, 0, p, p) for p, label in BASE.items()]
    word, under = LICENSE, UNDER
    terms = rf"(?:{under} (?:the )?)?"  # so that what names the license more closely contains a hint
    for family, keyword, name, versions in NAMES:
        for version in versions:
            label = f"{family}-{version.removesuffix(' 0').replace(' ', '-')}"
            found.append(Rule(keyword, label, 1, rf"{terms}{name} {word}(?: agreement)? (?:v|version )?{version}(?: or later| only)?", name))
            found.append(Rule(keyword, label, 1, rf"{terms}{name} (?:v|version )?{version}(?: {word})?", name))
        found.append(Rule(keyword, family, 2, rf"{terms}{name} (?:style |software )?{word}", name))
        found.append(Rule(keyword, family, 3, rf"{under} (?:the )?{name}", name))
        found.append(Rule("spdx", family, 1, rf"{SPDX} {name}", SPDX))
    for elements, pattern in COMMONS:
        for keyword, name in (("cc", "cc"), ("creative", "creative commons")):
            for version in ("1 0", "2 0", "2 5", "3 0", "4 0"):
                label = f"cc-{elements}-{version.removesuffix(' 0').replace(' ', '-')}"
                found.append(Rule(keyword, label, 1, rf"{terms}{name} {pattern}(?: {word})? {version}", name))
            found.append(Rule(keyword, f"cc-{elements}", 2, rf"{terms}{name} {pattern}(?: {word})?", name))
    found.append(Rule("licen", "unnamed", 3, HINT, HINT))
    return found


def _gate() -> str:
    """A pattern that every text with a match of a rule meets: the rules without what they allow but don't ask for."""
    tails = [rf"(?:style |software )?{LICENSE}"]
    names = []
    for _, _, name, versions in NAMES:
        first = sorted({v.split(" ")[0] for v in versions})
        ends = [*tails, rf"(?:v|version )?(?:{'|'.join(first)})"] if first else tails
        names.append(rf"{name} (?:{'|'.join(ends)})")
    commons = rf"(?:cc|creative commons) (?:{'|'.join(pattern for _, pattern in COMMONS)})"
    named = rf"{UNDER} (?:the )?(?:{'|'.join(name for _, _, name, _ in NAMES)})"
    parts = [*names, commons, named, SPDX, HINT, *BASE, *[pattern for _, _, pattern in TEXTS]]
    return f"(?<!{WORD[:-1]})(?i:" + "|".join(parts).replace(" ", f"(?:{GAP}+)") + ")"


#: A text that doesn't meet this is not scanned further.
GATE = _gate()


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def detections(norm: Column) -> Column:
    """All matches of all rules in the normalised text: ``start, minus_end, priority, label``.

    Rules are tried where the part that all of their matches hold is met; it is looked for once. The text is padded with a space at either end, so words match as wholes. A match's place is the
    length of all that stands before it: the pieces between the matches, and the matches.
    """
    parts: dict[str, list[Column]] = {}
    for r in rules():
        parts.setdefault(r.part, []).append(F.struct(*[F.lit(getattr(r, f)).alias(f) for f in ("label", "priority", "pattern")]))
    table = F.array(*[F.struct(F.lit(f" (?:{p}) ").alias("part"), F.array(*of).alias("rules")) for p, of in parts.items()])
    tried = F.flatten(F.transform(F.filter(table, lambda p: F.regexp_like(norm, p["part"])), lambda p: p["rules"]))

    def matches(rule: Column) -> Column:
        pattern = F.concat(F.lit("(?<= )(?:"), rule["pattern"], F.lit(")(?= )"))
        found = F.regexp_extract_all(norm, pattern, F.lit(0))
        lengths = F.transform(F.split(norm, pattern), F.length)

        def place(gaps: Column) -> Column:
            def add(acc: Column, text: Column) -> Column:
                i = F.size(acc)
                before = F.when(i > 0, F.get(acc, i - 1)["end"]).otherwise(0) + F.get(gaps, i)
                return F.concat(acc, F.array(F.struct(before.alias("start"), (before + F.length(text)).alias("end"))))

            return F.aggregate(found, F.array().cast("array<struct<start:int,end:int>>"), add)

        return F.transform(
            _let(lengths, place),
            lambda m: F.struct(m["start"].alias("start"), (-m["end"]).alias("minus_end"), rule["priority"].alias("priority"), rule["label"].alias("label")),
        )

    return F.flatten(F.transform(tried, matches))


def surviving(found: Column) -> Column:
    """What is left when contained detections of no higher priority are suppressed: ``labels, priority``.

    In order of start, longest first, a detection lies in one met before if that reaches as far. For
    each priority the furthest end of those that win against it is kept, so one pass is enough.
    """
    levels = len(STRENGTHS)
    start = F.struct(
        F.array(*[F.lit(-1)] * levels).alias("ends"), F.array().cast("array<string>").alias("labels"), F.lit(levels).alias("priority")
    )

    def step(acc: Column, d: Column) -> Column:
        lost = F.get(acc["ends"], d["priority"]) >= -d["minus_end"]
        ends = F.transform(acc["ends"], lambda end, level: F.when(level >= d["priority"], F.greatest(end, -d["minus_end"])).otherwise(end))
        return F.struct(
            ends.alias("ends"),
            F.when(lost, acc["labels"]).otherwise(F.array_union(acc["labels"], F.array(d["label"]))).alias("labels"),
            F.when(lost, acc["priority"]).otherwise(F.least(acc["priority"], d["priority"])).alias("priority"),
        )

    return F.aggregate(F.array_sort(found), start, step, lambda acc: F.struct(acc["labels"].alias("labels"), acc["priority"].alias("priority")))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` for each row.

    Words are found in the whole text, lower-cased in A-Z. Base phrases are places where their words
    stand consecutively; overlaps count. Every rule is tried on every text that can match it. Of detections that overlap, one that lies within another of the same or
    a higher priority is suppressed; base labels always stay. The score is the strength of the
    strongest detection left, 0 without any.

    Each row is scanned on its own, without a shuffle. Null texts count as empty: no words, no
    labels. Null ids and repeated rows are scanned like any other. Other columns are not read. An
    empty table gives an empty one.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    df = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("t"))
    df = df.withColumn("n_words", F.regexp_count("t", F.lit(WORD)).cast("long"))
    # lower() also changes letters above ASCII; the Kelvin sign alone would become an ASCII letter
    words = F.filter(F.split(F.lower(F.replace("t", F.lit("K"), F.lit("é"))), GAP), lambda w: w != "")
    df = df.withColumn("w", F.when(F.col("t").rlike(GATE), words).otherwise(F.array().cast("array<string>"))).drop("t")
    phrases = [p.split(" ") for p in BASE]

    def here(i: Column, phrase: list[str]) -> Column:
        alike = [F.get("w", i + k) == word for k, word in enumerate(phrase)]
        hit = alike[0]
        for a in alike[1:]:
            hit = hit & a
        return F.coalesce(hit, F.lit(False))

    # the first words of the phrases come first, so that few words are looked at further
    starts = F.filter(
        F.transform("w", lambda x, i: F.when(x.isin(*{p[0] for p in phrases}), i)), lambda i: i.isNotNull()
    )
    kinds = F.transform(starts, lambda i: F.struct(i.alias("at"), F.coalesce(*[F.when(here(i, p), F.lit(label)) for p, label in zip(phrases, BASE.values(), strict=True)]).alias("label")))
    df = df.withColumn("base", F.filter(kinds, lambda b: b["label"].isNotNull()))
    df = df.withColumn("norm", F.when(F.size("w") > 0, F.concat(F.lit(" "), F.array_join("w", " "), F.lit(" "))).otherwise("")).drop("w")
    df = df.withColumn("left", F.when(F.col("norm") != "", surviving(detections(F.col("norm"))))).drop("norm")
    base_labels = F.array_distinct(F.transform("base", lambda b: b["label"]))
    labels = F.array_union(base_labels, F.coalesce(F.col("left")["labels"], F.array().cast("array<string>")))
    places = F.transform("base", lambda b: b["at"])
    level = F.when(F.size("base") > 0, 0).otherwise(F.coalesce(F.col("left")["priority"], F.lit(len(STRENGTHS))))
    score = F.coalesce(F.get(F.array(*map(F.lit, STRENGTHS)), level), F.lit(0.0))
    return df.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"), F.array_max(places).cast("long").alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"), F.array_join(F.array_sort(labels), ",").alias("labels"),
        score.alias("score"),
    )


def _sql() -> str:
    """The scan in SQL. Its regular expressions can't look around, so words stand between two spaces each."""
    quoted = [r._replace(pattern=r.pattern.replace(" ", "  ")) for r in rules()]
    values = ", ".join(f"('{r.keyword}', '{r.label}', {r.priority}, '{r.pattern}')" for r in quoted)
    base = " UNION ALL ".join(
        f"SELECT n, i, '{label}' AS label FROM s WHERE {' AND '.join(f"w[i + {k + 1}] = '{x}'" for k, x in enumerate(p.split(' ')))}"
        for p, label in BASE.items()
    )
    strengths = "[" + ", ".join(map(str, STRENGTHS)) + "]"
    return f"""
WITH d AS (
    SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS t,
           list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '{GAP}'), lambda x: x <> '') AS w FROM documents
), s AS (
    SELECT n, w, unnest(range(0, len(w))) AS i FROM d
), b AS (
    {base}
), bs AS (
    SELECT n, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word FROM b GROUP BY n
), g AS (
    SELECT n, '  ' || array_to_string(w, '  ') || '  ' AS norm, ' ' || array_to_string(w, ' ') || ' ' AS one FROM d
    WHERE regexp_matches(t, '{SQL_GATE}')
), m AS (
    SELECT n, label, priority, regexp_extract_all(norm, ' (?:' || pattern || ') ') AS found,
           string_split_regex(norm, ' (?:' || pattern || ') ') AS gaps
    FROM g JOIN (VALUES {values}) AS r(keyword, label, priority, pattern) ON contains(one, keyword)
), p AS (
    SELECT n, label, priority, list_sum(list_transform(gaps[:k], lambda x: len(x))) + coalesce(list_sum(list_transform(found[:k - 1], lambda x: len(x))), 0) AS b,
           len(found[k]) AS size FROM (SELECT *, unnest(range(1, len(found) + 1)) AS k FROM m)
), i AS (
    SELECT DISTINCT n, label, priority, b, b + size AS e FROM p
), k AS (
    SELECT * FROM i WHERE NOT EXISTS (
        SELECT 1 FROM i o WHERE o.n = i.n AND o.b <= i.b AND o.e >= i.e AND o.priority <= i.priority
        AND (o.b, -o.e, o.priority, o.label) < (i.b, -i.e, i.priority, i.label))
), a AS (
    SELECT n, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, min(priority) AS priority
    FROM (SELECT n, label, priority FROM k UNION ALL SELECT n, label, 0 FROM b) GROUP BY n
), ba AS (
    SELECT n, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM b GROUP BY n
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(ba.labels, '') AS base_labels, coalesce(a.labels, '') AS labels,
       CAST(coalesce({strengths}[CASE WHEN n_base > 0 THEN 0 ELSE a.priority END + 1], 0) AS DOUBLE) AS score
FROM d LEFT JOIN bs USING (n) LEFT JOIN a USING (n) LEFT JOIN ba USING (n)
"""


SQL = _sql()
