"""Operator 8: licence scans by ordered signature rules.

Several hundred signature patterns, written by hand (``ABBREVIATIONS``, ``TEXTS``) or spelled out from
licence families and phrasings, are matched on the words of a text (A-Z lower-cased, joined by single
spaces).  A keyword prefilter gates them twice: a text without any keyword runs
no pattern at all, and a rule's pattern runs only where its keyword stands.  The
pattern of a rule matches nothing without its keyword, so no detection is lost.
Detections that another detection of the same or a higher priority contains are
suppressed; the labels of the rest are reported beside those of the base phrases.

* A null or empty text has no words, no labels (empty strings), null first and
  last word and score 0.  Every input row gives one row; ties (two rules that
  match the same words) go to the higher priority and, at equal priority, to the
  label that sorts first.  Extra columns are ignored.
* ``score`` is the confidence of the best remaining detection (its priority as a
  share of the highest), at least 0.8 where a base phrase stands.
* Everything is work inside the row; nothing is shuffled.  Suppression is one
  sweep over the sorted detections, not a comparison of pairs.  Arrays grow in pieces of ``PIECE``, so
  that a text with 100,000 detections does not copy them over and over.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, read

#: Fixed values of the base contract: phrase, label.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
WORD_ANY_CASE, WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: What stands between two words.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"

#: family keyword (part of every match of the name; a space at an end is a word's end), label, name pattern,
#: versions ('' = unversioned)
FAMILIES = [
    ("apache", "apache", "apache", ["1 0", "1 1", "2 0"]),
    (" mit ", "mit", "mit", [""]),
    (" expat ", "mit", "expat", [""]),
    (" x11 ", "mit", "x11", [""]),
    ("affero general public", "agpl", "(?:gnu )?affero general public", ["1", "3", "3 0"]),
    ("lesser general public", "lgpl", "(?:gnu )?lesser general public", ["2", "2 0", "2 1", "3", "3 0"]),
    ("library general public", "lgpl", "(?:gnu )?library general public", ["2", "2 0", "2 1", "3", "3 0"]),
    ("general public", "gpl", "(?:gnu )?general public", ["1", "2", "2 0", "3", "3 0"]),
    ("free documentation", "gfdl", "(?:gnu )?free documentation", ["1 1", "1 2", "1 3"]),
    ("mozilla public", "mpl", "mozilla public", ["1 0", "1 1", "2 0"]),
    ("eclipse public", "epl", "eclipse public", ["1 0", "2 0"]),
    (" bsd ", "bsd", "bsd(?: style)?", ["2 clause", "3 clause", "4 clause", "0 clause"]),
    (" isc ", "isc", "isc", [""]),
    ("boost software", "bsl", "boost software", ["1 0"]),
    (" artistic ", "artistic", "artistic", ["1 0", "2 0"]),
    ("zlib", "zlib", "zlib(?: libpng)?", [""]),
    ("unlicense", "unlicense", "unlicense", [""]),
    ("python software foundation", "psf", "python software foundation", ["2", "2 0"]),
    ("academic free", "afl", "academic free", ["2 0", "2 1", "3 0"]),
    ("open software", "osl", "open software", ["2 0", "2 1", "3 0"]),
    ("common development", "cddl", "common development and distribution", ["1 0", "1 1"]),
    ("european union public", "eupl", "european union public", ["1 0", "1 1", "1 2"]),
    ("open database", "odbl", "open database", ["1 0"]),
    ("microsoft public", "ms-pl", "microsoft public", [""]),
    ("do what the fuck", "wtfpl", "do what the fuck you want to public", ["2"]),
    ("open font", "ofl", "(?:sil )?open font", ["1 0", "1 1"]),
]
#: Phrasings around a name N and version V: (priority, pattern).
TEMPLATES = [
    (2, "{n} licen[cs]e"),
    (3, "(?:licen[cs]ed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?{n} licen[cs]e"),
    (2, "spdx license identifier {n}"),
]
VERSIONED = [
    (4, "{n} licen[cs]e (?:version |v)?{v}"),
    (5, "(?:licen[cs]ed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?"
        "{n} licen[cs]e (?:version |v)?{v}"),
    (3, "{n} (?:version |v)?{v}"),
]
#: Creative Commons marks: letters, versions.
CC_MARKS = ["by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd"]
CC_VERSIONS = ["1 0", "2 0", "2 5", "3 0", "4 0"]
#: Phrases of licence texts: keyword, label, priority, pattern.
TEXTS = [
    ("hereby granted", "mit", 4, "permission is hereby granted free of charge to any person obtaining a copy"),
    ("redistribut", "bsd", 4, "redistribution and use in source and binary forms with or without modification"),
    ("rights reserved", "copyright", 1, "all rights reserved"),
    ("copyright", "copyright", 1, "copyright (?:c )?[0-9]{4}"),
    ("copyright", "copyright", 2, "copyright (?:c )?[0-9]{4} [^ ]+ all rights reserved"),
    ("public domain", "public-domain", 3, "(?:released|dedicated|placed|is) (?:in|into|to) the public domain"),
    (" cc0 ", "cc0", 3, "cc0(?: 1 0)?(?: universal)?"),
    ("creative commons", "cc", 2, "creative commons"),
    ("warrant", "warranty", 1, "without warranty of any kind"),
    ("without fee", "isc", 4, "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee "
                              "is hereby granted"),
    ("provided as is", "zlib", 4, "this software is provided as is without any express or implied warranty"),
    ("apache org licenses", "apache-2.0", 5, "apache org licenses license 2 0"),
    ("free and unencumbered", "unlicense", 4, "this is free and unencumbered software released into the public domain"),
    ("boost software", "bsl-1.0", 5, "distributed under the boost software license version 1 0"),
    ("general public license", "gpl-2", 5, "general public license (?:as published by the free software foundation )?either version 2"),
    ("general public license", "gpl-3", 5, "general public license (?:as published by the free software foundation )?either version 3"),
    ("lesser general public license", "lgpl-2.1", 6, "lesser general public license (?:as published by the free software foundation )?"
                                                     "either version 2 1"),
    ("lesser general public license", "lgpl-3", 6, "lesser general public license (?:as published by the free software foundation )?"
                                                   "either version 3"),
    ("affero general public license", "agpl-3", 6, "affero general public license (?:as published by the free software foundation )?"
                                                   "(?:either )?version 3"),
    ("gnu org licenses", "gpl", 2, "gnu org licenses"),
    ("opensource org licenses", "mit", 4, "opensource org licenses mit"),
    ("opensource org licenses", "bsd-3", 4, "opensource org licenses bsd 3 clause"),
]
#: Short names as people and package files write them: keyword, label, priority, pattern.
ABBREVIATIONS = [
    ("gpl", "gpl", 2, "(?:gnu )?gpl"),
    ("gpl", "gpl-1", 4, "(?:gnu )?gpl (?:version |v )?1(?: 0)?(?: only| or (?:any )?later(?: version)?)?"),
    ("gpl", "gpl-2", 4, "(?:gnu )?gpl (?:version |v )?2(?: 0)?(?: only| or (?:any )?later(?: version)?)?"),
    ("gpl", "gpl-3", 4, "(?:gnu )?gpl (?:version |v )?3(?: 0)?(?: only| or (?:any )?later(?: version)?)?"),
    ("gplv2", "gpl-2", 4, "(?:gnu )?gplv2(?: 0)?(?: only| or (?:any )?later(?: version)?)?"),
    ("gplv3", "gpl-3", 4, "(?:gnu )?gplv3(?: 0)?(?: only| or (?:any )?later(?: version)?)?"),
    ("gpl2", "gpl-2", 4, "gpl2"),
    ("gpl3", "gpl-3", 4, "gpl3"),
    ("lgpl", "lgpl", 2, "(?:gnu )?lgpl"),
    ("lgpl", "lgpl-2", 4, "(?:gnu )?lgpl (?:version |v )?2(?: 0)?(?: only| or (?:any )?later(?: version)?)?"),
    ("lgpl", "lgpl-2.1", 5, "(?:gnu )?lgpl (?:version |v )?2 1(?: only| or (?:any )?later(?: version)?)?"),
    ("lgpl", "lgpl-3", 4, "(?:gnu )?lgpl (?:version |v )?3(?: 0)?(?: only| or (?:any )?later(?: version)?)?"),
    ("lgplv2", "lgpl-2.1", 5, "(?:gnu )?lgplv2 1"),
    ("lgplv3", "lgpl-3", 4, "(?:gnu )?lgplv3(?: 0)?"),
    ("agpl", "agpl", 2, "(?:gnu )?agpl"),
    ("agpl", "agpl-3", 4, "(?:gnu )?agpl (?:version |v )?3(?: 0)?(?: only| or (?:any )?later(?: version)?)?"),
    ("agplv3", "agpl-3", 4, "(?:gnu )?agplv3(?: 0)?"),
    ("gfdl", "gfdl", 2, "(?:gnu )?gfdl(?: 1 [123])?"),
    (" mpl ", "mpl-1.0", 4, "mpl (?:version |v )?1 0"),
    (" mpl ", "mpl-1.1", 4, "mpl (?:version |v )?1 1"),
    (" mpl ", "mpl-2.0", 4, "mpl (?:version |v )?2(?: 0)?"),
    ("mplv2", "mpl-2.0", 4, "mplv2(?: 0)?"),
    (" epl ", "epl-1.0", 4, "epl (?:version |v )?1(?: 0)?"),
    (" epl ", "epl-2.0", 4, "epl (?:version |v )?2(?: 0)?"),
    (" cddl ", "cddl-1.0", 4, "cddl (?:version |v )?1 0"),
    (" cddl ", "cddl-1.1", 4, "cddl (?:version |v )?1 1"),
    (" eupl ", "eupl-1.1", 4, "eupl (?:version |v )?1 1"),
    (" eupl ", "eupl-1.2", 4, "eupl (?:version |v )?1 2"),
    (" apache ", "apache-2.0", 4, "apache 2(?: 0)?"),
    (" asl ", "apache-2.0", 4, "asl (?:version |v )?2(?: 0)?"),
    (" bsd ", "bsd-2", 4, "bsd 2 clause"),
    (" bsd ", "bsd-3", 4, "(?:new|modified|revised) bsd licen[cs]e"),
    (" bsd ", "bsd-2", 4, "(?:simplified|freebsd) bsd licen[cs]e"),
    (" mit ", "mit", 3, "licen[cs]e mit"),
    (" isc ", "isc", 3, "licen[cs]e isc"),
    (" bsd ", "bsd", 3, "licen[cs]e bsd"),
    (" apache ", "apache", 3, "licen[cs]e apache"),
    (" zlib ", "zlib", 3, "licen[cs]e zlib"),
    (" unlicense ", "unlicense", 3, "licen[cs]e unlicense|the unlicense"),
    (" bsl ", "bsl-1.0", 4, "bsl 1 0"),
    (" osl ", "osl-3.0", 4, "osl 3 0"),
    (" afl ", "afl-3.0", 4, "afl 3 0"),
    (" ofl ", "ofl-1.1", 4, "ofl 1 1"),
    (" odbl ", "odbl-1.0", 4, "odbl (?:version |v )?1 0|odbl"),
    (" wtfpl ", "wtfpl", 3, "wtfpl"),
    (" psf ", "psf-2.0", 4, "psf 2 0|psf licen[cs]e"),
    (" gnu ", "gpl", 2, "gnu licen[cs]e"),
    (" upl ", "upl-1.0", 4, "upl 1 0"),
    (" cc0 ", "cc0", 4, "cc0 1 0"),
    (" 0bsd ", "bsd-0", 4, "0bsd"),
]
#: Detections that an array takes in at once.
PIECE = 256


def signature_rules() -> list[tuple[str, str, int, str]]:
    """(keyword, label, priority 1 to 6, pattern on space-joined words), built from the families and templates."""
    rules = TEXTS + ABBREVIATIONS
    for key, label, name, versions in FAMILIES:
        rules += [(key, label, p, t.format(n=name)) for p, t in TEMPLATES]
        rules += [(key, f"{label}-{v.replace(' clause', '').replace(' ', '.')}", p, t.format(n=name, v=v))
                  for v in versions if v for p, t in VERSIONED]
    for mark in CC_MARKS:
        long = mark.replace("by", "attribution").replace("sa", "share ?alike").replace("nd", "no ?deriv[a-z]*") \
            .replace("nc", "non ?commercial")
        rules += [(" cc by ", f"cc-{mark.replace(' ', '-')}", 3, f"cc {mark}"),
                  ("creative commons", f"cc-{mark.replace(' ', '-')}", 4, f"creative commons {long}")]
        for v in CC_VERSIONS:
            label = f"cc-{mark.replace(' ', '-')}-{v.replace(' ', '.')}"
            rules += [(" cc by ", label, 5, f"cc {mark} {v}"),
                      ("creative commons", label, 6, f"creative commons {long}(?: (?:international|unported))? {v}"),
                      ("creativecommons org licenses", label, 5, f"creativecommons org licenses {mark} {v}")]
    return [(k, label, p, f"(?<= )(?:{pattern})(?= )") for k, label, p, pattern in rules]


def gate(keywords, lo):
    """Whether one of the keywords, which are parts of the word string, stands in the lower-cased text ``lo``."""
    found = F.lit(False)
    for kw in sorted(set(keywords)):
        here = F.lit(True)
        for word in sorted(kw.split(), key=len, reverse=True):
            here = here & F.contains(lo, F.lit(word))
        if " " in kw:
            start, end = f"(?:^|{GAP})" if kw[0] == " " else "", f"(?:{GAP}|$)" if kw[-1] == " " else ""
            here = here & F.rlike(lo, F.lit(start + f"{GAP}+".join(kw.split()) + end))
        found = found | here
    return found


def _spaces(expr: str) -> str:
    return f"(length({expr}) - length(replace({expr}, ' ', '')))"


def scan(docs: DataFrame, rules: list[tuple[str, str, int, str]] | None = None, doc_id: str = "doc_id",
         text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections.

    ``detections``: array of (label, priority, first_word, n_words) left after suppression.
    """
    rules = signature_rules() if rules is None else rules
    top = max(p for _, _, p, _ in rules)
    by_key: dict[str, list] = {}
    for key, label, priority, pattern in rules:
        by_key.setdefault(key, []).append((label, priority, pattern))

    def q(s):
        return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"

    table = "array(" + ", ".join(
        f"struct({q(k)} as kw, array(" + ", ".join(f"struct({q(la)} as label, {p} as prio, {q(pt)} as pat)"
                                                    for la, p, pt in rs) + ") as rs)"
        for k, rs in by_key.items()) + ")"

    d = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("tx"))
    d = d.withColumn("n_words", F.regexp_count("tx", F.lit(WORD_ANY_CASE)).cast("long")) \
        .withColumn("lo", F.lower("tx"))
    gated = gate([*by_key, *(phrase for phrase, _ in PHRASES)], F.col("lo"))
    words = F.array_join(F.regexp_extract_all(ascii_lower(F.col("tx")), F.lit(WORD), F.lit(0)), " ")
    d = d.withColumn("s", F.when(gated, F.concat(F.lit(" "), words, F.lit(" ")))).drop("lo", "tx")
    # base phrases: the pieces around a phrase give its places
    for i, (phrase, _) in enumerate(PHRASES):
        d = d.withColumn(f"b{i}", F.when(F.contains("s", F.lit(f" {phrase} ")),
                                         F.split("s", f"(?<= ){phrase}(?= )", -1)))
    n = len(PHRASES)
    n_base = " + ".join(f"coalesce(size(b{i}) - 1, 0)" for i in range(n))
    first = "least(" + ", ".join(f"{_spaces(f'b{i}[0]')} - 1" for i in range(n)) + ")"
    last = "greatest(" + ", ".join(
        f"n_words - {len(phrase.split())} - ({_spaces(f'element_at(b{i}, -1)')} - 1)"
        for i, (phrase, _) in enumerate(PHRASES)) + ")"
    held = "array_compact(array(" + ", ".join(
        f"if(b{i} is null, null, {q(label)})" for i, (_, label) in enumerate(PHRASES)) + "))"
    d = d.select("doc_id", "n_words", "s", F.expr(f"bigint({n_base})").alias("n_base"),
                 F.expr(f"bigint({first})").alias("first_word"), F.expr(f"bigint({last})").alias("last_word"),
                 F.expr(f"array_sort(array_distinct({held}))").alias("base"))
    # signatures whose keyword stands in the text, then those that match, with their places (start, length in characters)
    d = d.withColumn("r", F.expr(f"if(s is null, null, flatten(transform(filter({table}, k -> contains(s, k.kw)), k -> k.rs)))"))
    d = d.withColumn("m", F.expr(
        "filter(transform(r, x -> struct(x.label, x.prio, split(s, x.pat, -1) as gaps, "
        "regexp_extract_all(s, x.pat, 0) as hits)), x -> size(x.hits) > 0)")).drop("r")
    spot = "struct<a:int,b:int,prio:int,label:string,w:int,n:int>"
    # lengths and words of each gap and the hit after it; places are sums over the pieces before, then within the piece
    parts = (f"transform(sequence(1, size(x.hits)), i -> struct(length(get(x.gaps, i - 1)) as g, length(get(x.hits, i - 1)) as h, "
             f"{_spaces('get(x.gaps, i - 1)')} as gw, {_spaces('get(x.hits, i - 1)')} as hw))")
    d = d.withColumn("m", F.expr(f"transform(m, x -> struct(x.label, x.prio, {parts} as parts))"))
    pieces = f"transform(sequence(0, (size({{0}}) - 1) div {PIECE}), k -> slice({{0}}, k * {PIECE} + 1, {PIECE}))"
    d = d.withColumn("m", F.expr(f"transform(m, x -> struct(x.label, x.prio, {pieces.format('x.parts')} as pieces))"))
    begins = ("aggregate(x.pieces, struct(0 as at, 0 as w, cast(array() as array<struct<at:int,w:int>>) as got), (t, piece) -> struct("
              "t.at + aggregate(piece, 0, (v, e) -> v + e.g + e.h) as at, t.w + aggregate(piece, 0, (v, e) -> v + e.gw + e.hw) as w, "
              "concat(t.got, array(struct(t.at, t.w))) as got)).got")
    d = d.withColumn("m", F.expr(f"transform(m, x -> struct(x.label, x.prio, zip_with(x.pieces, {begins}, (p, b) -> struct(p as piece, b as begins)) as z))"))
    place = (f"flatten(transform(x.z, y -> aggregate(y.piece, struct(y.begins.at as at, y.begins.w as w, cast(array() as array<{spot}>) "
             "as got), (t, e) -> struct(t.at + e.g + e.h as at, t.w + e.gw + e.hw as w, concat(t.got, array(struct(t.at + e.g as a, "
             "t.at + e.g + e.h as b, x.prio as prio, x.label as label, t.w + e.gw as w, e.hw + 1 as n))) as got)).got))")
    # in order of start, longest first, then priority, then label
    d = d.withColumn("z", F.expr(
        f"transform(array_sort(transform(flatten(transform(m, x -> {place})), e -> struct(e.a, -e.b as nb, -e.prio as np, e.label, "
        "e.w, e.n))), e -> struct(e.a, -e.nb as b, -e.np as prio, e.label, e.w, e.n))")).drop("m")
    # whatever contains a detection stands before it; reach[p] is how far detections of priority p or more
    # have come, and one inside the reach of its own priority is suppressed
    swept = (f"aggregate(piece, struct(t.reach as reach, cast(array() as array<{spot}>) as got), (u, e) -> if(get(u.reach, e.prio) >= e.b, "
             "u, struct(transform(u.reach, (v, p) -> if(p <= e.prio, greatest(v, e.b), v)) as reach, concat(u.got, array(e)) as got)))")
    d = d.withColumn("kept", F.expr(
        f"if(z is null or size(z) = 0, cast(array() as array<{spot}>), flatten(aggregate({pieces.format('z')}, "
        f"struct(array_repeat(0, {top + 1}) as reach, cast(array() as array<array<{spot}>>) as got), (t, piece) -> "
        f"transform(array({swept}), r -> struct(r.reach as reach, concat(t.got, array(r.got)) as got))[0]).got))")).drop("z")
    return d.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.expr("array_join(array_sort(array_distinct(concat(base, coalesce(transform(kept, e -> e.label), "
               "cast(array() as array<string>))))), ',')").alias("labels"),
        F.expr(f"greatest(if(n_base > 0, 0.8D, 0D), double(coalesce(array_max(transform(kept, e -> e.prio)), 0)) / {top})")
        .alias("score"),
        F.expr("transform(kept, e -> struct(e.label as label, e.prio as priority, e.w - 1 as first_word, e.n as n_words))")
        .alias("detections"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
