"""License scans in DataFrame functions only: TF-IDF cosine to templates, then directory inheritance.

A text with an SPDX tag has the licence that its first tag names, with score 1. For all others, compared with every
template are, each as one sparse TF-IDF vector over words: runs of up to LINES lines
within a paragraph, runs of up to PARAGRAPHS paragraphs, a text's notices (lines that hold a word of
licensing, NOTICE) together, and the whole text. Paragraphs are parted by lines without letter or digit, so
wrapped headers and comments stay together. A line of over OVERLONG characters is cut behind sentences and at
spaces, so that a notice in a minified file is found too. Weights are inverse document frequencies counted over the
whole corpus. The template of largest cosine, LEAST at least, gives the family of the text's own licence; a reservation of
rights gives way to any licence.

Which licence of the family it is, is read from the words that tell its members apart, since their cosines differ by
little: the version beside a word such as `version`, what Creative Commons calls NC, SA and ND, `Affero` and `Lesser`,
and for BSD the clauses. A part that lacks its family's own word, or that names no version or several where the family has versions,
names no licence.

Nothing that could reach LEAST is left out: a cosine is at most the root of the template's squared weight
that falls on shared words, so what shares less than LEAST squared of every template is skipped (may_match). What stays below LEAST even where all words outside
the templates have the least weight, 1, is skipped next; frequencies of such words are counted for the rest only.

A licence file speaks for its directory: it has a name such as LICENSE or COPYING, or its first or
last line is a notice. Of several in one directory the least path counts. Files without a licence of their own take
that of the nearest ancestor directory that has one. Ancestors are looked up for distinct directories,
not for files: each directory's prefixes are joined with the licensed directories and the longest wins.

Cases: a null or empty text has no licence of its own; ties go to the template named first; a null path
is in no directory and inherits nothing; repeated rows get equal results; an empty table gives no row;
texts are scanned whole, in about linear time; columns that are added, and those named own, speaks, _id, _dir, _parts and _tag, are
replaced.
"""

from __future__ import annotations

import json
import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlight.llm.common import cut, documents
from fieldlight.llm.secrets import let

LEAST = 0.6
#: Runs of neighbouring lines and paragraphs that are compared as one; the longest template has 270 characters.
LINES, PARAGRAPHS = 8, 4
#: Reserves rights, so that it names no licence where another one stands.
RESERVED = "proprietary"
NOTICE = r"(?i)licen[sc]|copyright|copyleft|spdx|rights reserved|public domain|creative commons|warrant"
FILE_NAME = r"(?i)(^|/)(licen[sc]es?|copying|copyright|notice|unlicense)([.-][a-z0-9.-]+)?$"
#: Notices by which licences are known (fixed texts).
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction. The software is provided as is, without warranty of any kind."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: redistributions must retain the above copyright notice; the names of its contributors may not be used to endorse or promote products."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("proprietary", "All rights reserved."),
    ("proprietary", "Copyright. All rights reserved."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: redistributions must retain the above copyright notice."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("ISC", "Released under the ISC License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
)

#: Families: the word of its own that a part must hold, and whether its members have versions (fixed values).
FAMILIES = {
    "Apache": (r"apache", True),
    "MIT": (r"\bmit\b|\bpermission[^a-z0-9]+is\b", False),
    "GPL": (r"\bgnu\b|gpl|general public", True),
    "BSD": (r"\bbsd\b|redistribution", False),
    "MPL": (r"mozilla|\bmpl", True),
    "CC-BY": (r"\bcc\b|creative[^a-z0-9]+commons", True),
    "CC0": (r"\bcc0", True),
    "ISC": (r"\bisc\b|permission[^a-z0-9]+to\b", False),
    "Unlicense": (r"unlicense|unencumbered", False),
    RESERVED: (r"reserved", False),
}
#: A version: a number behind one of these words, in lower case (fixed pattern).
VERSION = r"(?:\bversion|\bv|gplv?|mpl|apache|licen[sc]e(?=[ -])|\bby|\bnc|\bsa|\bnd|attribution|commercial|sharealike|derivatives|derivs|cc0)[^a-z0-9]{0,8}([0-9]{1,2}(?:\.[0-9])?)(?![0-9])"
SPDX = r"(?i)spdx-licen[sc]e-identifier:[ \t]*\(?([a-z0-9.+-]*[a-z0-9+](?:[ \t]+(?:or|and|with)[ \t]+[a-z0-9.+-]*[a-z0-9+])*)"
#: Longer lines are cut behind sentences, and elsewhere at a space behind so many characters.
OVERLONG, CUT = 400, 60

_SPLIT = r"[^a-z0-9]+"
_BETWEEN = r"\n(?:[^A-Za-z0-9\n]*\n)+"


def words(text: str) -> list[str]:
    return [w for w in re.split(_SPLIT, text.lower()) if w]


VOCABULARY = sorted({w for _, t in TEMPLATES for w in words(t)})


def family(name: str) -> str:
    """The key of FAMILIES that a template's name belongs to."""
    if name.startswith("CC-BY"):
        return "CC-BY"
    return next(f for f in FAMILIES if f in name.split("-")[0])


def fixed(value: object, kind: str) -> Column:
    """A table of constants, as one literal that Spark folds."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def names(part: Column, text: Column) -> Column:
    """For each family, the licence that the part names if it is of that family, else null. BSD's clauses are sought in the
    whole text, since runs of lines may end before the last one."""
    whole = F.lower(text)

    def named(low: Column) -> Column:
        found = F.array_distinct(F.transform(F.regexp_extract_all(low, F.lit(VERSION), 1), lambda v: F.when(v.contains("."), v).otherwise(F.concat(v, F.lit(".0")))))
        has = lambda pattern, suffix: F.when(low.rlike(pattern), suffix).otherwise("")
        kinds = {
            "GPL": F.concat(F.when(low.rlike("affero|agpl"), "A").when(low.rlike("lesser|lgpl|library[^a-z0-9]+general"), "L").otherwise(""), F.lit("GPL")),
            "CC-BY": F.concat(F.lit("CC-BY"), has(r"\bnc\b|non[^a-z0-9]*commercial", "-NC"), has(r"\bsa\b|share[^a-z0-9]*alike", "-SA"), has(r"\bnd\b|no[^a-z0-9]*deriv", "-ND")),
            "BSD": F.when(whole.rlike("advertising|4-clause"), "BSD-4-Clause").when(whole.rlike(r"\bendorse\b|3-clause"), "BSD-3-Clause").when(whole.rlike("2-clause|redistribution"), "BSD-2-Clause"),
        }

        def each(v: Column) -> Column:
            one = F.when(F.size(v) == 1, F.get(v, F.lit(0)))
            full = lambda f, versions: F.concat_ws("-", kinds.get(f, F.lit(f)), one) if versions else kinds.get(f, F.lit(f))
            return F.array(*[F.when(low.rlike(own) & (one.isNotNull() if versions else F.lit(True)), full(f, versions)) for f, (own, versions) in FAMILIES.items()])

        return let(found, each)

    return let(F.lower(part), named)


def spdx(text: Column) -> Column:
    """The licence of the text's first SPDX tag, or null: known names as in TEMPLATES, others as written; what speaks of later versions
    is left out."""
    plain = F.regexp_replace(F.regexp_extract(text, SPDX, 1), r"(?i)(-only|-or-later|\+)(?=[ \t]|$)", "")
    known = fixed({name.lower(): name for name, _ in TEMPLATES}, "map<string,string>")
    return let(plain, lambda x: F.when(x != "", F.coalesce(F.try_element_at(known, F.lower(x)), x)))


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), _SPLIT), "")


def weights(files: DataFrame, n: int) -> dict[str, float]:
    """Inverse document frequency of each word of the vocabulary, over all n files; at most a row per word."""
    known = F.array(*map(F.lit, VOCABULARY))
    held = files.select(F.explode(F.array_intersect(known, tokens(F.coalesce("text", F.lit(""))))).alias("word"))
    counts = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return {w: math.log((1 + n) / (1 + counts.get(w, 0))) + 1 for w in VOCABULARY}


def template_vectors(idf: dict[str, float]) -> list[tuple[str, dict[str, float]]]:
    out = []
    for name, text in TEMPLATES:
        ws = words(text)
        v = {w: ws.count(w) * idf[w] for w in dict.fromkeys(ws)}
        norm = math.sqrt(sum(x * x for x in v.values()))
        out.append((name, {w: x / norm for w, x in v.items()}))
    return out


def notices(text: Column) -> Column:
    """Lines of the text with a word of licensing."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(NOTICE))
    return F.when(text.rlike(NOTICE), lines).otherwise(F.array().cast("array<string>"))


def shared(held: Column, idf: dict[str, float]) -> Column:
    """Whether the words `held` are enough of a template for a cosine of LEAST, whatever else stands beside them."""
    shares = fixed([[{"word": w, "share": x * x} for w, x in v.items()] for _, v in template_vectors(idf)], "array<array<struct<word:string,share:double>>>")
    share = lambda h: lambda t: F.aggregate(t, F.lit(0.0), lambda s, x: s + F.when(F.array_contains(h, x["word"]), x["share"]).otherwise(0.0))
    return let(held, lambda h: (F.size(h) > 0) & F.exists(shares, lambda t: share(h)(t) >= LEAST**2 - 1e-9))


def held_words(text: Column) -> Column:
    return F.array_intersect(F.array(*map(F.lit, VOCABULARY)), tokens(text))


def may_match(text: Column, idf: dict[str, float]) -> Column:
    return shared(held_words(text), idf)


def runs(pieces: Column, most: int, idf: dict[str, float]) -> Column:
    """Runs of up to `most` neighbouring pieces that may match a template. Each piece is split into words once; the largest
    share of a template that each of its words can add bounds what the runs from a piece on can reach."""
    largest: dict[str, float] = {}
    for _, v in template_vectors(idf):
        for w, x in v.items():
            largest[w] = max(largest.get(w, 0.0), x * x)
    table = fixed(largest, "map<string,double>")
    bound = lambda h: F.aggregate(h, F.lit(0.0), lambda s, w: s + F.try_element_at(table, w))

    def each(p: Column) -> Column:
        known = F.transform(p, lambda x: let(held_words(x), lambda h: F.struct(x.alias("piece"), h.alias("held"), bound(h).alias("bound"))))

        def from_(k: Column) -> Column:
            ahead = lambda i: F.aggregate(F.slice(k, i + 1, F.lit(most)), F.lit(0.0), lambda s, x: s + x["bound"])
            run = lambda i: lambda n: let(F.slice(k, i + 1, n), lambda r: F.when(shared(F.array_distinct(F.flatten(r["held"])), idf), F.array_join(r["piece"], "\n")))
            all_ = lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(most), F.size(k) - i)), run(i))
            # Runs that begin with a piece without any word of a template have a better one that begins later.
            starts = F.transform(k, lambda x, i: F.when((x["bound"] > 0) & (ahead(i) >= LEAST**2 - 1e-9), all_(i)).otherwise(F.array().cast("array<string>")))
            return F.filter(F.flatten(starts), lambda x: x.isNotNull())

        return let(known, from_)

    return let(pieces, each)


def lines_of(paragraph: Column) -> Column:
    """Its lines, overlong ones in pieces."""
    pieces = lambda x: F.split(F.regexp_replace(F.regexp_replace(x, r"([.;!?]|\*/) +", "$1\n"), rf"([^\n]{{{CUT},}}?) +", "$1\n"), "\n")
    return F.flatten(F.transform(F.split(paragraph, "\n"), lambda x: F.when(F.length(x) > OVERLONG, pieces(x)).otherwise(F.array(x))))


def parts(text: Column, idf: dict[str, float]) -> Column:
    """What of the text is compared with the templates."""

    def found(paragraphs: Column) -> Column:
        lines = F.flatten(F.transform(F.filter(paragraphs, lambda p: may_match(p, idf)), lambda p: runs(lines_of(p), LINES, idf)))
        return F.array_distinct(F.concat(lines, runs(paragraphs, PARAGRAPHS, idf), F.array(F.array_join(notices(text), "\n"), text)))

    return F.when(may_match(text, idf), let(F.split(text, _BETWEEN), found)).otherwise(F.array().cast("array<string>"))


def measured(token_array: Column, idf: dict[str, float]) -> Column:
    """(dots, known, others): products with the templates, squared weights of their words, and counts of all other words."""
    vectors = template_vectors(idf)
    table = fixed({w: {"idf": idf[w], "t": [v.get(w, 0.0) for _, v in vectors]} for w in VOCABULARY}, "map<string,struct<idf:double,t:array<double>>>")
    total = lambda a, f: F.aggregate(a, F.lit(0.0), lambda s, x: s + f(x))

    def counted(s: Column) -> Column:
        first = F.filter(F.transform(s, lambda w, i: F.when((i == 0) | (w != F.get(s, i - 1)), i)), lambda i: i.isNotNull())
        return let(first, lambda a: F.transform(a, lambda at, j: F.struct(F.get(s, at).alias("word"), (F.coalesce(F.get(a, j + 1), F.size(s)) - at).alias("n"), F.try_element_at(table, F.get(s, at)).alias("e"))))

    def sums(c: Column) -> Column:
        held = F.filter(c, lambda x: x["e"].isNotNull())
        dots = let(held, lambda h: F.transform(F.sequence(F.lit(0), F.lit(len(vectors) - 1)), lambda i: total(h, lambda x: x["n"] * x["e"]["idf"] * F.get(x["e"]["t"], i))))
        others = F.transform(F.filter(c, lambda x: x["e"].isNull()), lambda x: F.struct(x["word"].alias("word"), x["n"].alias("n")))
        return F.struct(dots.alias("dots"), total(held, lambda x: F.pow(x["n"] * x["e"]["idf"], F.lit(2.0))).alias("known"), others.alias("others"))

    return let(F.array_sort(token_array), lambda s: let(counted(s), sums))


def best(m: Column, others: Column) -> Column:
    """(firm, score, order, licence) of the best template; others: squared weights of the words that no template
    has. The licence is null if the part does not name one of that family. The score is rounded to 9 digits, so that sums in
    another order agree."""
    families = list(FAMILIES)
    of = fixed([families.index(family(name)) for name, _ in TEMPLATES], "array<int>")

    def scored(dot: Column, i: Column) -> Column:
        score = F.round(dot / F.sqrt(F.greatest(m["known"] + others, F.lit(1e-9))), 9)
        reserved = F.get(of, i) == families.index(RESERVED)
        return F.struct(((score >= LEAST) & ~reserved).alias("firm"), score.alias("score"), (-i).alias("order"), F.get(m["names"], F.get(of, i)).alias("licence"))

    return F.array_max(F.transform(m["dots"], scored))


def speaks(path: Column, text: Column) -> Column:
    body = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    edge = F.substring_index(body, "\n", 1).rlike(NOTICE) | F.substring_index(body, "\n", -1).rlike(NOTICE)
    return F.coalesce(path.rlike(FILE_NAME), F.lit(False)) | edge


def likely(files: DataFrame, idf: dict[str, float]) -> DataFrame:
    """files with _parts (measured, of those parts that reach LEAST if all other words weigh 1) and speaks (stands
    for its directory)."""
    text = F.coalesce("text", F.lit(""))
    least = lambda m: F.aggregate(m["others"], F.lit(0.0), lambda s, x: s + F.pow(x["n"].cast("double"), F.lit(2.0)))
    compared = F.when(F.col("_tag").isNull(), parts(text, idf)).otherwise(F.array().cast("array<string>"))
    each = F.transform(compared, lambda x: let(measured(tokens(x), idf), lambda m: F.struct(m["dots"].alias("dots"), m["known"].alias("known"), m["others"].alias("others"), x.alias("part"))))
    near = F.filter(each, lambda m: F.exists(m["dots"], lambda d: d >= LEAST * F.sqrt(m["known"] + least(m)) - 1e-9))
    named = F.transform(near, lambda m: F.struct(m["dots"].alias("dots"), m["known"].alias("known"), m["others"].alias("others"), names(m["part"], text).alias("names")))
    tagged = files.withColumn("_tag", spdx(text))
    return tagged.withColumn("_parts", named).withColumn("speaks", speaks(F.col("path"), text))


def own_licence(files: DataFrame, found: DataFrame, n: int) -> DataFrame:
    """_id and own (firm, score, order, licence) of the found files that reach LEAST; n: number of files."""
    each = found.select("_id", F.posexplode("_parts").alias("_at", "m"))
    others = each.select("_id", "_at", F.explode("m.others").alias("o")).select("_id", "_at", "o.word", "o.n")
    counts = files.select(F.explode(F.array_distinct(tokens(F.col("text")))).alias("word")).groupBy("word").agg(F.count("*").alias("held"))
    counts = counts.join(others.select("word").distinct(), "word")
    weight = F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("held"))) + 1
    squares = others.join(counts, "word").groupBy("_id", "_at").agg(F.sum(F.pow(F.col("n") * weight, F.lit(2.0))).alias("squares"))
    scored = each.join(squares, ["_id", "_at"], "left").select("_id", best(F.col("m"), F.coalesce("squares", F.lit(0.0))).alias("own"))
    return scored.where((F.col("own.score") >= LEAST) & F.col("own.licence").isNotNull()).groupBy("_id").agg(F.max("own").alias("own"))


def scan(files: DataFrame) -> DataFrame:
    """files: path, text and other columns (those named licence, score, origin or _dir are replaced). Adds licence,
    score, origin (own, directory or none) and licence_dir (the directory it came from)."""
    files = files.drop("licence", "score", "origin", "licence_dir", "_dir", "own", "speaks", "_id", "_parts", "_tag")
    n = files.count()
    found = likely(files, weights(files, n)).drop("text").withColumn("_id", F.monotonically_increasing_id())
    found = cut(found.withColumn("_dir", F.regexp_extract("path", r"^(.*)/[^/]*$", 1)), "likely")
    own = cut(own_licence(files, found.where(F.size("_parts") > 0), n), "own")
    tag = F.when(F.col("_tag").isNotNull(), F.struct(F.lit(True).alias("firm"), F.lit(1.0).alias("score"), F.lit(0).alias("order"), F.col("_tag").alias("licence")))
    found = found.drop("_parts").join(own, "_id", "left").withColumn("own", F.coalesce(tag, "own")).drop("_id", "_tag")
    licensed = found.where("speaks and own is not null and path is not null").groupBy(F.col("_dir").alias("up")).agg(F.min(F.struct("path", "own")).alias("file"))
    dirs = found.where("path is not null").select("_dir").distinct()
    parts = F.split("_dir", "/")
    prefixes = F.concat(F.array(F.lit("")), F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/")))
    nearest = dirs.select("_dir", F.explode(F.array_distinct(prefixes)).alias("up")).join(licensed, "up").groupBy("_dir").agg(F.max_by(F.struct("up", "file"), F.length("up")).alias("near"))
    # As a table, so that Spark knows its size: few directories are broadcast, and where they are many, a directory that
    # holds a large share of the files is split.
    out = found.join(cut(nearest, "nearest"), "_dir", "left")
    own, near = F.col("own"), F.when(F.col("path").isNotNull(), F.col("near"))
    licence = F.coalesce(own["licence"], near["file"]["own"]["licence"])
    origin = F.when(own.isNotNull(), "own").when(near.isNotNull(), "directory").otherwise("none")
    score = F.coalesce(own["score"], near["file"]["own"]["score"])
    return out.select(*[c for c in found.columns if c not in ("own", "speaks", "_dir")], licence.alias("licence"), score.alias("score"), origin.alias("origin"), F.when(own.isNull(), near["up"]).alias("licence_dir"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as files: source, then language, are their directories."""
    docs = documents(spark, sf_dir)
    path = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")), F.coalesce(F.col("doc_id").cast("string"), F.lit("none")))
    return scan(docs.select("doc_id", path.alias("path"), "text")).select("doc_id", "path", "licence", "score", "origin", "licence_dir")
