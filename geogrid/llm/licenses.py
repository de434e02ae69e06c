"""License scans by a positional rare-token index, on DataFrame functions alone.

Templates (short license texts) are indexed by token, with positions. Tokens that agree on one offset
(file position - template position) tell that a template's words stand in the file in the template's
order; a template is reported if enough of its indexed tokens agree and the file holds its key phrases.
Of each template the words of highest IDF are looked up, with the document frequencies counted over
all documents: just so many that no offset with enough agreeing tokens is without one of them. Every
occurrence of them in the file names an offset, and each offset is counted with all indexed tokens.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words: ASCII letters and digits and everything beyond ASCII, of the text with A-Z in lower case.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases that are labels by themselves.
PHRASES = {"mit": ("mit", "license"), "apache": ("apache", "license"), "gpl": ("general", "public", "license")}
#: Characteristic passages of public license texts, with phrases a file must hold.
TEMPLATES = {
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software",
        ("permission is hereby granted free of charge", "without restriction"),
    ),
    "apache": (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0",
        ("licensed under the apache license", "in compliance with the license"),
    ),
    "gpl": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
        ("terms of the gnu general public license", "free software foundation"),
    ),
    "gpl-notice": ("this work is licensed under the gnu general public license version 3", ("licensed under the gnu general public license",)),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
        ("redistribution and use in source and binary forms", "conditions are met"),
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
        ("permission to use copy modify", "with or without fee is hereby granted"),
    ),
    "mpl": ("this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at", ("subject to the terms of the mozilla public license",)),
    "cc-by": ("this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0 international license",)),
    "apache-notice": (
        "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
        ("distributed under the license is distributed on an as is basis",),
    ),
    "lgpl": (
        "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
        ("terms of the gnu lesser general public license",),
    ),
    "agpl": (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
        ("terms of the gnu affero general public license",),
    ),
    "bsd-notice": (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        ("to endorse or promote products derived from this software",),
    ),
    "boost": (
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software",
        ("any person or organization obtaining a copy of the software",),
    ),
    "zlib": (
        "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
        ("permission is granted to anyone to use this software for any purpose",),
    ),
    "epl": ("this program and the accompanying materials are made available under the terms of the eclipse public license", ("terms of the eclipse public license",)),
    "unlicense": (
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
        ("free and unencumbered software released into the public domain",),
    ),
    "cc0": (
        "to the extent possible under law the person who associated cc0 with this work has waived all copyright and related or neighboring rights to this work",
        ("waived all copyright and related or neighboring rights",),
    ),
    "cc-by-sa": ("this work is licensed under a creative commons attribution sharealike 4 0 international license", ("creative commons attribution sharealike",)),
    "wtfpl": (
        "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed",
        ("changing it is allowed as long as the name is changed",),
    ),
}
#: Words too common to index.
STOP = frozenset("that from above with a all an and any are as at be by can for form free from has hereby if in is it its list may met must neither no nor not of on one or own the this to under use was with without you your".split())
#: Tokens that must agree on an offset, and their share of the template's indexed tokens.
MIN_VOTES, MIN_SHARE = 3, 0.5

_TOKENS = {name: text.split() for name, (text, _) in TEMPLATES.items()}
VOCABULARY = sorted({w for words in _TOKENS.values() for w in words if w not in STOP and not w.isdigit()})
_NAMES = sorted(TEMPLATES)


def words_of(text: Column) -> Column:
    """The words of a text with only A-Z lowered; null text has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _rough_words(text: Column) -> Column:
    """Words of the fully lowered text: as many, and a superset of the licence words found."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _strings(values: list[str]) -> Column:
    return F.array(*map(F.lit, values))


def _phrase_starts(words: Column, phrase: tuple[str, ...]) -> Column:
    n = F.size(words) - (len(phrase) - 1)
    here = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(here, lambda i: _stand(words, i, phrase))


def _stand(words: Column, i: Column, phrase: tuple[str, ...]) -> Column:
    out = F.lit(True)
    for k, w in enumerate(phrase):
        out = out & (F.get(words, i + k) == w)
    return out


def document_frequencies(docs: DataFrame, text_col: str = "text") -> tuple[int, dict[str, int]]:
    """How many documents there are, and how many hold each vocabulary word: at most one row a word reaches the driver."""
    held = docs.select(F.array_intersect(_rough_words(F.col(text_col)), _strings(VOCABULARY)).alias("held"))
    counts = held.select(F.explode(F.concat(F.col("held"), F.array(F.lit("")))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    found = {r["word"]: r["n"] for r in counts.collect()}
    return found.pop("", 0), found


def _indexed(name: str) -> list[tuple[str, int]]:
    """The indexed tokens of a template with their positions."""
    return [(w, i) for i, w in enumerate(_TOKENS[name]) if w in VOCABULARY]


def _rarest(name: str, idf: dict[str, float]) -> dict[str, list[int]]:
    """Positions of the rarest words of a template; fewer tokens than must agree are left over."""
    at: dict[str, list[int]] = {}
    for w, i in _indexed(name):
        at.setdefault(w, []).append(i)
    size = sum(map(len, at.values()))
    need = max(MIN_VOTES, math.ceil(MIN_SHARE * size))
    out: dict[str, list[int]] = {}
    for w in sorted(at, key=lambda w: (-idf[w], w)):
        if sum(map(len, out.values())) > size - need:
            break
        out[w] = at[w]
    return out


def _agreement(words: Column, name: str, idf: dict[str, float]) -> Column:
    """The largest count of a template's indexed tokens that stand at one offset; 0 if too few can agree."""
    tokens = _indexed(name)
    none = F.array().cast("array<int>")
    index = F.create_map(*[x for w, at in _rarest(name, idf).items() for x in (F.lit(w), F.array(*map(F.lit, at)))])
    named = F.transform(words, lambda w, i: F.transform(F.coalesce(F.try_element_at(index, w), none), lambda p: i - p))
    postings = F.array(*[F.struct(F.lit(w).alias("word"), F.lit(i).alias("at")) for w, i in tokens])
    counts = F.transform(F.array_distinct(F.flatten(named)), lambda o: F.size(F.filter(postings, lambda p: F.get(words, o + p["at"]) == p["word"])))
    return F.coalesce(F.array_max(counts), F.lit(0))


def scan(docs: DataFrame, frequencies: tuple[int, dict[str, int]], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_words``, ``starts`` (positions of the phrases), ``base_labels``, ``labels`` and ``score``.

    ``score`` is the largest share of agreeing tokens among the reported templates, at least 0.5 if a
    phrase stands in the text. Null and empty texts have no words, no labels and score 0; repeated rows
    give repeated rows; other columns are not read.
    """
    n, df = frequencies
    idf = {w: math.log((n + 1) / (df.get(w, 0) + 1)) for w in VOCABULARY}
    rough = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), _rough_words(F.col(text_col)).alias("rough"))
    held = F.arrays_overlap("rough", _strings(VOCABULARY))
    none = F.array().cast("array<string>")
    rows = rough.select("id", F.size("rough").cast("long").alias("n_words"), F.when(held, words_of(F.col("text"))).otherwise(none).alias("words"))
    some = F.size("words") > 0
    joined = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    reported = []
    for name in _NAMES:
        keys = F.lit(True)
        for phrase in TEMPLATES[name][1]:
            keys = keys & F.contains(joined, F.lit(f" {phrase} "))
        agree = F.when(keys, _agreement(F.col("words"), name, idf))
        share = F.when(agree >= MIN_VOTES, agree / F.lit(float(len(_indexed(name)))))
        reported.append(F.struct(F.lit(re.sub("-notice$", "", name)).alias("label"), share.alias("share")))
    rows = rows.withColumn("reported", F.when(some, F.filter(F.array(*reported), lambda r: r["share"] >= MIN_SHARE)))
    for label, phrase in PHRASES.items():
        rows = rows.withColumn(f"at_{label}", F.when(some, _phrase_starts(F.col("words"), phrase)).otherwise(F.array().cast("array<int>")))
    starts = F.concat(*[F.col(f"at_{x}") for x in PHRASES])
    base = F.filter(F.array(*[F.when(F.size(f"at_{x}") > 0, F.lit(x)) for x in PHRASES]), lambda x: x.isNotNull())
    more = F.coalesce(F.transform("reported", lambda r: r["label"]), none)
    phrase_score = F.when(F.size("starts") > 0, 0.5).otherwise(0.0)
    rows = rows.withColumn("starts", starts).withColumn("base", F.array_sort(base))
    return rows.select(
        F.col("id").alias(id_col),
        "n_words",
        "starts",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat("base", more))), ",").alias("labels"),
        F.greatest(phrase_score, F.coalesce(F.array_max(F.transform("reported", lambda r: r["share"])), F.lit(0.0))).alias("score"),
    )
