"""Licence scans by a positional index of rare words, with DataFrame functions only.

Texts are lower-cased A-Z and cut into words of letters, digits and characters beyond ASCII.
Templates are licence notices as sequences of words. A word's weight is its inverse document
frequency over the whole table, ``1 + ln((1 + documents) / (1 + documents with it))``. The index
posts, for each template, where its ``RARE`` words of the highest weight stand in it. Each file's
occurrences of posted words are looked up, and every posting proposes a place: the word's
position less its position in the template. Places on which two of the template's rare words
agree are kept; of these

* a *phrase* (the given base templates) counts where all of its words stand consecutively. Each
  such place has all its rare words in position, so none is missed;
* a *notice* counts where its key phrases stand in the words of the place, ``SLACK`` words more on
  either side, and where words that make up ``LEAST`` of its weight stand in position.

The score is the largest share of weight in position over all that counts, 0 where nothing does.

A file's words never leave its row: the counts of documents are the one shuffle, of at most one
row per licence word and task. The index is as long as the templates, which are parameters.

Null texts are empty and have no words. Rows are scanned one by one, so repeated rows agree, and
null or repeated ids do no harm. In an empty table every word has the weight 1.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass
from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, functions as F

#: Fixed value: what a word is made of, after lower-casing.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
RARE, SLACK, LEAST = 3, 2, 0.6


@dataclass(frozen=True)
class Template:
    """A notice and the phrases that it must hold; without phrases, all of it must stand there."""

    label: str
    words: tuple[str, ...]
    phrases: tuple[str, ...] = ()


def template(label: str, text: str, *phrases: str) -> Template:
    if len(set(text.split())) < RARE:
        raise ValueError(f"fewer than {RARE} different words: {text}")
    return Template(label, tuple(text.split()), phrases)


#: The base phrases and their labels.
PHRASES = (
    template("mit", "under the mit license"),
    template("apache-2", "apache license version 2"),
    template("cc-by-nc", "cc by nc"),
)

#: Notices of public licences, and the phrases that tell them apart.
NOTICES = (
    template(
        "gpl-3",
        "licensed under the gnu general public license version 3",
        "gnu general public license", "version 3",
    ),
    template(
        "gpl-2",
        "licensed under the gnu general public license version 2",
        "gnu general public license", "version 2",
    ),
    template(
        "lgpl-3",
        "licensed under the gnu lesser general public license version 3",
        "gnu lesser general public license", "version 3",
    ),
    template(
        "agpl-3",
        "licensed under the gnu affero general public license version 3",
        "gnu affero general public license", "version 3",
    ),
    template(
        "mpl-2",
        "subject to the terms of the mozilla public license v 2 0",
        "mozilla public license", "v 2 0",
    ),
    template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files",
        "hereby granted free of charge", "this software and associated documentation files",
    ),
    template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
        "source and binary forms", "following conditions are met",
    ),
    template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted",
        "with or without fee",
    ),
    template(
        "cc-by-sa-4",
        "licensed under a creative commons attribution sharealike 4 0 international license",
        "creative commons attribution sharealike 4 0",
    ),
    template(
        "cc-by-4",
        "licensed under a creative commons attribution 4 0 international license",
        "creative commons attribution 4 0",
    ),
    template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    template(
        "unlicense",
        "free and unencumbered software released into the public domain",
        "released into the public domain",
    ),
)


def words_in(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), ascii_uppercase, ascii_lowercase)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


@dataclass(frozen=True)
class Index:
    """The templates, the weight of each of their words, and the words posted for each."""

    templates: tuple[Template, ...]
    weights: dict[str, float]
    rare: tuple[tuple[str, ...], ...]


def build_index(docs: DataFrame, templates: tuple[Template, ...]) -> Index:
    """The index for a table of documents; reads all texts once for the document counts."""
    known = sorted({w for t in templates for w in t.words})
    found = F.array_intersect(words_in(F.col("text")), _texts(known))
    # the empty word stands for every document
    each = docs.select(F.explode(F.array_append(found, F.lit(""))).alias("word"))
    counts = {r.word: r["n"] for r in each.groupBy("word").agg(F.count("*").alias("n")).collect()}
    total = counts.get("", 0)
    weights = {w: 1 + math.log((1 + total) / (1 + counts.get(w, 0))) for w in known}
    rare = tuple(
        tuple(sorted(set(t.words), key=lambda w: (counts.get(w, 0), w))[:RARE]) for t in templates
    )
    return Index(templates, weights, rare)


def _texts(words) -> Column:
    return F.array(*map(F.lit, words))


def _occurrences(words: Column, posted: list[str]) -> Column:
    """(word, at) wherever a posted word stands."""
    numbered = F.transform(words, lambda w, i: F.struct(w.alias("word"), i.alias("at")))
    found = F.filter(numbered, lambda x: x["word"].isin(posted))
    none = F.array().cast("array<struct<word:string,at:int>>")
    return F.when(F.arrays_overlap(words, _texts(posted)), found).otherwise(none)


_INDEX = (
    "array<struct<label:string,base:boolean,words:array<string>,weights:array<double>,"
    "total:double,rare:array<struct<word:string,offsets:array<int>>>,phrases:array<string>>>"
)


def _index_column(index: Index, phrases: int) -> Column:
    """The index as one constant; the first templates are the phrases."""
    rows = []
    for k, (t, rare) in enumerate(zip(index.templates, index.rare, strict=True)):
        weights = [index.weights[w] for w in t.words]
        posts = [
            {"word": w, "offsets": [i for i, x in enumerate(t.words) if x == w]} for w in rare
        ]
        rows.append(
            {"label": t.label, "base": k < phrases, "words": t.words, "weights": weights,
             "total": math.fsum(weights), "rare": posts, "phrases": t.phrases}
        )
    return F.from_json(F.lit(json.dumps(rows)), _INDEX)


def _places(words: Column, seen: Column, t: Column) -> Column:
    """All places of one template of the index."""
    n = F.size(t["words"])

    def starts(k: int) -> Column:
        """Where the template would begin, by each occurrence of its rare word k."""
        post = F.element_at(t["rare"], k)
        at = F.transform(F.filter(seen, lambda x: x["word"] == post["word"]), lambda x: x["at"])
        return F.flatten(
            F.transform(post["offsets"], lambda o: F.transform(at, lambda i: i - o))
        )

    def share(start: Column) -> Column:
        here = F.arrays_zip(
            F.slice(words, start + 1, n).alias("found"),
            t["words"].alias("wanted"),
            t["weights"].alias("weight"),
        )
        in_place = F.aggregate(
            here,
            F.lit(0.0),
            lambda a, x: a + F.when(x["found"].eqNullSafe(x["wanted"]), x["weight"]).otherwise(0.0),
        )
        return F.round(in_place / t["total"], 6)

    def holds(x: Column) -> Column:
        first = F.greatest(x["start"] + 1 - SLACK, F.lit(1))
        near = F.slice(words, first, x["start"] + n + SLACK - first + 1)
        line = F.concat(F.lit(" "), F.array_join(near, " "), F.lit(" "))
        keys = F.forall(
            t["phrases"], lambda p: F.contains(line, F.concat(F.lit(" "), p, F.lit(" ")))
        )
        whole = F.slice(words, x["start"] + 1, n) == t["words"]
        return F.when(t["base"], whole).otherwise((x["share"] >= LEAST) & keys)

    pairs = [F.array_intersect(starts(i), starts(j)) for j in range(1, RARE + 1) for i in range(1, j)]
    agreed = F.filter(reduce(F.array_union, pairs), lambda s: s >= 0)
    proposed = F.transform(
        agreed,
        lambda s: F.struct(
            t["label"].alias("label"),
            t["base"].alias("base"),
            s.alias("start"),
            n.alias("words"),
            share(s).alias("share"),
        ),
    )
    return F.filter(proposed, holds)


def find_licenses(
    docs: DataFrame,
    phrases: tuple[Template, ...] = PHRASES,
    notices: tuple[Template, ...] = NOTICES,
) -> DataFrame:
    """doc_id, n_words and ``places``: (label, base, start, words, share) of all phrases and notices
    found, start in words from 0; for every row."""
    index = build_index(docs, phrases + notices)
    posted = sorted({w for words in index.rare for w in words})
    words, seen = F.col("_words"), F.col("_seen")
    every = F.transform(_index_column(index, len(phrases)), lambda t: _places(words, seen, t))
    kind = "array<struct<label:string,base:boolean,start:int,words:int,share:double>>"
    places = F.when(F.size(seen) > 0, F.flatten(every)).otherwise(F.array().cast(kind))
    return (
        docs.select("doc_id", words_in(F.col("text")).alias("_words"))
        .withColumn("_seen", _occurrences(words, posted))
        .select("doc_id", F.size(words).cast("long").alias("n_words"), places.alias("places"))
    )


def scan_report(found: DataFrame) -> DataFrame:
    """What ``find_licenses`` found, in one row of plain columns per document."""
    base = F.filter("places", lambda x: x["base"])
    names = lambda places: F.array_join(
        F.array_sort(F.array_distinct(F.transform(places, lambda x: x["label"]))), ","
    )
    starts = F.transform(base, lambda x: x["start"])
    shares = F.transform("places", lambda x: x["share"])
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        names(base).alias("base_labels"),
        names(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(shares), F.lit(0.0)).alias("score"),
    )


def _list(items) -> str:
    return "[" + ", ".join(f"'{x}'" for x in items) + "]::VARCHAR[]"


_VALUES = ",\n        ".join(
    f"({k}, '{t.label}', {str(not t.phrases).lower()}, {_list(t.words)}, {_list(t.phrases)})"
    for k, t in enumerate(PHRASES + NOTICES)
)

#: The same in DuckDB SQL, by joins of words.
SCAN_SQL = rf"""
WITH files AS (
    SELECT doc_id, row_number() OVER () AS file, regexp_extract_all(
        translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '{WORD}') AS words
    FROM documents
), templates(id, label, base, words, phrases) AS (
    VALUES {_VALUES}
), expected AS (
    SELECT id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS o FROM templates
), placed AS (
    SELECT * FROM (
        SELECT file, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS i FROM files
    ) WHERE word IN (SELECT word FROM expected)
), weights AS (
    SELECT word, count(DISTINCT file) AS n,
           1 + ln((1 + (SELECT count(*) FROM files)) / (1 + count(DISTINCT file))) AS x
    FROM (SELECT DISTINCT word FROM expected) LEFT JOIN placed USING (word) GROUP BY word
), ranked AS (
    SELECT id, word, row_number() OVER (PARTITION BY id ORDER BY n, word) AS k
    FROM (SELECT DISTINCT id, word FROM expected) JOIN weights USING (word)
), proposed AS (
    SELECT file, id, start FROM (
        SELECT DISTINCT file, id, word, i - o AS start
        FROM placed JOIN expected USING (word) JOIN ranked USING (id, word) WHERE k <= {RARE}
    ) WHERE start >= 0 GROUP BY file, id, start HAVING count(*) >= 2
), judged AS (
    SELECT file, id, start, label, base, phrases, f.words[start + 1 : start + len(t.words)] = t.words AS whole,
           ' ' || array_to_string(f.words[greatest(start + 1 - {SLACK}, 1)
                                          : start + len(t.words) + {SLACK}], ' ') || ' ' AS near,
           (SELECT round(coalesce(sum(x) FILTER (f.words[start + 1 + o] = e.word), 0) / sum(x), 6)
            FROM expected e JOIN weights USING (word) WHERE e.id = t.id) AS share
    FROM proposed JOIN files f USING (file) JOIN templates t USING (id)
), places AS (
    SELECT * FROM judged
    WHERE CASE WHEN base THEN whole ELSE share >= {LEAST}
        AND NOT EXISTS (SELECT 1 FROM (SELECT unnest(phrases) AS p)
                        WHERE NOT contains(near, ' ' || p || ' ')) END
)
SELECT doc_id, any_value(len(f.words))::BIGINT AS n_words,
       count(*) FILTER (base) AS n_base,
       min(start) FILTER (base) AS first_word,
       max(start) FILTER (base) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels,
       coalesce(max(share), 0) AS score
FROM files f LEFT JOIN places USING (file) GROUP BY file, doc_id
"""
