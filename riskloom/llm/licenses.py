"""License scans: phrases, and an exact set-similarity join with notice templates.

DataFrame functions only. A block is a line of a text; the whole text is one
more block for templates longer than ``LINE_TOKENS`` tokens (notices that
run over lines). A block meets a template T if it holds at least
``ceil(threshold * |T|)`` of T's distinct words, the words that name the
license among them.

The join: word frequencies over all blocks of the corpus order the words
from rare to frequent. A template is indexed under its rarest
``|T| - need + 1`` words (prefix filter: any block that meets it has one of
these). A block row meets the index only under words it has; too short
blocks go (length filter), and so do pairs whose positions in the common
order leave no room for ``need`` common words (positional filter). The rest
is verified on the word sets. The template side is a fixed list, so its
vocabulary, ranks and index are small whatever the corpus is; on the corpus
side only words of that vocabulary are kept (they alone can be common).

Every template that a block meets counts, but for one whose words are all
among those of another met template with another label (cc-by under
cc-by-nc). Defined results: a null or empty text has no words, no
labels and score 0; repeated rows give a row each; an empty table none.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.frames import written

THRESHOLD = 0.8
LINE_TOKENS = 20
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Phrases and their labels.
PHRASES = {"the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


@dataclass(frozen=True)
class Template:
    label: str
    names: str  # words that a block must hold
    text: str

    def words(self) -> list[str]:
        return sorted(set(self.text.split()))


# Public license notices, lower-cased, punctuation left out.
TEMPLATES = (
    Template("mit", "mit license", "released under the mit license"),
    Template("mit", "permission charge software copyright",
             "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
             "documentation files the software to deal in the software without restriction including without limitation "
             "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
             "permit persons to whom the software is furnished to do so subject to the following conditions the above "
             "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
             "software"),
    Template("apache-2", "apache 2", "licensed under the apache license version 2 0"),
    Template("apache-2", "apache 2",
             "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
             "with the license you may obtain a copy of the license at unless required by applicable law or agreed to in "
             "writing software distributed under the license is distributed on an as is basis without warranties or "
             "conditions of any kind either express or implied"),
    Template("cc-by", "cc by", "licensed under cc by 4 0"),
    Template("cc-by", "creative commons attribution",
             "licensed under a creative commons attribution 4 0 international license"),
    Template("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    Template("cc-by-nc", "creative commons noncommercial",
             "licensed under a creative commons attribution noncommercial 4 0 international license"),
    Template("cc-by-sa", "cc by sa", "licensed under cc by sa 4 0"),
    Template("cc-by-sa", "creative commons sharealike",
             "licensed under a creative commons attribution sharealike 4 0 international license"),
    Template("cc0", "cc0 public domain", "to the public domain under cc0 1 0 universal"),
    Template("gpl-2", "gnu general public 2", "licensed under the gnu general public license version 2"),
    Template("gpl-3", "gnu general public 3", "licensed under the gnu general public license version 3"),
    Template("lgpl", "gnu lesser", "licensed under the gnu lesser general public license"),
    Template("agpl-3", "gnu affero", "licensed under the gnu affero general public license version 3"),
    Template("mpl-2", "mozilla 2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("bsd", "bsd license", "licensed under the bsd license"),
    Template("bsd", "redistribution retain disclaimer",
             "redistribution and use in source and binary forms with or without modification are permitted provided that "
             "the following conditions are met redistributions of source code must retain the above copyright notice this "
             "list of conditions and the following disclaimer"),
    Template("unlicense", "free unencumbered",
             "this is free and unencumbered software released into the public domain"),
    Template("all-rights-reserved", "rights reserved", "all rights reserved"),
)


def need(template: Template, threshold: float = THRESHOLD) -> int:
    return ceil(threshold * len(template.words()) - 1e-9)


def wider(template: Template, templates: tuple[Template, ...]) -> list[int]:
    """Numbers of the templates of another label that hold all words of this one and more."""
    return [k for k, t in enumerate(templates) if t.label != template.label and set(template.words()) < set(t.words())]


def folded(text: Column) -> Column:
    """Text (null: empty) with A-Z lower-cased."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def _spaces(text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(" "), F.lit("")))


def _phrases(spelled: Column, n_words: Column, phrases: dict[str, str]) -> dict[str, Column]:
    """Places of the phrases in a text spelled with a space on both sides of each word."""
    count, first, last, labels = [], [], [], []
    for phrase, label in phrases.items():
        words = phrase.split()
        needle = F.lit("".join(f" {w} " for w in words))
        there = F.contains(spelled, needle)
        count.append(F.when(there, ((F.char_length(spelled) - F.char_length(F.replace(spelled, needle, F.lit(""))))
                                    / F.char_length(needle)).cast("long")).otherwise(F.lit(0).cast("long")))
        before = F.substring(spelled, F.lit(1), F.instr(spelled, needle) - 1)
        first.append(F.when(there, (_spaces(before) / 2).cast("long")))
        after = F.substring_index(spelled, "".join(f" {w} " for w in words), -1)
        last.append(F.when(there, n_words - (_spaces(after) / 2).cast("long") - len(words)))
        labels.append(F.when(there, F.lit(label)))
    return {"n_base": sum(count[1:], count[0]), "first_word": F.array_min(F.array(*first)),
            "last_word": F.array_max(F.array(*last)),
            "base_set": F.array_sort(F.array_distinct(F.array_compact(F.array(*labels))))}


def _word_arrays(lines: Column) -> Column:
    return F.transform(lines, lambda line: F.regexp_extract_all(line, F.lit(WORD), F.lit(0)))


def _blocks(line_words: Column, vocabulary: list[str]) -> Column:
    """Lines with words of the vocabulary: these words, the number of all words, no whole text."""
    def block(words: Column) -> Column:
        hits = F.array_distinct(F.filter(words, lambda w: w.isin(vocabulary)))
        return F.struct(hits.alias("hits"), F.size(words).cast("long").alias("n"), F.lit(False).alias("whole"))
    return F.filter(F.transform(line_words, block), lambda b: F.size(b["hits"]) > 0)


def scan(docs: DataFrame, text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES,
         phrases: dict[str, str] = PHRASES, threshold: float = THRESHOLD) -> DataFrame:
    """The columns of docs but the text, plus a struct ``licenses``.

    Fields: n_words, n_base, first_word, last_word, base_labels, labels
    (comma-joined), score (largest containment; 1 for a phrase; else 0),
    n_blocks (blocks that meet a template).
    """
    vocabulary = sorted({w for t in templates for w in t.words()})
    kept = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != text_col.lower()] or [F.lit(1)])
    base = docs.select(F.monotonically_increasing_id().alias("rid"), kept.alias("row"),
                       _word_arrays(F.split(folded(F.col(f"`{text_col}`")), "\n")).alias("line_words"))
    base = base.withColumns({
        "n_words": F.aggregate("line_words", F.lit(0).cast("long"), lambda a, w: a + F.size(w)),
        "spelled": F.concat(F.lit(" "), F.array_join(F.flatten("line_words"), "  "), F.lit(" ")),
        "blocks": _blocks(F.col("line_words"), vocabulary)}).drop("line_words")
    parts = _phrases(F.col("spelled"), F.col("n_words"), phrases)
    base = written(base.select("rid", "row", "n_words", *[c.alias(k) for k, c in parts.items()], "blocks"), "license-blocks")

    found = _similar(base, templates, threshold)
    labels = F.array_sort(F.array_union("base_set", F.coalesce("labels", F.array().cast("array<string>"))))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("score", F.lit(0.0)))
    out = base.join(found, "rid", "left")
    plain = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c.lower() != text_col.lower()]
    return out.select(*plain, F.struct(
        "n_words", "n_base", "first_word", "last_word", F.array_join("base_set", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"), score.alias("score"),
        F.coalesce("n_blocks", F.lit(0).cast("long")).alias("n_blocks")).alias("licenses"))


def _similar(base: DataFrame, templates: tuple[Template, ...], threshold: float) -> DataFrame:
    """(rid, labels, score, n_blocks) of the documents with a block that meets a template."""
    spark = base.sparkSession
    # Global frequency order of the templates' words, over the lines of all documents.
    frequency = dict(base.select(F.explode("blocks.hits").alias("hits")).select(F.explode("hits").alias("w"))
                     .groupBy("w").count().collect())  # at most the templates' vocabulary
    order = sorted({w for t in templates for w in t.words()}, key=lambda w: (frequency.get(w, 0), w))
    rank = {w: k for k, w in enumerate(order)}
    index = []
    for number, t in enumerate(templates):
        words = sorted(t.words(), key=rank.get)
        least = need(t, threshold)
        for k, w in enumerate(words[:len(words) - least + 1]):
            index.append((w, k, number, t.label, words, least, sorted(t.names.split()), len(words) > LINE_TOKENS,
                          wider(t, templates)))
    prefixes = F.broadcast(spark.createDataFrame(
        index, "word string, i int, template int, label string, t_words array<string>, least int, "
               "names array<string>, long boolean, wider array<int>"))

    ranked = F.create_map(*[x for w, k in rank.items() for x in (F.lit(w), F.lit(k))])
    whole = F.struct(F.array_distinct(F.flatten("blocks.hits")).alias("hits"),
                     F.aggregate("blocks", F.lit(0).cast("long"), lambda a, b: a + b["n"]).alias("n"),
                     F.lit(True).alias("whole"))
    block = base.where(F.size("blocks") > 0).select("rid", F.posexplode(F.concat("blocks", F.array(whole))).alias("block", "b"))
    least = min(need(t, threshold) for t in templates)
    block = block.where((F.size("b.hits") >= least)).select(
        "rid", "block", F.col("b.n").alias("n"), F.col("b.whole").alias("whole"),
        F.array_sort(F.transform("b.hits", lambda w: F.struct(F.element_at(ranked, w).alias("r"), w.alias("w")))).alias("s"))
    token = block.select("rid", "block", "n", "whole", F.col("s.w").alias("hits"), F.posexplode("s.w").alias("j", "word"))
    pairs = token.join(prefixes, "word").where(F.col("whole") == F.col("long"))
    rest = F.least(F.size("t_words") - F.col("i"), F.size("hits") - F.col("j"))
    pairs = pairs.where((F.col("n") >= F.col("least")) & (F.least("i", "j") + rest >= F.col("least")))
    common = F.size(F.array_intersect("hits", "t_words"))
    met = (pairs.withColumn("common", common)
           .where((F.col("common") >= F.col("least")) & (F.size(F.array_except("names", "hits")) == 0))
           .withColumn("score", F.col("common") / F.size("t_words"))
           .groupBy("rid", "block").agg(F.collect_set(F.struct("template", "label", "score", "wider")).alias("all")))
    met = met.select("rid", F.filter("all", lambda x: ~F.arrays_overlap(x["wider"], "all.template")).alias("kept"))
    one = met.select("rid", F.explode("kept").alias("t")).select("rid", "t.label", "t.score")
    blocks = met.groupBy("rid").agg(F.count(F.lit(1)).alias("n_blocks"))
    return one.groupBy("rid").agg(F.collect_set("label").alias("labels"), F.max("score").alias("score")).join(blocks, "rid")
