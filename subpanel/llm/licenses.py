"""License scan by diagonal voting (operator 2), in DataFrame functions alone.

Every run of ``K`` words of every document is joined, by its hash and then
its words, to the places where it stands in the templates. A hit votes for
the diagonal document place - template place; hits of one diagonal are pieces
of one copy. Diagonals at most ``GAP`` apart are merged (a word put in or left
out moves the rest of a copy to the next diagonal), and a merged span is
verified by the template words its hits cover.

A ``phrase`` template counts where all its words stand consecutively, which is
a diagonal with every vote of the template; a ``notice`` template gives its
label where a span covers ``MIN_COVER`` of its words.

The only join has the template table (a few hundred rows, fixed) on its
broadcast side, so documents stay where they were read; what is shuffled is a
row for each document and one for each hit.

Defined results: null and empty texts have no words and no label, score 0;
each input row gives one output row, repeated rows and null ids included; an
empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 3             # words of a gram
GAP = 3           # diagonals this near belong to one span
MIN_COVER = 0.8   # part of a notice's words that a span must cover

# The phrases and the labels they stand for.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
# Sentences of well-known public license notices, as words.
NOTICES = (
    ("permission is hereby granted free of charge to any person obtaining a copy of this software "
     "and associated documentation files the software to deal in the software without restriction",
     "mit"),
    ("licensed under the apache license version 2 0", "apache-2"),
    ("you may not use this file except in compliance with the license", "apache-2"),
    ("licensed under the gnu general public license version 3", "gpl-3"),
    ("you can redistribute it and or modify it under the terms of the gnu general public license "
     "as published by the free software foundation", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("subject to the terms of the mozilla public license v 2 0", "mpl-2"),
    ("redistribution and use in source and binary forms with or without modification are permitted",
     "bsd"),
    ("permission to use copy modify and or distribute this software for any purpose with or "
     "without fee is hereby granted", "isc"),
    ("licensed under a creative commons attribution 4 0 international license", "cc-by"),
    ("creative commons attribution sharealike 4 0 international license", "cc-by-sa"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("cc0 1 0 universal public domain dedication", "cc0"),
    ("all rights reserved no part of this publication may be reproduced", "all-rights-reserved"),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text with A-Z lower-cased: runs of digits, a-z and non-ASCII characters.

    ``lower`` is much quicker than ``translate`` and treats A-Z alike; of the
    other letters it changes, the Kelvin sign alone becomes an ASCII letter.
    """
    lowered = F.when(text.contains("K"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), SEPARATORS), "")


def template_grams(spark, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """One row for each place of each template: gram, hash, template, place, words, label, kind."""
    rows, number = [], 0
    for kind, templates in (("phrase", phrases), ("notice", notices)):
        for text, label in templates:
            words = text.split()
            rows += [(" ".join(words[i:i + K]), number, i, len(words), label, kind == "phrase")
                     for i in range(len(words) - K + 1)]
            number += 1
    grams = spark.createDataFrame(
        rows, "gram string, template int, place int, n_template int, label string, phrase boolean")
    return grams.withColumn("gram_hash", F.xxhash64("gram"))


def hits(documents: DataFrame, grams: DataFrame, doc_id: str, text: str) -> DataFrame:
    """A row with null template for each document, and one for each gram that a template has."""
    words = documents.select(F.monotonically_increasing_id().alias("row"),
                             F.col(doc_id).alias("doc_id"), words_of(F.col(text)).alias("words"))
    size = F.size("words")
    gram = lambda i: F.concat_ws(
        " ", *[F.get(F.col("words"), i + F.lit(j)) for j in range(K)])
    places = F.when(size >= K, F.transform(
        F.sequence(F.lit(0), size - K), lambda i: F.struct(i.alias("at"), gram(i).alias("gram"))))
    itself = F.array(F.struct(F.lit(-1).alias("at"), F.lit(None).cast("string").alias("gram")))
    each = words.select("row", "doc_id", size.cast("long").alias("n_words"), F.explode(
        F.concat(itself, F.coalesce(places, F.slice(itself, 1, 0)))).alias("x")) \
        .select("row", "doc_id", "n_words", "x.at", "x.gram") \
        .withColumn("doc_hash", F.xxhash64("gram"))
    found = each.join(F.broadcast(grams.withColumnRenamed("gram", "template_gram")),
                      (F.col("doc_hash") == F.col("gram_hash"))
                      & (F.col("gram") == F.col("template_gram")), "left")
    return found.where("at = -1 or template is not null").select(
        "row", "doc_id", "n_words", "template", "n_template", "label", "phrase", "place",
        (F.col("at") - F.col("place")).alias("diagonal"))


def spans(documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
          phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """Merged spans: row, doc_id, n_words, template, label, phrase, exact places, first, last, cover.

    A document without any hit has one row, with a null template.
    """
    found = hits(documents, template_grams(documents.sparkSession, phrases, notices), doc_id, text)
    head = ["row", "doc_id", "n_words", "template", "n_template", "label", "phrase"]
    votes = found.repartition("row").groupBy(*head, "diagonal").agg(
        F.count("place").alias("votes"), F.collect_set("place").alias("places"))
    exact = F.col("votes") == F.col("n_template") - (K - 1)
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    opens = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > GAP, F.lit(True))
    merged = votes.withColumn("opens", opens.cast("int")) \
        .withColumn("span", F.sum("opens").over(along)) \
        .groupBy(*head, "span").agg(
            F.count_if(exact).alias("exact"),
            F.min(F.when(exact, F.col("diagonal"))).alias("first"),
            F.max(F.when(exact, F.col("diagonal"))).alias("last"),
            F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"))
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        "places", lambda p: F.sequence(p, p + F.lit(K - 1))))))
    return merged.withColumn("cover", covered / F.col("n_template")).drop("places")


def scan(documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
         phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """One row per document: n_words, base places and labels, all labels, score."""
    found = spans(documents, doc_id, text, phrases, notices)
    base = F.col("phrase") & (F.col("exact") > 0)
    notice = ~F.col("phrase") & (F.col("cover") >= MIN_COVER)
    label_list = lambda which: F.array_join(
        F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",")
    return found.groupBy("row", "doc_id", "n_words").agg(
        F.coalesce(F.sum(F.when(F.col("phrase"), F.col("exact"))), F.lit(0)).cast("long").alias("n_base"),
        F.min(F.when(F.col("phrase"), F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(F.col("phrase"), F.col("last"))).cast("long").alias("last_word"),
        label_list(base).alias("base_labels"), label_list(base | notice).alias("labels"),
        F.round(F.coalesce(F.max(F.when(base, F.lit(1.0)).when(notice, F.col("cover"))), F.lit(0.0)), 9)
        .alias("score")).drop("row")


def oracle(phrases=PHRASES, notices=NOTICES) -> str:
    """The same rows in DuckDB SQL."""
    templates = ", ".join(
        f"({i}, '{text}', '{label}', {kind})"
        for i, (text, label, kind) in enumerate(
            [(*x, "true") for x in phrases] + [(*x, "false") for x in notices]))
    return f"""
with t(template, words, label, phrase) as (
  select template, string_split(words, ' '), label, phrase
  from (values {templates}) v(template, words, label, phrase)),
g as (select template, label, phrase, len(words) as n_template, i as place,
        array_to_string(words[i + 1:i + {K}], ' ') as gram
      from (select *, unnest(range(len(words) - {K - 1})) as i from t)),
d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as words from documents),
e as (select doc_id, i as spot, array_to_string(words[i + 1:i + {K}], ' ') as gram
      from (select doc_id, words, unnest(range(greatest(len(words) - {K - 1}, 0))) as i from d)),
h as (select doc_id, template, label, phrase, n_template, place, spot - place as diagonal
      from e join g using (gram)),
v as (select doc_id, template, label, phrase, n_template, diagonal, count(*) as votes
      from h group by all),
o as (select *, case when diagonal - lag(diagonal) over w <= {GAP} then 0 else 1 end as opens
      from v window w as (partition by doc_id, template order by diagonal)),
m as (select *, sum(opens) over (partition by doc_id, template order by diagonal) as span from o),
c as (select doc_id, template, span, count(distinct word) as covered
      from (select doc_id, template, span, unnest([place, place + 1, place + 2]) as word
            from h join m using (doc_id, template, diagonal)) group by all),
s as (select doc_id, template, label, phrase, span,
        count(*) filter (votes = n_template - {K - 1}) as exact,
        min(diagonal) filter (votes = n_template - {K - 1}) as first,
        max(diagonal) filter (votes = n_template - {K - 1}) as last,
        any_value(covered) / any_value(n_template) as cover
      from m join c using (doc_id, template, span) group by all),
r as (select doc_id, sum(exact) filter (phrase) as n_base, min(first) filter (phrase) as first_word,
        max(last) filter (phrase) as last_word,
        string_agg(distinct label, ',' order by label) filter (phrase and exact > 0) as base_labels,
        string_agg(distinct label, ',' order by label)
          filter ((phrase and exact > 0) or (not phrase and cover >= {MIN_COVER})) as labels,
        max(case when phrase and exact > 0 then 1.0
                 when not phrase and cover >= {MIN_COVER} then cover end) as score
      from s group by doc_id)
select d.doc_id, len(d.words)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base,
  first_word::bigint as first_word, last_word::bigint as last_word,
  coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels,
  round(coalesce(score, 0.0), 9)::double as score
from d left join r on r.doc_id = d.doc_id"""
