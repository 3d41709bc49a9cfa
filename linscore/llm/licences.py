"""Licence scan: a positional index of rare words, aligned with licence templates, verified by key phrases.

DataFrame operations only. Templates are a table (``label, key_phrase, text``), as are base phrases (``label, phrase``),
which are templates that must stand in full. One scan of the documents counts in how many each word of a template
occurs, which gives the IDFs; the index is the table of the positions of every template's highest-IDF words. A second scan looks up every
word of a document that is in the index. Each meeting says where the template would begin; two words that say the same
align it, a base phrase needs its rarest word alone. A place counts if the key phrase stands in it and the
IDF-weighted share of the template's words that stand at theirs is large enough. This is known where the words are
met, so texts are never shuffled: what is grouped are places, combined before the shuffle.

Of the documents nothing passes through the driver. The words of all templates and those of the index travel to the tasks as one value each,
so that they must fit there: a matter of the templates. Their tables are broadcast if Spark finds their files small.

Defined cases: null or blank text has no words and no labels; long texts are scanned whole; repeated ids and rows give a
row each; an empty table gives an empty one; extra columns are ignored, whatever their names. A template with a null, without words, or whose
key phrase does not stand in it takes no part, and equal ones count once; without templates there are base labels only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linscore.operators.copies import repeat_rows

from .store import Store

# base phrases and their labels: fixed values
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# notices as licences' authors ask for them, with label and key phrase
TEMPLATES = (
    ("apache-2.0", "apache license version 2 0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "apache license version 2 0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl-3.0", "general public license version 3", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "gnu general public license", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("lgpl", "lesser general public license", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("agpl", "affero general public license", "it under the terms of the gnu affero general public license as published by the free software foundation"),
    ("mit", "mit license", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl-2.0", "mozilla public license v 2 0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "cc by sa", "licensed under cc by sa 4 0"),
    ("cc-by-4.0", "creative commons attribution 4 0", "this work is licensed under a creative commons attribution 4 0 international license"),
)
RARE, LEAST = 3, 0.8


def words_of(text: Column) -> Column:
    """Words of digits, a-z and everything beyond ASCII, A-Z lower-cased."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), upper, lower), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.filter(parts, lambda w: w != "")


def _literal_table(spark: SparkSession, names: tuple[str, ...], rows) -> DataFrame:
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row, strict=True)]) for row in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def notices(spark: SparkSession) -> DataFrame:
    """The templates used by default: ``label, key_phrase, text``."""
    return _literal_table(spark, ("label", "key_phrase", "text"), TEMPLATES)


def base_phrases(spark: SparkSession) -> DataFrame:
    """The base phrases: ``label, phrase``."""
    return _literal_table(spark, ("phrase", "label"), BASE.items())


def _stands(words: Column, at: Column, phrase: Column) -> Column:
    return (at >= 0) & (F.slice(words, F.greatest(at, F.lit(0)) + 1, F.size(phrase)) == phrase)


def _prepared(templates: DataFrame, phrases: DataFrame) -> DataFrame:
    """Distinct templates: ``t, label, base, words, key, key_at``, the last where the key phrase stands in the words."""
    label = F.col("label").cast("string").alias("label")
    own = templates.select(label, words_of(F.col("text").cast("string")).alias("words"), words_of(F.col("key_phrase").cast("string")).alias("key"), F.lit(False).alias("base"))
    base = phrases.select(label, words_of(F.col("phrase").cast("string")).alias("words"), words_of(F.col("phrase").cast("string")).alias("key"), F.lit(True).alias("base"))
    usable = F.col("label").isNotNull() & (F.size("key") > 0) & (F.size("words") >= F.size("key"))
    places = F.sequence(F.lit(0), F.size("words") - F.size("key"))
    key_at = F.get(F.filter(places, lambda i: _stands(F.col("words"), i, F.col("key"))), F.lit(0))
    return (
        own.unionByName(base).where(usable).distinct().withColumn("key_at", key_at).where("key_at is not null")
        .withColumn("t", F.xxhash64("label", "words", "key", "base"))
    )


def _words_in(table: DataFrame, word: Column) -> Column:
    """Distinct words of a table of templates, as one value."""
    return table.select(word.alias("word")).agg(F.collect_set("word")).scalar()


def _indexed(templates: DataFrame, counts: DataFrame) -> DataFrame:
    """Templates with their words' IDFs (``weights``), their sum, and ``rare``: the words to look up."""
    total = counts.where("word = ''").agg(F.coalesce(F.max("count"), F.lit(0))).scalar()
    idf = F.log((total + 1) / (F.coalesce("count", F.lit(0)) + 0.5))
    placed = templates.select("t", F.posexplode("words").alias("p", "word")).join(counts, "word", "left").select("t", "p", "word", idf.alias("idf"))
    # one template's own words: as many as it has
    weighed = placed.groupBy("t").agg(
        F.array_sort(F.collect_list(F.struct("p", "idf"))).getField("idf").alias("weights"),
        F.sum("idf").alias("weight"),
        F.array_sort(F.collect_set(F.struct((-F.col("idf")).alias("order"), "word"))).getField("word").alias("by_idf"),
    )
    return (
        templates.join(weighed, "t")
        .withColumn("rare", F.slice("by_idf", F.lit(1), F.when(F.col("base"), 1).otherwise(RARE))).drop("by_idf")
        .withColumn("alone", F.col("base") | (F.size(F.filter("words", lambda w: F.array_contains("rare", w))) < 2))
    )


def scanned(documents: DataFrame, templates: DataFrame | None = None, phrases: DataFrame | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``."""
    spark = documents.sparkSession
    store = Store(spark, "licences")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.md5(text).alias("print"), words_of(text).alias("words"))
    known = store.write("known", _prepared(notices(spark) if templates is None else templates, base_phrases(spark) if phrases is None else phrases))

    # the empty word, which no text has, counts the documents
    held = F.array_intersect("words", _words_in(known, F.explode("words")))
    counts = store.write("counts", texts.select(F.explode(F.array_prepend(held, F.lit(""))).alias("word")).groupBy("word").count())
    indexed = store.write("indexed", _indexed(known, counts))
    rare = indexed.select("t", "rare", F.posexplode("words").alias("p", "word")).where(F.array_contains("rare", F.col("word")))
    postings = store.write("postings", rare.select("t", "p", "word"))

    held_places = F.filter(
        F.transform("words", lambda w, i: F.struct(i.alias("i"), w.alias("word"))), lambda x: F.array_contains("held", x["word"])
    )
    none = F.array().cast("array<struct<i:int,word:string>>")
    # each document brings one row without a word, so that those without a licence stay
    itself = F.struct(F.lit(-1).alias("i"), F.lit("").alias("word"))
    looked_up = (
        texts.withColumn("held", F.array_intersect("words", _words_in(postings, F.col("word"))))
        .withColumn("places", F.when(F.size("held") > 0, held_places).otherwise(none))
        .select("doc_id", "print", F.col("words").alias("said"), F.size("words").alias("n_words"), F.inline(F.array_prepend("places", itself)))
    )
    start = F.col("i") - F.col("p")
    met = looked_up.join(postings, "word", "left").join(indexed.drop("rare"), "t", "left").withColumn("start", start)
    agree = F.transform("words", lambda w, k: F.when((F.col("start") + k >= 0) & (F.get("said", F.col("start") + k) == w), F.get("weights", k)).otherwise(0.0))
    share = F.aggregate(agree, F.lit(0.0), lambda a, x: a + x) / F.when(F.col("weight") > 0, F.col("weight")).otherwise(1.0)
    verified = F.when(_stands(F.col("said"), F.col("start") + F.col("key_at"), F.col("key")), F.least(share, F.lit(1.0)))
    keys = ["doc_id", "print", "n_words"]
    found = (
        met.select(*keys, "t", "start", "label", "base", "alone", "p", verified.alias("share"))
        .where(F.col("t").isNull() | F.col("base") & F.col("share").isNotNull() | (F.col("share") >= LEAST))
        .groupBy(*keys, "t", "start", "label", "base", "alone")
        .agg(F.count("*").alias("rows"), F.min("p").alias("low"), F.max("p").alias("high"), F.max("share").alias("share"))
        .where("t is null or alone or low < high")
    )
    base = F.when(F.col("base"), F.col("start")).cast("bigint")
    base_label = F.when(F.col("base"), F.col("label"))

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(labels)), ",")

    judged = found.groupBy(*keys).agg(
        F.max(F.when(F.col("t").isNull(), F.col("rows"))).alias("times"),
        F.count(base).alias("n_base"), F.min(base).alias("first_word"), F.max(base).alias("last_word"),
        joined(base_label).alias("base_labels"), joined(F.col("label")).alias("labels"),
        F.greatest(F.when(F.count(base) > 0, 0.9).otherwise(0.0), F.coalesce(F.max(F.when(~F.col("base"), F.col("share"))), F.lit(0.0))).alias("score"),
    ).withColumn("n_words", F.col("n_words").cast("bigint")).drop("print")
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    judged = store.write("judged", judged.select(*columns, "times"))
    return judged.where("times = 1").select(*columns).unionByName(repeat_rows(judged.where("times > 1"), "times"))
