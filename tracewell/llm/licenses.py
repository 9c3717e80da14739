"""License scan with a positional index of rare words.

A template is the wording of a licence notice.  Of its words the few that occur in the fewest documents of the corpus
(highest IDF) are posted in an index: word -> (template, place).  A file's licence words look up their postings; a hit at
file place p and template place q votes for the template standing at p - q.  Votes that agree on a place are summed by
IDF, and where enough of the template's weight has met, the template's mandatory phrases must stand in the file.  Short
base phrases are found by themselves, whatever the index says.

Only Spark's own functions touch rows.  Texts are read once: a slim table keeps each file's counts, the places of words
that any template has (function words left out) and the phrases found.  Document frequencies are counted over all files
from that table.  The index is as large as the templates are, so it is broadcast; files are never gathered.

Weights are whole thousandths of the natural logarithm, so sums do not depend on their order.

Defined cases: a null text is the empty one, without words, places or labels and with score 0.  Each row is a file,
repeated ones too; other columns are ignored; an empty table gives no rows.  Base phrases may share no words, so all
their places count.  A template that meets at several places counts with its best.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm import common
from tracewell.llm.registry import query

NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Phrase:
    words: str
    label: str


@dataclass(frozen=True)
class Template:
    """`words` of a notice, the `label` it proves, and the phrases that must stand in a file that has it."""

    words: str
    label: str
    mandatory: tuple[str, ...]


BASE_PHRASES = (
    Phrase("gnu general public license", "gpl"),
    Phrase("apache license", "apache"),
    Phrase("cc by", "cc-by"),
    Phrase("mit license", "mit"),
)

TEMPLATES = (
    Template("this work is licensed under the gnu general public license version 3", "gpl-3.0", ("gnu general public license", "version 3")),
    Template("this work is licensed under the gnu general public license version 2", "gpl-2.0", ("gnu general public license", "version 2")),
    Template("you can redistribute it and or modify it under the terms of the gnu general public license", "gpl", ("gnu general public license",)),
    Template("gnu lesser general public license", "lgpl", ("lesser general public license",)),
    Template("licensed under the apache license version 2 0", "apache-2.0", ("apache license", "version 2 0")),
    Template("released under the mit license", "mit", ("mit license",)),
    Template("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit", ("permission is hereby granted",)),
    Template("redistribution and use in source and binary forms with or without modification are permitted", "bsd", ("redistribution and use in source",)),
    Template("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0", ("mozilla public license",)),
    Template("licensed under cc by nc 4 0", "cc-by-nc", ("cc by nc",)),
    Template("licensed under cc by sa 4 0", "cc-by-sa", ("cc by sa",)),
    Template("licensed under cc by nd 4 0", "cc-by-nd", ("cc by nd",)),
    Template("licensed under cc by 4 0", "cc-by", ("cc by 4 0",)),
    Template("licensed under a creative commons attribution 4 0 international license", "cc-by", ("creative commons attribution",)),
    Template("dedicated to the public domain under cc0 1 0 universal", "cc0", ("cc0",)),
)

FUNCTION_WORDS = frozenset("a an and any are can in is it of or the this to under with without you".split())
RARE_WORDS = 6  # posted per template
ENOUGH = 0.7  # of a template's posted weight that must meet at one place


def words_of(text: Column) -> Column:
    return F.filter(F.split(common.ascii_lower(F.coalesce(text, F.lit(""))), NO_WORD), lambda w: w != "")


def measured(docs: DataFrame, phrases: Sequence[Phrase], templates: Sequence[Template], key: str, text: str) -> DataFrame:
    """key, row_no, n_words, base (label and place of each base phrase), hits (word and place), mandatory phrases found."""
    wanted = sorted({w for t in templates for w in t.words.split()} - FUNCTION_WORDS)
    needed = sorted({p for t in templates for p in t.mandatory})
    vocabulary = F.array(*map(F.lit, wanted))
    slim = docs.select(F.col(key), F.monotonically_increasing_id().alias("row_no"), words_of(F.col(text)).alias("_w"))
    spaced = slim.withColumn("_s", F.concat(F.lit(" "), F.array_join("_w", " "), F.lit(" ")))

    def places(phrase: Phrase) -> Column:
        parts = phrase.words.split()
        starts = F.filter(F.sequence(F.lit(0), F.size("_w") - 1), lambda i: _all(F.get(F.col("_w"), i + k) == p for k, p in enumerate(parts)))
        found = F.transform(starts, lambda i: F.struct(F.lit(phrase.label).alias("label"), i.cast("long").alias("place")))
        return F.when(F.contains("_s", F.lit(f" {phrase.words} ")), found).otherwise(F.array().cast("array<struct<label:string,place:bigint>>"))

    hits = F.filter(F.transform("_w", lambda w, i: F.struct(w.alias("word"), i.cast("long").alias("place"))), lambda x: x["word"].isin(wanted))
    return spaced.select(
        key,
        "row_no",
        F.size("_w").cast("long").alias("n_words"),
        F.concat(*(places(p) for p in phrases)).alias("base"),
        F.when(F.arrays_overlap("_w", vocabulary), hits).otherwise(F.array().cast("array<struct<word:string,place:bigint>>")).alias("hits"),
        F.array_compact(F.array(*(F.when(F.contains("_s", F.lit(f" {p} ")), F.lit(p)) for p in needed))).alias("phrases"),
    )


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & F.coalesce(c, F.lit(False))
    return out


def index_of(files: DataFrame, templates: Sequence[Template], rare: int = RARE_WORDS) -> DataFrame:
    """word, template, label, mandatory, place, weight, total: the postings of each template's rarest words."""
    spark = files.sparkSession
    rows = [
        (n, t.label, list(t.mandatory), word, place)
        for n, t in enumerate(templates)
        for place, word in enumerate(t.words.split())
        if word not in FUNCTION_WORDS
    ]
    posted = spark.createDataFrame(rows, "template int, label string, mandatory array<string>, word string, place long")
    known = files.select(F.explode(F.array_distinct("hits.word")).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    weight = F.round(1000 * F.log((F.lit(files.count()) + 1) / (F.coalesce("n", F.lit(0)) + 1))).cast("long") + 1
    weighed = posted.join(F.broadcast(known), "word", "left").withColumn("weight", weight)  # `known` has the templates' words at most
    ordered = F.expr("row_number() OVER (PARTITION BY template ORDER BY weight DESC, word, place)")
    rarest = weighed.withColumn("_r", ordered).filter(F.col("_r") <= rare)
    return rarest.withColumn("total", F.expr("sum(weight) OVER (PARTITION BY template)")).drop("_r", "n")


def scan_licenses(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    phrases: Sequence[Phrase] = BASE_PHRASES,
    templates: Sequence[Template] = TEMPLATES,
    rare: int = RARE_WORDS,
    enough: float = ENOUGH,
) -> DataFrame:
    """key, row_no, n_words, base (places), proofs (template, label, place, coverage), labels (array), score."""
    files = common.stored(measured(docs, phrases, templates, key, text), "license-words")
    index = index_of(files, templates, rare)
    places = files.filter(F.size("hits") > 0).select("row_no", "phrases", F.explode("hits").alias("h"))
    votes = places.select("row_no", "phrases", F.col("h.word").alias("word"), F.col("h.place").alias("at")).join(F.broadcast(index), "word")
    # Templates have a few dozen words, so a place has a few votes at most; the sums are made before rows move.
    stands = votes.groupBy("row_no", "template", (F.col("at") - F.col("place")).alias("place")).agg(
        F.sum("weight").alias("met"),
        F.any_value("total").alias("total"),
        F.any_value("label").alias("label"),
        F.any_value(F.size(F.array_except("mandatory", "phrases")) == 0).alias("proven"),
    )
    best = stands.groupBy("row_no", "template").agg(
        F.max("met").alias("met"), F.any_value("total").alias("total"), F.any_value("label").alias("label"), F.any_value("proven").alias("proven"),
        F.min_by("place", F.struct(-F.col("met"), "place")).alias("place"),
    )
    coverage = F.round(F.col("met") / F.col("total"), 6)
    sure = F.col("proven") & (F.col("met") >= F.lit(enough) * F.col("total"))
    proof = F.struct("template", "label", "place", coverage.alias("coverage"))
    found = best.groupBy("row_no").agg(F.collect_list(F.when(sure, proof)).alias("proofs"), F.max(coverage).alias("score"))
    scanned = files.join(found, "row_no", "left")
    proofs = F.coalesce("proofs", F.array().cast(found.schema["proofs"].dataType))
    labels = F.array_sort(F.array_distinct(F.concat("base.label", F.transform(proofs, lambda p: p["label"]))))
    return scanned.select(
        key, "row_no", "n_words", "base", proofs.alias("proofs"), labels.alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score")
    )


def _sql() -> str:
    def quoted(x: str) -> str:
        return f"'{x}'"

    phrases = ", ".join(f"({quoted(p.words)}, {quoted(p.label)}, {len(p.words.split())})" for p in BASE_PHRASES)
    words = ", ".join(
        f"({n}, {quoted(t.label)}, {quoted(w)}, {i})" for n, t in enumerate(TEMPLATES) for i, w in enumerate(t.words.split()) if w not in FUNCTION_WORDS
    )
    mandatory = ", ".join(f"({n}, {quoted(p)})" for n, t in enumerate(TEMPLATES) for p in t.mandatory)
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""WITH w AS (SELECT doc_id, regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
      f AS (SELECT doc_id, w, len(w) AS n, ' ' || array_to_string(w, ' ') || ' ' AS s FROM w),
      phrase(words, label, k) AS (VALUES {phrases}),
      base AS (SELECT doc_id, label, unnest(list_filter(range(n), lambda i: array_to_string(w[i + 1:i + k], ' ') = words)) AS place
        FROM f JOIN phrase ON contains(s, ' ' || words || ' ')),
      t(template, label, word, place) AS (VALUES {words}),
      m(template, words) AS (VALUES {mandatory}),
      hit AS (SELECT doc_id, unnest(w) AS word, unnest(range(n)) AS place FROM f),
      df AS (SELECT word, count(DISTINCT doc_id) AS n FROM hit WHERE word IN (SELECT word FROM t) GROUP BY word),
      weighed AS (SELECT t.*, CAST(round(1000 * ln(((SELECT count(*) FROM f) + 1) / (coalesce(n, 0) + 1))) AS BIGINT) + 1 AS weight
        FROM t LEFT JOIN df USING (word)),
      rare AS (SELECT * FROM weighed QUALIFY row_number() OVER (PARTITION BY template ORDER BY weight DESC, word, place) <= {RARE_WORDS}),
      posted AS (SELECT *, sum(weight) OVER (PARTITION BY template) AS total FROM rare),
      stand AS (SELECT doc_id, template, any_value(label) AS label, sum(weight) AS met, any_value(total) AS total
        FROM hit JOIN posted USING (word) GROUP BY doc_id, template, hit.place - posted.place),
      best AS (SELECT doc_id, template, any_value(label) AS label, max(met) AS met, any_value(total) AS total FROM stand GROUP BY ALL),
      missing AS (SELECT DISTINCT doc_id, template FROM best JOIN m USING (template) JOIN f USING (doc_id) WHERE NOT contains(s, ' ' || words || ' ')),
      proof AS (SELECT doc_id, label FROM best ANTI JOIN missing USING (doc_id, template) WHERE met >= {ENOUGH} * total),
      b AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
        FROM base GROUP BY doc_id),
      l AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
        FROM (SELECT doc_id, label FROM base UNION ALL SELECT doc_id, label FROM proof) GROUP BY doc_id),
      c AS (SELECT doc_id, max(round(CAST(met AS DOUBLE) / CAST(total AS DOUBLE), 6)) AS score FROM best GROUP BY doc_id)
    SELECT f.doc_id, CAST(f.n AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(b.labels, '') AS base_labels,
      coalesce(l.labels, '') AS labels, coalesce(score, 0.0) AS score
    FROM f LEFT JOIN b USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN c USING (doc_id)"""


@query("op8_license_scan", _sql())
def op8_license_scan(spark, folder):
    scanned = scan_licenses(common.read(spark, folder, "documents"))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min("base.place").alias("first_word"),
        F.array_max("base.place").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("base.label")), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )
