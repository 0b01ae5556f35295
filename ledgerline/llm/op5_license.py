"""Licence scan by a trained paragraph classifier, in DataFrame operations only.

1. Texts are cut into paragraphs at line feeds, and long lines at sentence
   ends, so a notice inside running text is a paragraph of its own.
2. Sparse word 1- and 2-gram counts (hashed) feed a multinomial logistic
   regression over the families, ``none`` and ``unknown`` (licence wording of no
   known family).  It is trained on the family templates below, alone and
   inside sampled corpus words, and on sampled corpus paragraphs as ``none``.
   The sample is bounded by ``SAMPLE`` paragraphs; everything is scored.
3. Calibration: half of the training rows are kept out of the fit; a family's
   limit is the ``QUANTILE`` quantile of its probability over its kept-out rows.
4. A paragraph whose likeliest class is a family counts for it if the
   probability reaches the limit and a template confirms it: at least
   ``CONFIRM`` of the template's word pairs occur in the paragraph.  Licence-like
   paragraphs that fail either test are ``unknown``.

Edge cases: null, empty and licence-free texts give ``none``; rows that repeat a
doc_id count together; null doc_ids count together under a null doc_id; ties
between families go to the first by name; an empty table gives no row; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_written, need, prepare, written

SAMPLE = 4000
COPIES = 24
#: Hashed words and word pairs; small, as prediction steps through every column of the sparse coefficients.
FEATURES = 1 << 11
QUANTILE = 0.01
CONFIRM = 0.6
#: Probability of any licence class from which a paragraph is licence-like.
LIKE = 0.5
#: Words of a line beyond which it is cut at sentence ends.
LONG = 40

# Wording of licence notices by family.
TEMPLATES = {
    "agpl": ["licensed under the gnu affero general public license"],
    "apache-2.0": ["licensed under the apache license version 2.0",
                   "you may obtain a copy of the license at http www.apache.org licenses license-2.0"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted",
            "released under the bsd license"],
    "cc-by": ["licensed under a creative commons attribution 4.0 international license", "licensed under cc by 4.0"],
    "cc-by-nc": ["licensed under a creative commons attribution noncommercial 4.0 international license",
                 "licensed under cc by-nc 4.0"],
    "cc-by-sa": ["licensed under a creative commons attribution sharealike 4.0 international license",
                 "licensed under cc by-sa 4.0"],
    "cc0": ["to the extent possible under law the author has waived all copyright", "released under cc0 1.0 public domain"],
    "gpl": ["licensed under the gnu general public license version 3",
            "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"],
    "lgpl": ["licensed under the gnu lesser general public license"],
    "mit": ["released under the mit license", "licensed under the mit license",
            "permission is hereby granted free of charge to any person obtaining a copy of this software"],
    "mpl": ["subject to the terms of the mozilla public license v 2.0"],
    "proprietary": ["all rights reserved"],
    "unknown": ["licensed under the terms of the license agreement", "use is subject to license terms",
                "released under the company license", "distributed under a custom license version 1",
                "this work is licensed under the following license"],
}
NONE = "none"
CLASSES = [NONE, *sorted(TEMPLATES)]


def paragraphs(text: Column) -> Column:
    """Lines, long ones cut at sentence ends."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.filter(F.flatten(F.transform(lines, lambda x: F.when(
        F.size(F.split(x, " ")) > LONG, F.split(x, r"(?<=[.;!?]) +")).otherwise(F.array(x)))), lambda x: F.length(x) > 0)


def words(paragraph: Column) -> Column:
    return F.filter(F.split(F.lower(paragraph), r"[^\p{L}\p{N}.\-]+|\.(?=[^\p{N}]|$)"), lambda w: F.length(w) > 0)


def pairs(w: Column) -> Column:
    return F.when(F.size(w) < 2, F.array()).otherwise(
        F.array_distinct(F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))),
                                    F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(0))),
                                    lambda a, b: F.concat_ws(" ", a, b))))


def shares(own: Column) -> dict[str, list[Column]]:
    """By family, the share of each template's word pairs among the pairs ``own``."""
    out = {}
    for name, texts in TEMPLATES.items():
        grams = [sorted({f"{a} {b}" for a, b in zip(t.split(), t.split()[1:])}) for t in texts]
        out[name] = [F.size(F.array_intersect(own, F.array(*map(F.lit, g)))) / float(len(g)) for g in grams]
    return out


def containment(own: Column, family: Column) -> Column:
    """Largest share over the family's templates."""
    out = F.lit(0.0)
    for name, found in shares(own).items():
        out = F.when(family == name, F.greatest(*found) if len(found) > 1 else found[0]).otherwise(out)
    return out


def training_rows(docs: DataFrame) -> DataFrame:
    """words, label (index of CLASSES) and fold of the bounded training set."""
    spark = docs.sparkSession
    rows = docs.select(F.explode(paragraphs(F.col("text"))).alias("p"))
    sample = rows.orderBy(F.xxhash64("p"), "p").limit(SAMPLE).repartition(8).select(
        F.xxhash64("p").alias("h"), words(F.col("p")).alias("words"))
    # written, so that the pairs are computed once and not once per template
    sample, _ = written(sample.withColumn("pairs", pairs(F.col("words"))), "op5-sample")
    table = [(c, t.split()) for c, texts in TEMPLATES.items() for t in texts]
    known = spark.createDataFrame(
        [(CLASSES.index(c), w, i * COPIES + j) for i, (c, w) in enumerate(table) for j in range(COPIES)],
        "label int, template array<string>, slot int")
    numbered = sample.withColumn("slot", F.pmod("h", F.lit(len(table) * COPIES)).cast("int")).groupBy("slot").agg(
        F.max("words").alias("around"))
    around = F.coalesce("around", F.array())
    cut = F.pmod(F.col("slot"), F.lit(5))
    positive = known.join(numbered, "slot", "left").select(
        F.when(cut == 0, F.col("template")).when(cut <= 2, F.concat(F.slice(around, 1, 3), "template")).otherwise(
            F.concat("template", F.slice(around, 1, 4))).alias("words"),
        "label", F.pmod(F.xxhash64("slot"), F.lit(2)).alias("fold"))
    # a sampled paragraph that holds most of a template is no example of none
    similar = F.greatest(*[x for found in shares(F.col("pairs")).values() for x in found])
    negative = sample.where(similar < 0.5).select("words", F.lit(0).alias("label"), F.pmod("h", F.lit(2)).alias("fold"))
    return positive.unionByName(negative)


def fit(docs: DataFrame):
    """(model, limit per class) from the training rows; the driver holds the coefficients only."""
    rows, path = written(training_rows(docs), "op5-training")
    model = Pipeline(stages=[
        NGram(n=2, inputCol="words", outputCol="grams"),
        HashingTF(inputCol="words", outputCol="tf1", numFeatures=FEATURES, binary=True),
        HashingTF(inputCol="grams", outputCol="tf2", numFeatures=FEATURES, binary=True),
        VectorAssembler(inputCols=["tf1", "tf2"], outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol="label", family="multinomial", maxIter=30, regParam=0.002),
    ]).fit(rows.where("fold = 0"))
    kept_out = model.transform(rows.where("fold = 1 and label > 0")).select(
        "label", vector_to_array("probability")[F.col("label")].alias("p"))
    limits = {r["label"]: r["p"] for r in kept_out.groupBy("label").agg(
        F.percentile_approx("p", QUANTILE).alias("p")).collect()}
    drop_written(docs.sparkSession, path)
    return model, limits


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, license, n_paragraphs, n_confirmed, n_unknown and families (confirmed paragraphs by family)."""
    spark = docs.sparkSession
    prepare(spark)
    docs = need(docs, "doc_id", "text")
    model, limits = fit(docs)
    rows = docs.select("doc_id", F.explode_outer(paragraphs(F.col("text"))).alias("p"))
    rows = rows.select("doc_id", F.col("p").isNotNull().alias("is_paragraph"), words(F.coalesce("p", F.lit(""))).alias("words"))
    scored = model.transform(rows).select("doc_id", "is_paragraph", "words", vector_to_array("probability").alias("p"))
    family = F.element_at(F.array(*map(F.lit, CLASSES)), F.array_position(F.col("p"), F.array_max("p")).cast("int"))
    scored = scored.select("doc_id", "is_paragraph", "words", family.alias("best"), F.array_max("p").alias("top"),
                           (1 - F.col("p")[0]).alias("like"))
    limit = F.lit(1.0)
    for i, name in enumerate(CLASSES):
        if name not in (NONE, "unknown"):
            limit = F.when(F.col("best") == name, F.lit(float(min(limits.get(i, 0.5), 0.9)))).otherwise(limit)
    sure = ~F.col("best").isin(NONE, "unknown") & (F.col("top") >= limit)
    scored = scored.withColumn("pairs", F.when(F.col("is_paragraph") & sure, pairs(F.col("words"))))
    verdict = F.when(~F.col("is_paragraph") | (F.col("like") < LIKE), NONE).when(
        F.col("pairs").isNotNull() & (containment(F.col("pairs"), F.col("best")) >= CONFIRM), F.col("best")).otherwise("unknown")
    found = scored.select("doc_id", "is_paragraph", verdict.alias("verdict"))
    per = [F.sum(F.when(F.col("verdict") == c, 1).otherwise(0)).alias(f"n_{c}") for c in CLASSES[1:] if c != "unknown"]
    counted = found.groupBy("doc_id").agg(
        F.sum(F.col("is_paragraph").cast("long")).alias("n_paragraphs"),
        F.sum(F.when(F.col("verdict") == "unknown", 1).otherwise(0)).cast("long").alias("n_unknown"), *per)
    names = [c for c in CLASSES[1:] if c != "unknown"]
    families = F.filter(F.array(*[F.struct(F.col(f"`n_{c}`").cast("long").alias("n"), F.lit(c).alias("family")) for c in names]),
                        lambda x: x["n"] > 0)
    out = counted.select("doc_id", "n_paragraphs", "n_unknown", families.alias("families"))
    most = F.array_max(F.transform("families", lambda x: x["n"]))
    first = F.filter("families", lambda x: x["n"] == most)
    return out.select(
        "doc_id", F.when(F.size("families") > 0, F.element_at(first, 1)["family"]).when(
            F.col("n_unknown") > 0, "unknown").otherwise(NONE).alias("license"),
        "n_paragraphs", F.coalesce(F.aggregate("families", F.lit(0).cast("long"), lambda a, x: a + x["n"]), F.lit(0)).alias("n_confirmed"),
        "n_unknown", F.transform("families", lambda x: F.concat_ws(":", x["family"], x["n"])).alias("families"))
