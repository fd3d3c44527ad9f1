"""Cases of the second round's advice: hot contexts, triples, standard notices, long near copies, bounds."""

import math
from collections import Counter

import numpy as np
import pytest

from txnwatch.llm import license_automata, minhash, mixing, ngram_trie, toxicity

from .conftest import by_row
from .test_text_operators import near_brute


# --- 4: language model ----------------------------------------------------------------

def trie_brute(learned, texts, order):
    """Score of each text under an interpolated model of ``learned``."""
    grams = [Counter() for _ in range(3)]
    for w in learned:
        full = [None, *w, ""]
        for i in range(1, len(full)):
            for k in range(order):
                if i - k >= 0:
                    grams[k][tuple(full[i - k:i + 1])] += 1
    total, kinds = Counter(), Counter()
    for k in range(1, order):
        for g, n in grams[k].items():
            total[g[:-1]] += n
            kinds[g[:-1]] += 1
    size = sum(grams[0].values()) + len(grams[0]) + 1

    def p(g):
        if len(g) == 1:
            return (grams[0][g] + 1) / size
        low = p(g[1:])
        c = g[:-1]
        return max(grams[len(c)][g] - 0.75, 0) / total[c] + 0.75 * kinds[c] / total[c] * low if total[c] else low

    out = []
    for w in texts:
        full = [None, *w, ""]
        out.append(sum(math.log10(p(tuple(full[max(0, i - order + 1):i + 1]))) for i in range(1, len(full))))
    return out


@pytest.fixture(scope="module")
def hot_texts():
    """Every other word is the same one; a pair that stands in a third of all places; many short texts."""
    rng = np.random.default_rng(11)
    texts = [[x for w in rng.integers(0, 300, 40) for x in ("hot", f"w{w}")] for _ in range(30)]
    texts += [[x for w in rng.integers(0, 300, 30) for x in ("very", "hot", f"w{w}")] for _ in range(30)]
    texts += [[f"w{w}"] for w in rng.integers(0, 300, 200)] + [[]]
    return texts


@pytest.mark.parametrize("order", [2, 3])
def test_hot_contexts_are_split_and_score_as_whole_ones(spark, hot_texts, order):
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(hot_texts)], "doc_id long, text string")
    trie = ngram_trie.train(spark, df.repartition(5), order=order, tokens_per_shard=100)
    levels = [trie.pairs] + ([trie.triples] if order > 2 else [])
    for level in levels:
        assert level.split  # a hot context stands in several shards
        assert max(np.diff(level.first)) <= 200
    asked = hot_texts[:3] + hot_texts[30:33] + hot_texts[-3:] + [["hot", "no", "very"], ["no", "very", "hot", "w1", "hot", "hot"]]
    got = ngram_trie.score(spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(asked)],
                                                 "doc_id long, text string"), trie)
    got = [r.score for r in got.orderBy("doc_id").collect()]
    for g, want, w in zip(got, trie_brute(hot_texts, asked, order), asked, strict=True):
        assert abs(g - want) <= 3e-4 * order * (len(w) + 1)


def test_shards_grow_with_tokens_of_few_long_rows(spark):
    df = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(3000))) for i in range(3)], "doc_id long, text string")
    trie = ngram_trie.train(spark, df, tokens_per_shard=500)
    assert trie.pairs.n_shards >= 9 and max(np.diff(trie.pairs.first)) < 1000


def test_registered_scores_use_two_words_of_context(spark, tmp_path, hot_texts):
    from txnwatch.llm import queries
    rows = [(i, " ".join(w)) for i, w in enumerate(hot_texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = by_row(queries.op4_ngram_trie_scores(spark, str(tmp_path)), "doc_id", "held_out", "score")
    learned = [hot_texts[i] for i, out, _ in got if not out]
    assert 0 < len(learned) < len(got)
    want = dict(enumerate(trie_brute(learned, hot_texts, 3)))
    for i, _, score in got:
        assert abs(score - want[i]) <= 9e-4 * (len(hot_texts[i]) + 1)


# --- 5: licenses -----------------------------------------------------------------------

FSF = "as published by the Free Software Foundation; either version %s of the License, or (at your option) any later version."
NOTICES = [
    ('Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
     'documentation files (the "Software"), to deal in the Software without restriction, including', "mit"),
    ("The MIT License (MIT)\n\nCopyright (c) 2020 A. Person", "mit"),
    ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file', "apache-2"),
    ("under the Apache Software License 2.0", "apache-2"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "cc-by"),
    ("licensed under the Creative Commons Attribution 3.0 United States License", "cc-by"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "cc-by-nc"),
    ("Creative Commons Attribution Non-Commercial 3.0 Unported License", "cc-by-nc"),
    ("licensed under a Creative Commons Attribution-Share Alike 3.0 Unported License", "cc-by-sa"),
    ("licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"),
    ("licensed under a Creative Commons Attribution-NoDerivs 3.0 Unported License", "cc-by-nd"),
    ("a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", "cc-by-nc-sa"),
    ("a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License", "cc-by-nc-nd"),
    ("CC BY-SA 4.0", "cc-by-sa"), ("CC BY 4.0", "cc-by"), ("CC0 1.0 Universal", "cc0"),
    ("To the extent possible under law, A. Person has waived all copyright and related or neighboring rights to this", "cc0"),
    ("under the terms of the GNU General Public License " + FSF % 2, "gpl-2"),
    ("under the terms of the GNU General Public License " + FSF % 3, "gpl-3"),
    ("under version 2 of the GNU General Public License", "gpl-2"),
    ("under the terms of the GNU Lesser General Public License " + FSF % "2.1", "lgpl"),
    ("under the terms of the GNU Library General Public License " + FSF % 2, "lgpl"),
    ("under the terms of the GNU Affero General Public License " + FSF % 3, ""),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met:", "bsd"),
    ('under the BSD 3-Clause "New" or "Revised" License', "bsd"),
    ("subject to the terms of the Mozilla Public License, v. 2.0. If a copy", "mpl-2"),
    ("Mozilla Public License, version 1.1", ""),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("All rights reserved. No part of this book or any portion thereof may be reproduced", "proprietary"),
    ("Apache License, Version 1.1", ""), ("give Creative Commons attribution where due", ""), ("All rights reserved.", ""),
]


def test_each_notice_has_its_label_and_no_neighbours(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(NOTICES)], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in license_automata.scan_licenses(df).collect()}
    assert [(t, got[i]) for i, (t, _) in enumerate(NOTICES)] == NOTICES


# --- 2: near duplicates ------------------------------------------------------------------

def test_families_of_long_texts_are_cut_by_volume(spark):
    from pyspark.sql import functions as F
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(40):
        t = list(base)
        for j in rng.choice(400, int(rng.integers(0, 25)), replace=False):
            t[j] = f"v{rng.integers(10000)}"
        rows.append((i, " ".join(t)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = by_row(minhash.near_duplicates(df, 3, 85, volume=3000), "doc_id", "n_shingles", "component_id", "kept")
    assert got == near_brute(rows, 3, 85)
    classes = spark.createDataFrame([(bytes([i]), b"f", 1000) for i in range(60)], "cid binary, family binary, n long")
    tasks = minhash._tasks(classes, 85, 1024, 10_000).join(classes.select("cid", "n"), "cid")
    each = [r.v for r in tasks.groupBy("task").agg(F.sum("n").alias("v")).collect()]
    assert len(each) > 60 and max(each) <= 24_000


def test_sets_compared_in_hash_ranges():
    rng = np.random.default_rng(6)
    pool = rng.integers(0, 1 << 64, 500, dtype=np.uint64)
    sets = [np.unique(rng.choice(pool, 400, replace=False)) for _ in range(12)] + [np.unique(pool)]
    for left in (0, 5):
        for percent in (60, 67, 80):
            assert minhash._linked(sets, percent, left, most=100) == minhash._linked(sets, percent, left, most=1 << 30)


# --- 8: mixing ---------------------------------------------------------------------------

@pytest.mark.parametrize("rate", [3.0, 1.0, 1 - 1e-16, 3 - 4e-16, 0.0, 0.4])
def test_sources_taken_whole_spread_over_buckets(spark, rate):
    from pyspark.sql import functions as F
    rows = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), F.lit(0).cast("long").alias("text_key"),
                                    F.lit(10).cast("long").alias("size"), F.lit(1).cast("long").alias("favour"))
    rest = 20000 * (rate - math.floor(rate))
    rates = spark.createDataFrame([("a", 1, 20000, 20000 * rate, rate, rest)],
                                  "source string, favour long, source_size long, target double, rate double, rest double")
    ranked = mixing._ranked(rows, rates, 1 << 14, "mix")
    cut = mixing.cutoffs(rows, rates, 1 << 14, "mix").collect()
    sizes = {r["_bucket"]: r["count"] for r in ranked.filter("_rank IS NOT NULL").groupBy("_bucket").count().collect()}
    assert len(cut) <= 1 and all(n <= 25 for n in sizes.values())
    assert bool(sizes) == (rate % 1 > 0)


# --- 10: toxicity ------------------------------------------------------------------------

def test_training_rows_of_a_repeated_id_are_one(spark):
    docs = spark.createDataFrame([(1, "same"), (1, "same"), (1, "other"), (1, None)] * 50 + [(i, f"t{i}") for i in range(2, 30)],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 30)], "doc_id long, toxic int")
    for most in (10_000, 3):
        rows = toxicity.training_rows(docs, labels, most)
        learned = [r.y for r in rows.collect()]
        ids = labels.filter(~toxicity.held_out()).filter("doc_id is not null").count()
        assert len(learned) == min(ids, len(learned)) <= 2 * most and max(learned.count(0), learned.count(1)) <= most
