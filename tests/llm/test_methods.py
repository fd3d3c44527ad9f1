"""Unequal odds, counterfactual penalty, clashing columns, long paths."""

import hashlib
import math
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from txnwatch.llm import hnsw, mixing, toxicity, url_templates

from .test_table_operators import toxic_docs, water_fill


# --- 8: mixing -------------------------------------------------------------------------

def mix_brute(rows, weights=(5, 2, 1), cap=3.0):
    """doc_id -> copies by sorting every source (rows of unique doc_id)."""
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    of = {}
    for i, _, s in rows:
        of.setdefault(s, []).append(i)
    targets = water_fill({s: sum(size[i] for i in ids) for s, ids in of.items()}, weights, cap)
    out = {}
    for s, ids in of.items():
        fav = {i: len(bin(size[i])) - 2 for i in ids}
        low, high = 0.0, 1e9
        for _ in range(200):  # the level by halving, not by the formula
            mid = (low + high) / 2
            low, high = (mid, high) if sum(min(cap, mid * fav[i]) * size[i] for i in ids) < targets[s] else (low, mid)
        rate = {i: min(cap, high * fav[i]) for i in ids}
        whole = {i: math.floor(rate[i] + 1e-9) for i in ids}
        rest = targets[s] - sum(whole[i] * size[i] for i in ids)

        def rank(i):
            h = int(hashlib.md5(f"mix:{i}".encode()).hexdigest()[:13], 16)
            u, p = (h + 0.5) / 2 ** 52, rate[i] - whole[i]
            return u / (1 - u) / (p / (1 - p))

        upto = 0
        for i in ids:
            out[i] = whole[i]
        for i in sorted((i for i in ids if rate[i] - whole[i] > 1e-9), key=rank):
            before, upto = upto, upto + size[i]
            if upto <= rest or (before < rest and upto + before < 2 * rest):
                out[i] += 1
    return out, size, targets


def test_mixture_equals_sorted_sources(spark):
    rng = np.random.default_rng(3)
    rows = [(i, "w " * int(rng.integers(1, 2 ** rng.integers(1, 9))), f"s{min(int(rng.integers(0, 9)), 4)}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    copies, size, targets = mix_brute(rows)
    got = mixing.mixture(df).collect()
    assert {r.doc_id: r.copies for r in got} == copies
    for s in targets:
        assert abs(sum(r.taken for r in got if r.source == s) - targets[s]) <= max(size.values())


def test_long_documents_come_more_often(spark):
    rows = [(i, "w " * (2 if i % 2 else 200), "abc"[i % 3]) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixture(df).collect()

    def share(long):
        mine = [r.copies for r in got if (r.size == 200) == long and r.source == "c"]
        return sum(mine) / len(mine)

    assert 0 < 2.5 * share(False) < share(True)
    even = mixing.mixture(df, favour=F.lit(1)).filter("source = 'c'").groupBy("size").agg(F.avg("copies").alias("c"))
    low, high = sorted(r.c for r in even.collect())
    assert high - low < 0.1


# --- 10: toxicity ------------------------------------------------------------------------

def sentences_form(texts, words, group):
    """The penalty's form by swapping the terms of every sentence one by one."""
    place = {w: i for i, w in enumerate(words)}
    q, n = np.zeros((len(words), len(words))), 0
    for t in texts:
        for sentence in re.split(r"[.!?\n]", t):
            held = set(sentence.split())
            for w in sorted(held & set(words)):
                for u in words:
                    if u == w or group[place[u]] != group[place[w]] or group[place[w]] < 0:
                        continue
                    d = np.zeros(len(words))
                    d[place[w]] = 1
                    if u not in held:
                        d[place[u]] -= 1
                    q += np.outer(d, d)
                    n += 1
    return q / max(n, 1)


def test_fit_equals_plain_descent():
    rng = np.random.default_rng(1)
    n, k = 240, 9
    x = (rng.random((n, k)) < 0.3).astype(float)
    y = ((x[:, 0] * 2 + x[:, 1] - x[:, 2] + rng.normal(size=n)) > 1).astype(float)
    sw = rng.random(n) + 0.5
    words = [f"w{i}" for i in range(k)]
    group = np.array([-1, 0, 0, 1, 1, 1, -1, -1, -1])
    texts = [" ".join(np.array(words)[x[i] > 0]) + "." for i in range(n)]
    counts = {}
    for t in texts:
        held = [words.index(w) for w in t[:-1].split()]
        for a in held:
            for b in held:
                if group[a] >= 0 and group[a] == group[b]:
                    counts[a, b] = counts.get((a, b), 0) + 1
    form = toxicity.swap_form(group, counts)
    dense = np.zeros((k, k))
    np.add.at(dense, (form[0], form[1]), form[2])
    assert np.allclose(dense, sentences_form(texts, words, group))
    row, col = np.nonzero(x)
    for penalty in (0.0, 1.0):
        w, bias = toxicity._fit(row, col, y, sw, k, form, 0.005, penalty, tolerance=1e-9)
        v, p = np.zeros(k), sw / sw.sum()
        b = np.log((p * y).sum() / (1 - (p * y).sum()))
        for _ in range(60_000):
            err = p * (1 / (1 + np.exp(-(x @ v + b))) - y)
            v = v - 0.4 * (x.T @ err + 2 * penalty * dense @ v)
            v = np.sign(v) * np.maximum(np.abs(v) - 0.4 * 0.005, 0)
            b -= 0.4 * err.sum()
        assert np.abs(w - v).max() < 1e-4 and abs(bias - b) < 1e-4


def test_twice_the_steps_move_no_weight(spark):
    base = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    one, two = (toxicity.fit(docs, labels, steps=n) for n in (20_000, 40_000))
    assert np.abs(one.weights - two.weights).max() < 1e-3 and (one.weights != 0).sum() > 10


def swapped_pairs(texts):
    """(text, text with a term swapped for another of its family) for each text and term."""
    stem = toxicity.STEM
    words = {}
    for t in texts:
        for w in set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())):
            if len(w) >= stem + 2:
                words.setdefault(w[:stem], set()).add(w)
    out = []
    for t in texts:
        low = t.lower()
        for w in sorted(set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low))):
            kin = sorted(words.get(w[:stem], set()) - {w}) if len(w) >= stem + 2 else []
            out += [(low, re.sub(rf"(?<![a-z0-9\u0080-￿]){re.escape(w)}(?![a-z0-9\u0080-￿])", u, low)) for u in kin[:3]]
    return out


def test_penalty_evens_scores_of_swapped_sentences_on_given_data(spark):
    base = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    held, free = (toxicity.fit(docs, labels, penalty=x) for x in (1.0, 0.0))
    toxic = docs.join(labels.filter("toxic = 1"), "doc_id").filter(toxicity.held_out("doc_id")).select("text").collect()
    pairs = swapped_pairs([r.text[:4000] for r in toxic])
    rows = spark.createDataFrame([(i, k, t) for i, p in enumerate(pairs) for k, t in enumerate(p)], "doc_id long, k int, text string")

    def change(model):
        s = toxicity.score(rows, model).groupBy("doc_id").agg((F.max("score") - F.min("score")).alias("d"))
        return s.agg(F.avg("d")).first()[0]

    assert len(pairs) > 50 and change(held) < 0.9 * change(free)


# --- pipeline: clashing columns; 7: long paths --------------------------------------------

INTERNAL = ("_id _key _lost_id _lost_key _in_spans spans items n_words _raw _cuts _toxicity score _text_key _name _row _keep _lost "
            "_text _lines _n_lines _n_dropped _kept_text text_key size favour rate rest copies _copy _rank _bucket _whole _p _u "
            "_src _fav target source_size cut_bucket cut_at kept component_id cid n y form output u1 u2").split()


def test_stages_pass_clashing_columns_unchanged(spark, tmp_path):
    rows, labels = toxic_docs(300)
    line = "a passage that stands in many of these documents again and again"
    texts = [(i, f"{t}\n{line}" if i % 9 == 0 else t, "en", f"s{i % 3}", len(t), *[f"{c}{i}" for c in INTERNAL]) for i, t in rows]
    texts.append((700, None, None, None, None, *[None] * len(INTERNAL)))
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in INTERNAL)
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    item = " ".join(rows[4][1].replace(".", "").split()[:14])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(texts, schema)
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        got = out.collect()
        assert got, name
        for r in got:
            assert all(r[c] == (None if r["doc_id"] == 700 else f"{c}{r['doc_id']}") for c in INTERNAL), name


def test_long_paths_cost_in_proportion(spark):
    def seconds(segments):
        urls = [(i, f"http://h{i % 2}.org/" + "/".join(f"p{j}" for j in range(segments - 1)) + f"/x{i}") for i in range(4)]
        df = spark.createDataFrame(urls, "page_id long, url string").checkpoint()
        begun = time.monotonic()
        out = url_templates.judge_urls(df).collect()
        assert len(out) == 4 and all(r.template.count("/") == segments for r in out)
        return time.monotonic() - begun

    seconds(50)
    few = seconds(1000)
    assert seconds(10_000) < 12 * few


# --- 3: extreme vectors, labels of any type -----------------------------------------------

def test_vectors_of_extreme_size_link(spark):
    rows = [(0, [1e200, 1e200], 1), (1, [1e200, 1e200], 1), (2, [3e-200, 3e-200], 1), (3, [1e-200, 1e-200], 1),
            (4, [1.0, 1.0], 1), (5, [5e-324, 0.0], 1), (6, [0.0, 1e308], 1), (7, [0.0, 0.0], 1), (8, [1e200, -1e200], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in hnsw.near_duplicate_vectors(df).collect()}
    assert got == {**{i: (4, 0) for i in range(5)}, 5: (0, 5), 6: (0, 6), 7: (0, 7), 8: (0, 8)}


@pytest.mark.parametrize("kind,labels", [("string", ["a", "b", None]), ("double", [1.2, 1.7, None])])
def test_labels_of_any_type_are_compared_by_value(spark, kind, labels):
    rows = [(3 * i + k, [1.0, 0.5], label) for i in range(4) for k, label in enumerate(labels)]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<double>, label {kind}")
    got = {r.vec_id: (r.n_links, r.component_id) for r in hnsw.near_duplicate_vectors(df).collect()}
    assert got == {3 * i + k: ((3, k) if k < 2 else (0, 3 * i + k)) for i in range(4) for k in range(3)}
