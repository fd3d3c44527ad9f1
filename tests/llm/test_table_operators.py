"""Embeddings, urls, mixing, toxicity and the pipeline."""

import math
import re

import numpy as np
import pytest

from txnwatch.llm import hnsw, mixing, toxicity, url_templates
from txnwatch.llm.graph import components

from .conftest import by_row
from .test_text_operators import components_of, plain_words

VECTORS = "vec_id long, embedding array<float>, label int, cid string, vec int"


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200)]
    edges += [(300, 300), (40, 0)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r.node: r.root for r in components(df).collect()}
    want = components_of({x for e in edges for x in e} - {300}, [e for e in edges if e[0] != e[1]])
    assert got == want
    assert components(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    out, vid = [], 0
    for label in (0, 1, None):
        centres = rng.normal(size=(12, 16))
        for c in centres:
            for _ in range(int(rng.integers(1, 25))):
                out.append((vid, (c + rng.normal(size=16) * rng.choice([0.05, 0.2, 0.5])).tolist(), label))
                vid += 1
    out += [(vid, out[0][1], 0), (vid, out[0][1], 0), (None, out[0][1], 0), (vid + 1, None, 0), (vid + 2, [0.0] * 16, 1),
            (vid + 3, [math.nan] * 16, 1), (vid + 4, [1.0, None] + [0.0] * 14, 1), (vid + 5, [], 1),
            (vid + 6, [1.0, 2.0], 1), (vid + 7, [2.0, 4.0], 1), (vid + 8, [math.inf] * 16, 0)]
    return out


@pytest.mark.parametrize("shard,block", [(8192, 1024), (40, 16)])
def test_hnsw_against_all_pairs(spark, vectors, shard, block):
    df = spark.createDataFrame([(*v, "c", 1) for v in vectors], VECTORS).repartition(3)
    got = by_row(hnsw.near_duplicate_vectors(df, 0.93, shard, block), "vec_id", "n_links", "component_id", "kept")
    unit = []
    for _, v, label in vectors:
        x = None
        if v and label is not None and all(e is not None and math.isfinite(e) for e in v) and any(v):
            x = np.array(v, np.float32).astype(float)
            x /= np.linalg.norm(x)
        unit.append(x)
    n = len(vectors)
    order = sorted(range(n), key=lambda i: (vectors[i][0] is None, vectors[i][0] or 0))
    place = {i: p for p, i in enumerate(order)}
    linked = [(i, j) for i in range(n) for j in range(i) if unit[i] is not None and unit[j] is not None
              and vectors[i][2] == vectors[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.93]
    comp = components_of(range(n), [(place[i], place[j]) for i, j in linked])
    want_links = [sum(i in p for p in linked) for i in range(n)]
    low = {p: vectors[order[c]][0] for p, c in comp.items()}
    want = sorted(((vectors[i][0], want_links[i], low[place[i]], vectors[i][0] == low[place[i]])
                   for i in range(n)), key=repr)
    found, truth = sum(g[1] for g in got), sum(w[1] for w in want)
    assert found >= 0.9 * truth
    if found == truth:
        assert [g[:3] for g in got] == [w[:3] for w in want]
    assert hnsw.near_duplicate_vectors(df.limit(0)).count() == 0


def test_hnsw_beams_widen_for_large_groups():
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(1, 24)) + rng.normal(size=(700, 24)) * 0.05, rng.normal(size=(900, 24))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = hnsw.Graph.build(x.astype(np.float32))
    near = hnsw.range_search(graph, x.astype(np.float32)[:300], 0.9, beam=16)
    truth = x[:300] @ x.T >= 0.9
    assert sum(truth[i][n].sum() for i, n in enumerate(near)) >= 0.98 * truth.sum() > 100_000


def url_brute(urls):
    out = []
    for u in urls:
        m = re.search(r"://([^/?#]*)([^?#]*)", u or "")
        host, path = (m[1], m[2]) if m else ("", "")
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        best = None
        for verdict, rule in url_templates.RULES:
            h, p = rule.split("/", 1)
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and len(rule) > len(best[1] if best else ""):
                best = (verdict, rule)
        out.append((host, path, best[1] if best else None, best[0] if best else None))
    return out


def test_urls_rules_and_templates(spark):
    urls = ["http://X.Example.ORG/es/1?q", "https://example.org/en/12#t", "https://example.org/en/2", "http://a.com/fr/x",
            "http://com/de/1", "http://acom/de/1", "http://b.net/de/7.html", "http://b.net/de/8.html", "http://b.net",
            "b.net/x", None, "", "://", "http://q.com//de/1", "http://é.org/ü?", "http://a.com?x=/fr/", "http://b.net/de/7.html"]
    urls += [f"http://h{i % 7}.com/de/{i}" for i in range(40)] + [f"http://h{i % 5}.net/de/{i}" for i in range(10)]
    urls += [f"http://h{i % 5}.net/fr/{i}" for i in range(10)] + [f"http://h{i % 5}.com/fr/{i}" for i in range(30)]
    urls += [f"http://w.net/{w}" for w in "abcdefghijkl"]
    df = spark.createDataFrame([(i, u, "h", 0.1) for i, u in enumerate(urls)], "page_id long, url string, host string, purity double")
    out = url_templates.judge_urls(df).collect()
    rows = {r.page_id: r for r in out}
    assert len(out) == len(urls)
    for i, (host, path, rule, verdict) in enumerate(url_brute(urls)):
        r = rows[i]
        assert (r.host, r.path, r.rule) == (host, path, rule), urls[i]
        assert r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict)
    at = {u: i for i, u in enumerate(urls)}
    assert rows[at["http://h1.net/de/1"]].verdict == "block" and rows[at["http://h1.net/fr/1"]].verdict == "allow"
    assert rows[at["http://h1.net/de/1"]].template == "/de/*" and rows[at["http://b.net/de/8.html"]].template == "/de/*.html"
    assert rows[at["http://w.net/c"]].template == "/*" and rows[at["http://b.net"]].template == "/"
    assert rows[at["http://w.net/c"]].rule is None and url_templates.judge_urls(df.limit(0)).count() == 0


def water_fill(sizes, weights, cap):
    """Shares by weight, in rounds: what is above the cap goes to the others."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(cap * sizes[s] for s in capped)
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = {s for s in free if share[s] > cap * sizes[s]}
        if not over:
            return {s: share.get(s, cap * sizes[s]) for s in names}
        capped |= over


def test_mixture_meets_targets(spark, docs, rows):
    out = mixing.mixture(docs).collect()
    assert len(out) == len(rows)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    target = water_fill(sizes, (5, 2, 1), 3.0)
    assert sorted(((r.doc_id, r.size) for r in out), key=repr) == sorted(((i, size(t)) for i, t, _ in rows), key=repr)
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r.size and r.taken % max(r.size, 1) == 0
    assert by_row(mixing.mixture(docs.repartition(5)), "doc_id", "size", "taken") == \
        sorted(((r.doc_id, r.size, r.taken) for r in out), key=repr)


def test_mixture_of_many_documents_comes_near(spark):
    rows = [(i, "w " * (1 + i % 13), f"s{min(i % 10, 3)}") for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got, want = {}, {}
    for r in mixing.mixture(df).collect():
        got[r.source] = got.get(r.source, 0) + r.taken
        want[r.source] = r.target
    for s in want:
        assert abs(got[s] - want[s]) <= 13
    drawn = mixing.draw(df)
    assert drawn.columns == df.columns
    assert sum(len(r.text.split()) for r in drawn.collect()) == sum(got.values())
    assert mixing.mixture(df.limit(0)).count() == 0


def test_caps_pass_the_excess_on(spark):
    rows = [("a", 100), ("b", 1000), ("c", 5000), (None, 10)]
    df = spark.createDataFrame(rows, "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(water_fill(dict(rows), (5, 2, 1), 3.0))


def toxic_docs(n=900, seed=3):
    rng = np.random.default_rng(seed)
    neutral = [f"n{i}" for i in range(200)]
    bad = ["vile", "stupid", "filth"]
    rows, labels = [], []
    for i in range(n):
        w = rng.choice(neutral, 30).tolist()
        y = int(rng.random() < 0.25)
        if y:
            w[3] = str(rng.choice(bad))
        if rng.random() < (0.5 if y else 0.05):  # a group is named mostly in toxic texts
            w[8] = "muslims"
        elif rng.random() < 0.1:
            w[8] = "christians"
        rows.append((i, " ".join(w[:10]) + ". " + " ".join(w[10:])))
        labels.append((i, 1, y))
    return rows, labels


def test_toxicity_held_out_accuracy_and_counterfactuals(spark):
    rows, labels = toxic_docs()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame([*labels, labels[0], (5, 1, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(df, lab)
    y = {i: t for i, _, t in labels}
    scored = toxicity.score(df, model).withColumn("held", toxicity.held_out()).collect()
    held = [r for r in scored if r.held]
    assert np.mean([(r.score >= 0.3) == bool(y[r.doc_id]) for r in held]) > 0.97
    free = toxicity.fit(df, lab, penalty=0.0)

    def gap(m):
        pair = spark.createDataFrame([(0, "n1 muslims n2"), (1, "n1 christians n2")], "doc_id long, text string")
        s = {r.doc_id: r.score for r in toxicity.score(pair, m).collect()}
        return abs(s[0] - s[1]), max(s.values())
    assert gap(model)[0] < 0.02 and gap(model)[0] < gap(free)[0]
    assert gap(model)[1] < 0.3


def test_toxicity_edges(spark, docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs.select("doc_id", "text"), none)
    out = toxicity.score(docs, model)
    assert out.count() == docs.count() and set(out.columns) == set(docs.columns)
    assert {r.score for r in out.collect()} == {0.0}
    one = spark.createDataFrame([(3, 1, 1)], "doc_id long, quality int, toxic int")
    fitted = toxicity.fit(docs.select("doc_id", "text"), one)
    assert all(0 <= r.score <= 1 for r in toxicity.score(docs, fitted).collect())
    assert toxicity.score(no_docs, model).count() == 0


def test_pipeline_stages(spark, tmp_path):
    """Each stage against brute force on what its predecessor kept."""
    import corpus_pipeline as pipeline

    from .test_text_operators import bench_brute, lines_brute, near_brute, sha
    rows, labels = toxic_docs(500)
    line = "a passage that stands in many of these documents again and again"
    item = [f"b{i}" for i in range(20)]
    texts = []
    for i, t in rows:
        t = f"{t}\n{line}" if i % 9 == 0 else t
        t = f"{t} {' '.join(item)}" if i % 17 == 0 else t
        texts.append((i, t, "en", f"s{i % 3}", len(t)))
    texts += [(1000 + i, texts[i][1] + f" more{i}", "en", "s0", 1) for i in range(1, 30)]
    texts += [(2000, "", "en", "s1", 0), (2001, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(texts, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(item))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    sf = str(tmp_path)
    stage = dict(pipeline.STAGES)
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "mixing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")

    def step(name, df):
        out = stage[name](spark, df, sf)
        assert out.columns == docs.columns
        rows = sorted((tuple(r) for r in out.collect()), key=repr)
        return rows, spark.createDataFrame(rows, schema)
    kept, df = step("toxicity", docs)
    bad = {i for i, t, *_ in texts if re.search("vile|stupid|filth", t or "")}
    assert len(({r[0] for r in texts} - {r[0] for r in kept}) ^ bad) <= 0.03 * len(texts)
    assert {r for r in kept} <= set(texts)

    lines, df = step("line_dedup", df)
    want = lines_brute([(i, t, None) for i, t, *_ in kept], 40, 5)
    assert [(i, sha(t or "")) for i, t, *_ in lines] == [(w[0], w[3]) for w in want]
    assert all(n == len(t) for _, t, _, _, n in lines if t is not None)

    near, df = step("near_dedup", df)
    marks = near_brute([(i, t) for i, t, *_ in lines], 5, 80)
    assert {r[0] for r in near} == {m[0] for m in marks if m[3]} and len(near) < len(lines)

    clean, df = step("decontamination", df)
    assert [r[0] for r in clean] == [r[0] for r in near]
    hit = {b[0] for b in bench_brute([(i, t) for i, t, *_ in near], [(1, " ".join(item))], 10) if b[5]}
    for old, new in zip(near, clean):
        assert (old == new) == (old[0] not in hit)
        assert plain_words(new[1]) == [w for w in plain_words(old[1]) if old[0] not in hit or w not in item]

    mixed, _ = step("mixing", df)
    plan = mixing.mixture(df).collect()
    assert len(mixed) == sum(r.copies for r in plan) and set(mixed) <= set(clean)
    assert sorted(tuple(r) for r in pipeline.run(spark, sf).select("doc_id").collect()) == sorted((m[0],) for m in mixed)
