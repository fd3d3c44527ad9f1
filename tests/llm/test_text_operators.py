"""Operators on single texts and text pairs against brute force."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from txnwatch.llm import fm_index, license_automata, line_dedup, minhash, ngram_trie, pii

from .conftest import by_row

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def space_words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))


def plain_words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))


def test_word_table_spans_and_hashes():
    import pyarrow as pa
    from txnwatch.llm.text import SPACE, WordTable, buffers
    texts = ["One two  ONE", "", None, "one", " \n", "x" * 1000 + " two", "é É", "two"]
    data, off = buffers(pa.array(texts))
    table = WordTable(data, off, SPACE)
    assert table.counts.tolist() == [len(space_words(t)) for t in texts]
    words = [w for t in texts for w in space_words(t)]
    for step in (1 << 18, 64, 7):  # words longer than a step are hashed in pieces
        h = table.hashes(step).tolist()
        assert len(h) == len(words) and h == table.hashes().tolist()
        assert all((a == b) == (x == y) for x, a in zip(words, h) for y, b in zip(words, h))


# --- 1: personal data -------------------------------------------------------------

def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def base_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m)
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15))
    spans = [(m.start(), k, m.end(), name) for k, (name, p, ok) in enumerate(kinds)
             for m in re.finditer(p, text or "") if ok(m.group())]
    return sorted(spans)


TEXTS = ["a@b.c_d@e.f x@y mail: joe.doe+x@mail.example.com!", "1.2.3.4.5.6.7.8 999.1.1.1 0255.1.2.3 10.0.0.1.",
         "4111 1111 1111 1111 4111-1111-1111-1112 12345678901234567890", "+1 (988) 555-2485 +44 20 7946 0958 ++1 2",
         "é\U0001F600 x@é.b a.b@c-d.e\n+49(30)1234567", "call (212) 555-0100 or joe [at] mail [dot] com",
         "1" * 3000, "a@b" + ".c" * 3000, "", None, "9 " * 2000 + "a@b.co", "x" * 5000 + "@" + "y" * 100,
         " ".join(f"u{i}@h{i}.org 10.0.{i % 256}.7" for i in range(300))]


def test_pii_base_spans_match_brute_force(spark, docs):
    extra = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    both = docs.select("doc_id", "text").union(extra)
    got = by_row(pii.personal_data(both), "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    want = []
    for r in both.collect():
        s = base_spans(r.text)
        n = Counter(x[3] for x in s)
        want.append((r.doc_id, n["email"], n["ip"], n["card"], n["phone"],
                     sha(",".join(f"{k}:{a}:{b}" for a, _, b, k in s))))
    assert got == sorted(want, key=repr)


def test_pii_added_spans_keep_base_ones(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    for r in pii.personal_data(df).collect():
        base = [f"{k}:{a}:{b}" for a, _, b, k in base_spans(TEXTS[r.doc_id])]
        spans = r.spans.split(",") if r.spans else []
        assert set(base) <= set(spans) and len(spans) == len(base) + r.n_added
        starts = [int(s.split(":")[1]) for s in spans]
        assert starts == sorted(starts)


SECRET = ["The key: token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" here.", "TOKEN = \"9233A8ECF7C5B09FE5949719B6B82BC439E9329B\"!!",
          "password=aB3dE5fG7hJ9kL1mN3pQ and a verylongwordwithoutanydigits", "commit 04dbebab91ab85687d33eeaaf9ac699e1188f962",
          "see /usr/share/documentation2024/Introduction1 here", "auth: \"8f2b1c9d7e6a5f4b3c2d1e0f9a8b7c6d5e4f3a2b\", a@b.co"]


def secret_candidates(text):
    """Runs of 16 characters or more with a letter, and their votes, by plain patterns."""
    out = []
    for m in re.finditer(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}", text or ""):
        x, b, a = m.group(), text[max(0, m.start() - 32):m.start()], text[m.end():m.end() + 8]
        if not re.search("[A-Za-z]", x):
            continue
        mixed = all(re.search(p, x) for p in ("[a-z]", "[A-Z]", "[0-9]")) and not re.search("[/-].*[/-]", x)
        shape = int(bool(re.fullmatch("[0-9a-f]{32,128}|[0-9A-F]{32,128}", x)) or mixed)
        known = 1 if re.match(pii.KEY_PREFIXES, x) else None
        word = (1 if re.search(rf"(?i)(?:^|[^a-z])(?:{pii.SECRETS})[^a-z0-9]{{1,6}}$", b) else
                0 if re.search(rf"(?i)(?:^|[^a-z])(?:{pii.DIGESTS})[^a-z0-9]{{0,6}}$", b) else None)
        touch = 1 if re.search(r"""["'=:]\s?$""", b) else 0 if re.search("[./]$", b) or re.match("[./][A-Za-z0-9]", a) else None
        group = int(len(re.findall("[A-Za-z][0-9]|[0-9][A-Za-z]", x)) >= 4)
        out.append((m.start(), m.end(), (shape, known, word, touch, group)))
    return out


def test_pii_secrets_match_brute_force(spark, docs):
    """Candidates and votes by plain patterns, the model by its own steps on their counts."""
    texts = [(10_000 + i, t) for i, t in enumerate(SECRET * 6)]
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    both = docs.select("doc_id", "text").union(given).union(spark.createDataFrame(texts, "doc_id long, text string"))
    rows = [(r["doc_id"], r["text"], secret_candidates(r["text"])) for r in both.collect()]
    table = sorted(Counter(v for _, _, found in rows for _, _, v in found).items(), key=repr)
    bias, weights = pii._logistic(table, pii._posteriors(table))

    def probability(votes):
        z = bias + sum(0 if v is None else w[0] if v else w[1] for v, w in zip(votes, weights))
        return 1 / (1 + math.exp(-z))

    want = []
    for i, text, found in rows:
        base = base_spans(text)
        own = [(a, b) for a, b, v in found if probability(v) >= 0.6 and not any(s < b and a < e for s, _, e, _ in base)]
        want.append((i, ",".join(f"secret:{a}:{b}" for a, b in own)))
    got = [(r["doc_id"], ",".join(s for s in r["spans"].split(",") if s.startswith("secret:"))) for r in pii.personal_data(both).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    hits = {i: s for i, s in want if i is not None and i >= 10_000}
    found = {k: bool(hits[10_000 + k]) for k in range(6)}
    assert found[0] and found[1] and found[5] and not found[4], found
    assert sum(bool(re.search(r'(?i)token = "[0-9a-f]{40}"', r["text"] or "")) for r in given.collect()) > 3


def test_pii_reliabilities_rank_the_labelers():
    # 200 clean positives, 60 clean negatives, and a labeler (place 3) that is right half of the time
    table = [((1, 1, None, None, 1), 100), ((1, 1, None, 0, 1), 100), ((0, 0, None, None, 0), 30),
             ((0, 0, None, 0, 0), 30), ((0, 1, None, None, 0), 3)]
    post = pii._posteriors(table)
    assert post[0] > 0.9 and post[1] > 0.9 and max(post[2:]) < 0.2
    bias, weights = pii._logistic(table, post)
    assert weights[0][0] > 0 > weights[0][1] and abs(weights[3][1]) < weights[0][0]


def test_pii_empty(no_docs):
    assert pii.personal_data(no_docs).count() == 0


# --- 2: near duplicates -------------------------------------------------------------

def shingles(t, k):
    w = space_words(t)
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def components_of(ids, linked):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def near_brute(rows, k, percent):
    sets = [shingles(t, k) for _, t, *_ in rows]
    big = 1 << 60
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    place = {i: p for p, i in enumerate(order)}
    linked = [(place[i], place[j]) for i, j in itertools.combinations(range(len(rows)), 2)
              if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    comp = components_of(range(len(rows)), linked)
    low = {}
    for p, c in comp.items():
        low[c] = min(low.get(c, big), big if rows[order[p]][0] is None else rows[order[p]][0])
    out = []
    for i, (doc_id, *_) in enumerate(rows):
        c = low[comp[place[i]]]
        c = None if c == big else c
        out.append((doc_id, len(sets[i]), c, doc_id == c))
    return sorted(out, key=repr)


@pytest.mark.parametrize("k,percent,block", [(3, 85, 1024), (5, 80, 4)])
def test_minhash_matches_brute_force(docs, rows, k, percent, block):
    got = by_row(minhash.near_duplicates(docs, k, percent, block), "doc_id", "n_shingles", "component_id", "kept")
    assert got == near_brute(rows, k, percent)


def test_minhash_dense_family_in_blocks(spark):
    """A family of links and near misses, larger than a block."""
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(60):
        t = list(base)
        for j in rng.choice(80, int(rng.integers(0, 5)), replace=False):
            t[j] = f"v{rng.integers(1000)}"
        rows.append((i, " ".join(t)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = by_row(minhash.near_duplicates(df, 3, 85, block=8), "doc_id", "n_shingles", "component_id", "kept")
    assert got == near_brute(rows, 3, 85)


def test_drop_near_duplicates_leaves_one_of_each_group(docs, rows, no_docs):
    kept = minhash.drop_near_duplicates(docs, 5, 80)
    assert kept.columns == docs.columns
    want = {(i, t) for (i, t, *_), (_, _, c, k) in zip(
        sorted(rows, key=lambda r: repr(r[0])), sorted(near_brute(rows, 5, 80), key=lambda r: repr(r[0])))
        if k or c is None}
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in want}
    assert kept.groupBy("doc_id", "text").count().filter("count > 1").count() == 0
    assert minhash.near_duplicates(no_docs, 3, 85).count() == 0


# --- 4: language model ----------------------------------------------------------------

def test_elias_fano_returns_what_it_was_given():
    for v in (np.zeros(5, int), np.array([7]), np.sort(np.random.default_rng(0).integers(0, 10 ** 7, 3000))):
        level = ngram_trie.ef_encode(v)
        assert (ngram_trie.ef_get(level, np.arange(len(v))) == v).all()


def test_trie_scores_match_brute_force(spark, docs, rows):
    got = by_row(ngram_trie.language_scores(spark, docs), "doc_id", "held_out", "n_tokens", "n_known", "train_tokens",
                 "base_score", "score")
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    texts = [(i, [None, *space_words(t), ""]) for i, t, _ in rows]
    c, pairs = Counter(), Counter()
    for i, w in texts:
        if not out(i):
            c.update(w[1:])
            pairs.update(zip(w, w[1:]))
    total, kinds = Counter(), Counter()
    for (a, _), n in pairs.items():
        total[a] += n
        kinds[a] += 1
    size = sum(c.values()) + len(c) + 1
    want = []
    for i, w in texts:
        base, score = 0.0, 0.0
        for a, b in zip(w, w[1:]):
            p = (c[b] + 1) / size
            base += math.log10(p)
            if total[a]:
                p = max(pairs[a, b] - 0.75, 0) / total[a] + 0.75 * kinds[a] / total[a] * p
            score += math.log10(p)
        want.append((i, out(i), len(w) - 1, sum(c[x] > 0 for x in w[1:]), sum(c.values()), base, score))
    want.sort(key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9)
        assert abs(g[6] - w[6]) <= 3e-4 * w[2]  # 16-bit probabilities


def test_known_contexts_sum_to_one(spark):
    df = spark.createDataFrame([(1, "a b a c"), (3, "b a b")], "doc_id long, text string")
    trie = ngram_trie.train(spark, df, rows_per_shard=1)
    words = ["a", "b", "c", "unseen"]
    asked = spark.createDataFrame([(i, f"a {w}") for i, w in enumerate(words)], "doc_id long, text string")
    ends = spark.createDataFrame([(i, w) for i, w in enumerate(["a", "a a"])], "doc_id long, text string")
    one = {r.doc_id: r.score for r in ngram_trie.score(ends, trie).collect()}
    two = {r.doc_id: r.score for r in ngram_trie.score(asked, trie).collect()}
    assert len(one) == 2 and len(two) == 4
    level, weight = trie.successors(np.array([], int), np.array([], int))
    assert len(level) == len(weight) == 0
    empty = ngram_trie.train(spark, df.limit(0))
    r = ngram_trie.score(df, empty).first()
    assert r.train_tokens == 0 and r.base_score == 0.0 and r.score == 0.0


# --- 5: licenses -----------------------------------------------------------------------

def license_brute(t):
    w = plain_words(t)
    places = [(i, k) for k, p in license_automata.BASE for i in range(len(w))
              if w[i:i + len(p.split())] == p.split()]
    at = [i for i, _ in places]
    return len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({k for _, k in places}))


def test_license_base_places(spark, docs):
    texts = ["Released under the MIT License. Under-the MIT license, under the MIT licenses.",
             "Apache License, Version 2.0 CC BY NC 4.0 cc-by-nc", "under the mit", "cc by cc by nc",
             "GNU General Public License as published by the Free Software Foundation, either version 3 of it",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of this thing and its "
             "manual to deal in the Software without restriction", "permission is hereby denied"]
    df = docs.select("doc_id", "text").union(
        spark.createDataFrame([(2000 + i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    out = license_automata.scan_licenses(df)
    got = by_row(out, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert got == sorted(((r.doc_id, *license_brute(r.text)) for r in df.collect()), key=repr)
    named = {r.doc_id: r for r in out.filter("doc_id >= 2000").collect()}
    assert named[2004].labels == "gpl-3" and named[2005].labels == "mit" and named[2006].labels == ""
    assert named[2001].labels == "apache-2,cc-by-nc" and all(0 <= r.score <= 1 for r in named.values())


def test_automaton_regions():
    a = license_automata.Automaton.compile("x", "keep <<beginOptional>>the<<beginOptional>> big<<endOptional>>"
                                                "<<endOptional>> notice of <<var;max=2>> here")
    for text, n in (("keep notice of here", 4), ("keep the notice of q here", 6), ("keep the big notice of q r here", 8),
                    ("keep big notice of here", 0), ("keep notice of q r s here", 0), ("notice of here", 0)):
        assert a.match(text.split(), 0) == n, text
    with pytest.raises(ValueError):
        license_automata.Automaton.compile("x", "a <<beginOptional>> b")


# --- 6: lines --------------------------------------------------------------------------

def lines_brute(rows, chars, least):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    seen = {}
    for i, t, _ in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= chars:
                seen.setdefault(key(line), set()).add(i)
    keeper = {k: max(x for x in v if x is not None) for k, v in seen.items() if len(v) >= least}
    out = []
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in keeper or keeper[key(x)] == i]
        out.append((i, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return sorted(out, key=repr)


def test_line_dedup_matches_brute_force(docs, rows, no_docs):
    from pyspark.sql import functions as F
    out = line_dedup.with_kept_text(docs.select("doc_id", "text"), 40, 5)
    got = by_row(out.withColumn("h", F.sha2("_kept_text", 256)), "doc_id", "_n_lines", "_n_dropped", "h")
    assert got == lines_brute(rows, 40, 5)
    again = line_dedup.drop_repeated_lines(docs, 40, 5)
    assert again.columns == docs.columns and again.count() == len(rows)
    assert line_dedup.drop_repeated_lines(no_docs).count() == 0


def test_line_bitmaps_span_words(spark):
    """Lines beyond the first 64 of a document, and a document that loses all lines."""
    common = [f"a common line that is long enough to count, number {i:03d}" for i in range(150)]
    rows = [(i, "\n".join(common if i % 2 else ["own"] + common), None) for i in range(6)]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    from pyspark.sql import functions as F
    out = line_dedup.with_kept_text(df, 40, 5).withColumn("h", F.sha2("_kept_text", 256))
    assert by_row(out, "doc_id", "_n_lines", "_n_dropped", "h") == lines_brute(rows, 40, 5)


# --- 9: benchmark ------------------------------------------------------------------------

def bench_brute(rows, items, window):
    out = []
    wins = {}
    for i, t in items:
        w = plain_words(t)
        k = min(len(w), window)
        for p in range(len(w) - k + 1) if w else ():
            wins.setdefault(tuple(w[p:p + k]), set()).add(i)
    sizes = {len(w) for w in wins}
    for i, t, *_ in rows:
        w, hit, names = plain_words(t), set(), set()
        for k in sizes:
            for p in range(len(w) - k + 1):
                if tuple(w[p:p + k]) in wins:
                    hit |= set(range(p, p + k))
                    names |= wins[tuple(w[p:p + k])]
        names = sorted(str(n) for n in names - {None})
        out.append((i, len(w), len(hit), len(names), sha(",".join(names)), bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def bench(spark, rows):
    long = [plain_words(t) for _, t, _ in rows if t and len(plain_words(t)) > 30]
    items = [(i, " ".join(w[3:28])) for i, w in enumerate(long[:8])]
    items += [(20, "One TWO"), (21, ""), (22, None), (None, " ".join(long[9][:14])), (3, " ".join(long[3][3:28]))]
    return items, spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("block_words", [2_000_000, 20])
def test_fm_index_matches_brute_force(spark, docs, rows, bench, block_words):
    from pyspark.sql import functions as F
    found = fm_index.occurrences(spark, docs.select("doc_id", "text"), bench[1], 10, block_words)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"] + 1)
    got = by_row(found.select("doc_id", "n_words", hit.alias("h"), F.size("items").alias("k"),
                              F.sha2(F.array_join("items", ","), 256).alias("s"), (F.size("spans") > 0).alias("c")),
                 "doc_id", "n_words", "h", "k", "s", "c")
    assert got == bench_brute(rows, bench[0], 10)


def test_removed_benchmark_is_gone(spark, docs, bench, no_docs):
    clean = fm_index.remove_benchmark(spark, docs, bench[1], 10)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    before = fm_index.contamination(spark, docs, bench[1]).filter("contaminated").count()
    left = [r for r in clean.collect() if r.text]
    hit = [b for b in bench_brute([(r.doc_id, r.text) for r in left], bench[0], 10) if b[5]]
    assert before > 3 and not hit
    none = spark.createDataFrame([], "item_id long, text string")
    assert fm_index.contamination(spark, docs, none).filter("contaminated").count() == 0
    assert fm_index.contamination(spark, no_docs, bench[1]).count() == 0


def test_suffix_order_and_search():
    rng = np.random.default_rng(1)
    seq = rng.integers(2, 5, 400)
    sa = fm_index.suffix_array(seq)
    assert sa.tolist() == sorted(range(400), key=lambda i: seq[i:].tolist())
    index = fm_index.FmIndex(seq, 5)
    windows = np.array([[2, 3, 4], [4, 4, 4], [3, 2, 2]])
    lo, hi = index.search(windows)
    for w, a, b in zip(windows, lo, hi):
        want = [i for i in range(398) if (seq[i:i + 3] == w).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want
