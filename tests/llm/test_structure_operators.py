"""Fill-in-the-middle, conversation repair and quality rules against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from txnwatch.llm import conversations, fim, quality
from txnwatch.llm.text import buffers

from .conftest import by_row


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# --- 11: fill in the middle ---------------------------------------------------------

HOSTILE = ["", " ", None, "a", " a", "a ", "\ta\x0b\x0cb\r\n", "<P>a b", "x <M", "é ß " * 400, "a" * 40_000, " " * 40_000,
           "ab " * 9_000, "\U0001F600 " * 3_000, "a" * 255 + " " + "b" * 9_000 + " \n", "\x00 \x1f a\xa0b   c", "<" * 50]


def fim_row(doc_id, text, seed=42):
    text = text or ""
    toks = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(toks)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(toks[:a]), "".join(toks[a:b]), "".join(toks[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 80:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fim_matches_brute_force_and_round_trips(spark, docs):
    extra = [(10_000 + 20 * i + k, t) for i, t in enumerate(HOSTILE) for k in range(8)]
    both = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    out = fim.fill_in_middle(both)
    assert by_row(out, "doc_id", "n", "form", "prefix_chars", "middle_chars", "output") == sorted(
        (fim_row(*r) for r in both.collect()), key=repr)
    back = out.select(F.coalesce("text", F.lit("")).alias("t"), fim.restored(F.col("form"), F.col("output")).alias("r"))
    assert back.filter("not (t <=> r)").count() == 0
    assert {r["form"] for r in out.select("form").distinct().collect()} == {"plain", "psm", "spm"}


def test_fim_keeps_other_columns(spark, docs, no_docs):
    out = fim.fill_in_middle(docs)
    assert [c for c in out.columns if c not in fim.ADDED.names] == [c for c in docs.columns if c != "n"]
    assert by_row(out, "doc_id", "source", "score", "spans", "kept") == by_row(docs, "doc_id", "source", "score", "spans", "kept")
    assert fim.fill_in_middle(no_docs).count() == 0


def test_chunks_are_content_defined_and_shared():
    rng = random.Random(3)
    body = " ".join(str(rng.randrange(10 ** 9)) for _ in range(9_000))
    texts = ["intro é " * 99 + body, body[1_000:] + " tail", body]
    data, off = buffers(pa.array(texts))
    ends, before = fim.chunk_ends(data, off)
    starts = np.concatenate([[0], ends[:-1]])
    parts = [{data[a:b].tobytes() for a, b in zip(starts[i:j], ends[i:j])} for i, j in zip(before[:-1], before[1:])]
    assert [b"".join(data[a:b].tobytes() for a, b in zip(starts[i:j], ends[i:j])).decode()
            for i, j in zip(before[:-1], before[1:])] == texts
    assert len(parts[0] & parts[2]) > 0.9 * len(parts[2]) and len(parts[1] & parts[2]) > 0.8 * len(parts[2])
    assert (np.diff(np.concatenate([[0], ends])) <= fim.MAX_CHUNK + 3).all()
    cache = fim.ChunkCache()
    cache.summaries(data, ends)
    assert cache.hits >= 1.7 * len(parts[2]) * 0.9


def test_chunk_cache_checks_bytes_and_starts_anew_when_full():
    data, off = buffers(pa.array([" ".join(f"w{i}" for i in range(4_000))]))
    ends, _ = fim.chunk_ends(data, off)
    small = fim.ChunkCache(limit=4_000)
    want = fim.ChunkCache().summaries(data, ends)
    for _ in range(2):
        assert (small.summaries(data, ends) == want).all() and small.size <= 4_000 + fim.MAX_CHUNK
    for key, (body, made) in list(small.known.items()):
        small.known[key] = (b"other", (9, 9, True, True))  # a clash of hashes
    assert (small.summaries(data, ends) == want).all()


# --- 12: conversation repair --------------------------------------------------------

BLANK = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(BLANK)
        out.append("blank" if not body else "duplicate" if (role, text) in seen
                   else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, fault):
    """(cost, audit, lines): the best over all edits, row by row (no grammar, no cells)."""
    paths = {"": (0, "", [])}  # last initials that matter -> best

    def moved(state, x):
        return x if state + x in ("s", "u", "su", "ua", "au") else None

    def widen(paths):
        for _ in range(3):
            for st, (c, t, ls) in list(paths.items()):
                for x, role in (("u", "user"), ("a", "assistant")):
                    to = moved(st, x)
                    if to and (to not in paths or (c + 3, t + "I") < paths[to][:2]):
                        paths[to] = (c + 3, t + "I", ls + [f"{role}:"])
        return paths

    paths = widen(paths)
    for (role, text), f in zip(rows, fault):
        new = {}
        for st, (c, t, ls) in paths.items():
            options = [(st, c + 4, t + "D", ls)]
            if f not in ("blank", "duplicate"):
                late = 3 * (f == "truncated")
                for name, edit, cost in ((role, "K", 0), ("user", "R", 3), ("assistant", "R", 3)):
                    if to := moved(st, name[:1]) if name[:1] else None:
                        options.append((to, c + cost + late, t + edit, ls + [f"{name}:{text}"]))
            for to, cc, tt, ll in options:
                if to not in new or (cc, tt) < new[to][:2]:
                    new[to] = (cc, tt, ll)
        paths = widen(new)
    return min((paths[s] for s in ("", "a") if s in paths), key=lambda x: x[:2])


def repaired(rows):
    ids = {r[0] for r in rows}
    hurt = damaged(rows)
    out = []
    for conv in ids:
        # rows of equal turn: these tests hold only equal ones, so their order does not matter
        mine = sorted((r for r in hurt if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        if not mine:
            out.append((conv, 0, 0, 0, 0, 0, 0, "", sha("")))
            continue
        body = [r[2:] for r in mine]
        f = faults(body)
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(body, body[1:]))
        cost, audit, lines = cheapest(body, f)
        out.append((conv, gaps, f.count("blank"), f.count("duplicate"), f.count("truncated"), illegal, cost, audit,
                    sha("\n".join(lines))))
    return sorted(out, key=repr)


def conversation_rows(rng):
    rows = []
    for conv in range(120):
        for turn in range(rng.randint(1, 12)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "sam"])
            text = rng.choice(["Hi.", "Hi.", "yes", "Why?\n ", "", " \x0b", None, "é!", "ends.", "no end", "a:b\nc."])
            rows.append((conv, turn * rng.choice([1, 1, 2]) if rng.random() > .05 else None, role, text))
    # one row a turn, but for repeats
    one = {(r[0], r[1]): r for r in rows}
    rows = list(one.values())
    rows += [rows[5], rows[5], rows[40], (None, 0, "user", "Hi."), (None, None, None, None), (500, None, "user", None)]
    rows += [(900, t, "user", "Same.") for t in range(300)] + [(901, t, "ua"[t % 2], f"{t}.") for t in range(700)]
    rng.shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, symbols string, at long, h1 int, kind string, first string"


@pytest.mark.parametrize("block", [1024, 3])
def test_repair_matches_brute_force(spark, block):
    rows = conversation_rows(random.Random(8))
    df = spark.createDataFrame([(*r, "x", 1, 2, "k", "f") for r in rows], SCHEMA).repartition(5)
    out = conversations.repair_conversations(df, block_rows=block)
    assert by_row(out, *conversations.RESULT) == repaired(rows)
    assert out.count() == len({r[0] for r in rows})


def test_repair_of_a_conversation_over_many_partitions(spark):
    rows = [(7, t, ("user", "assistant")[t % 3 == 1], f"line {t % 50}{'.' if t % 7 else ''}") for t in range(4_000)]
    rows += [(8, t, "user", "Hi.") for t in range(5)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert by_row(conversations.repair_conversations(df), *conversations.RESULT) == repaired(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_repair_of_no_rows(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations.repair_conversations(df).count() == 0


def test_every_split_gives_the_same_cell():
    """The whole table of spans, all splits, against the one split that is used."""
    rng = random.Random(2)
    for _ in range(60):
        symbols = "".join(rng.choice("suaxSUAX-") for _ in range(rng.randint(1, 9)))
        n = len(symbols)
        cells = {(i, i + 1): conversations.row_cell(symbols[i]) for i in range(n)}
        for width in range(2, n + 1):
            for i in range(n - width + 1):
                made = [conversations.joined(cells[i, k], cells[k, i + width]) for k in range(i + 1, i + width)]
                assert all(m == made[0] for m in made)
                cells[i, i + width] = made[0]
        assert conversations.span_cell(symbols) == cells[0, n]


def test_cells_match_all_edits_of_short_spans():
    """Every sequence of edits with up to three insertions a place, tried one by one."""
    good = re.compile(r"(s?(ua)+)?\Z")
    for symbols in map("".join, itertools.product("suX-", repeat=2)):
        best = None
        choices = []
        for x in symbols:
            late = 3 * x.isupper()
            choices.append([("", 4, "D")] + ([] if x == "-" else [(x.lower(), late, "K"), ("u", 3 + late, "R"), ("a", 3 + late, "R")]))
        gaps = [("", 0, "")] + [("".join(p), 3 * k, "I" * k) for k in (1, 2, 3) for p in itertools.product("ua", repeat=k)]
        for g0, e0, g1, e1, g2 in itertools.product(gaps, choices[0], gaps, choices[1], gaps):
            parts = (g0, e0, g1, e1, g2)
            if good.match("".join(p[0] for p in parts)):
                whole = (sum(p[1] for p in parts), "".join(p[2] for p in parts))
                best = whole if best is None else min(best, whole)
        cell = conversations.span_cell(symbols)
        assert min(cell["0", q] for q in "0A" if ("0", q) in cell) == best


# --- 13: quality rules ---------------------------------------------------------------

def rules(text):
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    wins = [tuple(ws[i:i + 8]) for i in range(len(ws) - 7)]
    times = {w: 0 for w in wins}
    for w in wins:
        times[w] += 1
    hit = {j for i, w in enumerate(wins) if times[w] > 1 for j in range(i, i + 8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit)


EDGE = [None, "", " \n\n \n", "a", "\n", "a\n", "\na\na", "a\r\na\r\na", "a b c d e f g h", "a b c d e f g h " * 2,
        "A b c d e f g h a b c d e f g h", "# * $ % & | < > #é", "x y\n" * 5 + "x y", "é\U0001F600 ß\n" * 40, "w " * 30_000,
        "l" * 300_000 + "\n" + "l" * 300_000, "the cat sat on the mat and then it " * 3 + "z"]


def test_rule_counts_match_brute_force(spark, docs):
    both = docs.select("doc_id", "text").union(
        spark.createDataFrame(list(enumerate(EDGE, 5_000)), "doc_id long, text string"))
    model = quality.QualityModel(np.zeros(1 << 8), float("-inf"), 8)
    out = quality.judge(both, model)
    cols = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    want = []
    for r in both.collect():
        got = rules(r["text"])
        failed = got[0] < 20 or 100 * got[4] > 30 * got[0]
        want.append((r["doc_id"], *got, failed, not failed))
    assert by_row(out, *cols) == sorted(want, key=repr)


def test_statistics_of_many_texts_in_one_slice():
    rng = random.Random(4)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 40))).replace(" a", rng.choice([" a", "\n"]))
             for _ in range(400)] + ["", "\n", "x\n", "\n"]
    data, off = buffers(pa.array(texts))
    got = list(zip(*(x.tolist() for x in quality.statistics(data, off).values())))
    assert got == [rules(t) for t in texts]


def grams(text):
    """Tokens (runs of letters and digits, runs of others) and pairs of neighbours."""
    toks = re.findall(r"[0-9A-Za-z\u0080-\U0010FFFF]+|[^0-9A-Za-z\u0080-\U0010FFFF\x20\x09-\x0D]+", text or "")
    return toks + list(zip(toks, toks[1:]))


def test_ratio_matches_counts_of_plain_ngrams(spark):
    """The whole fit and score with dictionaries of n-grams instead of hashed buckets."""
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["Der", "der", "Hund", "a1", "é,", "!!", "$$", "ok."]) for _ in range(rng.randint(0, 30)))
             for _ in range(150)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    good = [i for i, t in enumerate(texts) if t is not None and "!!" not in t]
    labels = spark.createDataFrame([(i, int(i in good), 0) for i in range(len(texts)) if i % 3] + [(None, 1, 0), (3, None, 0)],
                                   "doc_id long, quality int, toxic int")
    sample = quality.labelled_rows(docs, labels, 1_000)
    rows = sample.collect()
    assert len(rows) == sum(i % 3 > 0 for i in range(len(texts)))
    bits, smoothing = 22, 0.5
    raw, trusted = {}, {}
    for part, into in ((texts, raw), ([r["text"] for r in rows if r["good"] and r["half"]], trusted)):
        for t in part:
            for g in grams(t):
                into[g] = into.get(g, 0) + 1
    size = 1 << bits
    n_raw, n_trusted = sum(raw.values()) + smoothing * size, sum(trusted.values()) + smoothing * size

    def plain(t):
        gs = grams(t)
        return sum(math.log((trusted.get(g, 0) + smoothing) / n_trusted) - math.log((raw.get(g, 0) + smoothing) / n_raw)
                   for g in gs) / max(len(gs), 1)

    model = quality.fit(docs, labels, bits=bits, smoothing=smoothing)
    got = {r["doc_id"]: r["llr"] for r in quality.score(docs, model).collect()}
    assert got == pytest.approx({i: plain(t) for i, t in enumerate(texts)}, abs=1e-9)
    held = [(plain(r["text"]), r["good"]) for r in rows if not r["half"]]

    def gain(cut):
        kept = [g for s, g in held if s >= cut - 1e-9]
        return sum(kept) / sum(g for _, g in held) - (len(kept) - sum(kept)) / sum(not g for _, g in held)

    assert gain(model.threshold) == pytest.approx(max(gain(s) for s, _ in held))


def test_quality_learns_from_every_labelled_document(spark):
    """More labels than the old bound of 20,000 a class: counts and threshold come from all."""
    ids = spark.range(48_000).withColumnRenamed("id", "doc_id")
    good = F.col("doc_id") < 44_000
    docs = ids.select("doc_id", F.when(good, F.concat(F.lit("w"), "doc_id")).otherwise("!!").alias("text"))
    labels = ids.select("doc_id", good.cast("int").alias("quality"), F.lit(0).alias("toxic"))
    sample = quality.labelled_rows(docs, labels)
    assert {r["good"]: r["count"] for r in sample.groupBy("good").count().collect()} == {True: 44_000, False: 4_000}
    model = quality.fit(docs, labels, bits=12)
    half = sample.filter("good and half")
    trusted = quality.bucket_counts(half, 12)
    assert trusted.sum() == half.count() > 20_000
    assert np.allclose(model.ratio, quality.log_ratio(trusted, quality.bucket_counts(docs, 12), 1.0))
    held = [(r["llr"], r["good"]) for r in quality.score(sample.filter("not half"), model).collect()]
    s, g = np.array([x for x, _ in held]), np.array([y for _, y in held])
    cuts = np.unique(s)
    gains = [(~g & (s < c)).sum() / (~g).sum() - (g & (s < c)).sum() / g.sum() for c in cuts]
    assert model.threshold == cuts[np.argmax(gains)]


def test_quality_without_labels_and_with_empty_tables(spark, docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for table in (docs, no_docs):
        model = quality.fit(table, none, bits=10)
        out = quality.judge(table, model)
        assert model.threshold == float("-inf") and out.filter("kept = base_failed").count() == 0
        assert out.count() == table.count()
    assert by_row(out.select("doc_id"), "doc_id") == []


def test_quality_parts_labelled_documents(spark):
    """Trained on labels of even ids only, judged on the others."""
    base = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels.filter("doc_id % 2 = 0"))
    out = quality.judge(docs, model).join(labels.filter("doc_id % 2 = 1 and quality is not null"), "doc_id")
    rows = out.filter("not base_failed").select("quality", F.col("kept").alias("ok")).collect()
    good, bad = [r["ok"] for r in rows if r["quality"]], [r["ok"] for r in rows if not r["quality"]]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.1 * len(bad) and bad
