"""License scan by template-markup matching.

A template is license wording with markup: ``<<beginOptional>> .. <<endOptional>>``
around words that may be missing (may nest), ``<<var;max=N>>`` for a replaceable
region of at most N words.  It is compiled into a token automaton; a text is
accepted where all mandatory wording stands exactly, in order, with optional words
present or not and replaceable regions filled by anything.  Of the templates accepted
from one place only the longest names the text, so a license whose name begins like a
neighbour's is not taken for it; base phrases count as they stand.

Words are found and mapped to template symbols in vectorised form; only texts that
contain every mandatory word of a template run its automaton, from the places where
it can begin.  One pass over whole texts, no shuffle.

Defined results: a null, empty or wordless text has no words and no labels and
scores 0.  Rows are scanned one by one, so repeated rows repeat their result; empty
tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from txnwatch.llm.text import PUNCT, word_hashes, word_tables

#: Base phrases, matched as they stand.
BASE = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))

_VERSIONS = ("4 0", "3 0", "2 5", "2 1", "2 0", "1 0")
_NC = ("noncommercial", "non commercial")
_SA = ("sharealike", "share alike")
_ND = ("noderivatives", "no derivatives", "noderivs", "no derivs", "noderivative", "no derivative")
_ANY_VERSION = " ".join(f"<<beginOptional>>{v}<<endOptional>>" for v in _VERSIONS)
_PORT = "<<beginOptional>><<var;max=3>> license<<endOptional>>"


def _creative_commons() -> list[tuple[str, str]]:
    """The six licenses, by name (in all spellings) and abbreviated.  A region stands behind
    a version only, so that it cannot hold the name of a neighbour."""
    name = "creative commons attribution"
    out = [("cc-by", f"{name} {v} {_PORT}") for v in _VERSIONS]
    out += [("cc-by", f"{name} <<beginOptional>>international<<endOptional>> <<beginOptional>>unported<<endOptional>> "
                      f"<<beginOptional>>generic<<endOptional>> <<beginOptional>>public<<endOptional>> {w}")
            for w in ("license", "licence")]
    parts = {"cc-by-nc": _NC, "cc-by-sa": _SA, "cc-by-nd": _ND,
             "cc-by-nc-sa": [f"{a} {b}" for a in _NC for b in _SA],
             "cc-by-nc-nd": [x for a in _NC for b in _ND for x in (f"{a} {b}", f"{b} {a}")]}
    out += [(label, f"{name} {w} {_ANY_VERSION}") for label, spelled in parts.items() for w in spelled]
    for cc in ("cc", "creative commons"):
        out += [("cc-by", f"{cc} by {v}") for v in _VERSIONS]
        out += [(label, f"{cc} {label[3:].replace('-', ' ')} {_ANY_VERSION}") for label in parts]
    return out


def _gnu(label: str, name: str, short: str, versions: dict[str, tuple[str, ...]], region: str) -> list[tuple[str, str]]:
    """A GNU license by its notice, by "version n of" it, and by its short names."""
    out = []
    for v, glued in versions.items():
        out += [(label, f"gnu {name} {region} version {v}"), (label, f"version {v} of the gnu {name}"),
                (label, f"gnu {name} <<beginOptional>>{short}<<endOptional>> <<beginOptional>>v<<endOptional>> {v}"),
                (label, f"{short} <<beginOptional>>version<<endOptional>> <<beginOptional>>v<<endOptional>> {v}")]
        out += [(label, f"gnu {name} {g}") for g in glued] + [(label, f"{short} {g}") for g in glued]
        out += [(label, f"{short}{g}") for g in (v, *glued)]
    return out


_FSF = ("<<beginOptional>>as published by the free software foundation<<endOptional>> <<beginOptional>>either<<endOptional>>")

#: Wording of common public licenses and notices, with the parts that vary marked up.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of <<var;max=12>> "
            "to deal in the software without restriction"),
    ("mit", "<<beginOptional>>released<<endOptional>> under the <<beginOptional>>terms of the<<endOptional>> "
            "mit <<beginOptional>>open source<<endOptional>> license"),
    ("mit", "mit license <<beginOptional>>mit<<endOptional>> copyright"),
    ("apache-2", "<<beginOptional>>licensed under the<<endOptional>> apache <<beginOptional>>software<<endOptional>> license "
                 "<<beginOptional>>version<<endOptional>> <<beginOptional>>v<<endOptional>> 2 0"),
    ("apache-2", "apache <<beginOptional>>software<<endOptional>> license v2"),
    ("apache-2", "apache 2 0 license"),
    *_creative_commons(),
    ("cc0", "cc0 <<beginOptional>>1 0<<endOptional>> universal"),
    ("cc0", "creative commons <<beginOptional>>cc0<<endOptional>> zero"),
    ("cc0", "to the extent possible under law <<var;max=16>> waived all copyright and related or neighboring rights"),
    *_gnu("gpl-2", "general public license", "gpl", {"2": ("v2",)}, _FSF),
    *_gnu("gpl-3", "general public license", "gpl", {"3": ("v3",)}, _FSF),
    *(t for name in ("lesser general public license", "library general public license",
                     "library or lesser general public license")
      for t in _gnu("lgpl", name, "lgpl", {"2": ("v2",), "3": ("v3",)}, "<<var;max=12>>")),
    ("lgpl", "gnu lesser general public license <<var;max=12>> version"),
    ("lgpl", "gnu library general public license <<var;max=12>> version"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "<<beginOptional>>subject to the limitations in the disclaimer below<<endOptional>> "
            "provided that the following conditions are met"),
    ("bsd", "under <<beginOptional>>the<<endOptional>> <<beginOptional>>a<<endOptional>> <<beginOptional>>terms of the<<endOptional>> "
            "<<beginOptional>>new<<endOptional>> <<beginOptional>>modified<<endOptional>> <<beginOptional>>revised<<endOptional>> "
            "<<beginOptional>>simplified<<endOptional>> <<beginOptional>><<var;max=1>> clause<<endOptional>> bsd <<var;max=6>> license"),
    ("mpl-2", "mozilla public license <<beginOptional>>version<<endOptional>> <<beginOptional>>v<<endOptional>> 2 0"),
    ("mpl-2", "mozilla public license v2"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("proprietary", "all rights reserved <<var;max=8>> no part of this <<var;max=10>> may be "
                    "<<beginOptional>>used or<<endOptional>> <<beginOptional>>copied or<<endOptional>> reproduced"),
)


@dataclass
class Automaton:
    """Token automaton of one template; state 0 begins, ``final`` accepts."""

    label: str
    base: bool
    steps: list[dict[str, set[int]]] = field(default_factory=lambda: [{}])
    free: list[set[int]] = field(default_factory=lambda: [set()])
    skip: list[set[int]] = field(default_factory=lambda: [set()])
    mandatory: list[str] = field(default_factory=list)
    final: int = 0

    def _state(self) -> int:
        self.steps.append({})
        self.free.append(set())
        self.skip.append(set())
        return len(self.steps) - 1

    @classmethod
    def compile(cls, label: str, markup: str, base: bool = False) -> Automaton:
        auto, at, opened = cls(label, base), 0, []
        for token in re.findall(r"<<[^>]*>>|[^\s<]+", markup):
            if token == "<<beginOptional>>":
                opened.append(at)
            elif token == "<<endOptional>>":
                auto.skip[opened.pop()].add(at)
            elif m := re.fullmatch(r"<<var;max=(\d+)>>", token):
                ends = [at]
                for _ in range(int(m[1])):
                    nxt = auto._state()
                    auto.free[at].add(nxt)
                    at = nxt
                    ends.append(at)
                for e in ends[:-1]:
                    auto.skip[e].add(at)
            else:
                nxt = auto._state()
                auto.steps[at].setdefault(token, set()).add(nxt)
                at = nxt
                if not opened:
                    auto.mandatory.append(token)
        if opened:
            raise ValueError(f"unclosed optional region in the template of {label}")
        auto.final = at
        return auto

    def close(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for nxt in self.skip[todo.pop()] - states:
                states.add(nxt)
                todo.append(nxt)
        return states

    def begins(self) -> set[str]:
        return {w for s in self.close({0}) for w in self.steps[s]}

    def match(self, words: list[str | None], at: int) -> int:
        """Length of the longest accepted span from ``at``; 0 if none."""
        states, best, i = self.close({0}), 0, at
        while states and i < len(words):
            w = words[i]
            moved: set[int] = set()
            for s in states:
                moved |= self.free[s]
                if w is not None:
                    moved |= self.steps[s].get(w, set())
            states = self.close(moved)
            i += 1
            if self.final in states:
                best = i - at
        return best


class Scanner:
    def __init__(self, base=BASE, templates=TEMPLATES):
        self.automata = [Automaton.compile(k, t, True) for k, t in base] + [
            Automaton.compile(k, t) for k, t in templates]
        words = sorted({w for a in self.automata for s in a.steps for w in s})
        h = word_hashes(words)
        order = np.argsort(h)
        self.hashes, self.words = h[order], [words[i] for i in order]
        number = {w: i for i, w in enumerate(self.words)}
        self.need = [np.array(sorted({number[w] for w in a.mandatory})) for a in self.automata]
        self.begin = [np.array(sorted(number[w] for w in a.begins())) for a in self.automata]
        self.gate = np.zeros(1 << 16, bool)
        self.gate[(self.hashes >> np.uint64(48)).astype(np.int64)] = True

    def scan(self, table) -> list[dict]:
        h = table.hashes()
        at = np.flatnonzero(self.gate[(h >> np.uint64(48)).astype(np.int64)])
        sym = np.minimum(np.searchsorted(self.hashes, h[at]), len(self.hashes) - 1)
        ok = self.hashes[sym] == h[at]
        at, sym = at[ok], sym[ok]
        doc = np.searchsorted(table.first, at, side="right") - 1
        seen = np.zeros((table.n_docs, len(self.hashes)), bool)
        seen[doc, sym] = True
        out = [{"n_words": n, "places": [], "labels": set(), "score": 0.0} for n in table.counts.tolist()]
        bounds = np.searchsorted(doc, np.arange(table.n_docs + 1))
        lists: dict[int, list] = {}
        longest: dict[tuple[int, int], tuple[int, set, float]] = {}  # (text, place): words, labels, score
        for a, need, begin in zip(self.automata, self.need, self.begin):
            for d in np.flatnonzero(seen[:, need].all(axis=1)).tolist():
                own = slice(bounds[d], bounds[d + 1])
                base = int(table.first[d])
                if d not in lists:
                    words: list[str | None] = [None] * int(table.counts[d])
                    for p, s in zip(at[own].tolist(), sym[own].tolist()):
                        words[p - base] = self.words[s]
                    lists[d] = words
                for p in at[own][np.isin(sym[own], begin)].tolist():
                    n = a.match(lists[d], p - base)
                    if n:
                        m = len(a.mandatory)
                        score = m / (m + 1) * min(1.0, m / n)
                        if a.base:
                            out[d]["labels"].add((True, a.label))
                            out[d]["places"].append(p - base)
                            out[d]["score"] = max(out[d]["score"], score)
                            continue
                        best = longest.get((d, p), (0, set(), 0.0))
                        if n > best[0]:
                            longest[d, p] = (n, {a.label}, score)
                        elif n == best[0]:
                            longest[d, p] = (n, best[1] | {a.label}, max(best[2], score))
        for (d, _), (_, labels, score) in longest.items():
            out[d]["labels"] |= {(False, label) for label in labels}
            out[d]["score"] = max(out[d]["score"], score)
        return out


def scan_licenses(docs: DataFrame, base=BASE, templates=TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()),
                        ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()),
                        ("labels", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, templates)
        for batch in batches:
            for part, table in word_tables(batch, "text", PUNCT):
                rows = [{"n_words": r["n_words"], "n_base": len(r["places"]),
                         "first_word": min(r["places"], default=None), "last_word": max(r["places"], default=None),
                         "base_labels": ",".join(sorted({k for b, k in r["labels"] if b})),
                         "labels": ",".join(sorted({k for _, k in r["labels"]})), "score": r["score"]}
                        for r in scanner.scan(table)]
                ids = part.column(part.schema.get_field_index("doc_id"))
                cols = [ids, *(pa.array([r[c] for r in rows], schema.field(c).type) for c in schema.names[1:])]
                yield pa.record_batch(cols, schema=schema)

    source = docs.selectExpr("cast(doc_id as bigint) as doc_id", "cast(text as string) as text")
    return source.mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, "
                                  "base_labels string, labels string, score double")
