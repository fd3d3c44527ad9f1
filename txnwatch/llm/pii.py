r"""Personal data by weak supervision (DataFrame and SQL functions only).

Candidates are all matches of the base patterns (email, ip, card, phone), valid or
not, and of looser ones (spelled-out addresses, national phone numbers, and runs
of 16 characters or more with a letter, some of which are keys or tokens).  Five
labelers vote on each candidate or abstain: the strict format (regex), prefixes and
endings from gazetteers, words before it, what touches it, and its grouping.  An
expectation-maximisation over the counts of vote patterns estimates how reliable each
labeler is per kind; its posteriors are the soft labels of a logistic span
classifier over kind and votes.  Valid base matches always stay; other candidates
are added where the classifier accepts them and they overlap no base span.

Texts are read once, row by row, without a shuffle: what is kept of them (offsets
and votes) is written to the shared checkpoint folder.  Only vote patterns are counted
over the corpus; there are at most KINDS x 3^5 of them, whatever the input, and the
estimates run on that table.

Patterns have no backtracking that can overflow the stack or grow with the square of
a run: repeats are possessive, and a start inside a run that already failed is
skipped by a look-behind (``\G`` keeps starts right after a match).

Defined results: null and empty texts have no spans.  Each row has its own result, so
repeated rows repeat it.  Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds of spans; the first four have base spans.
KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]
_RUN = "[A-Za-z0-9._%+-]"
#: name: (kind, pattern, cheap condition without which there is no match)
PATTERNS = {
    "email": ("email", rf"(?:\G|(?<!{_RUN})){_RUN}++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++", "contains(text, '@')"),
    "ip": ("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+", r"text rlike '[0-9]\\.[0-9]'"),
    "card": ("card", r"[0-9](?:[\x20-]?[0-9])++", r"text rlike '[0-9][\\x20-]?[0-9]'"),
    "phone": ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "contains(text, '+')"),
    "spelled": ("email", rf"(?:\G|(?<!{_RUN})){_RUN}++\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]+"
                         r"(?:\x20?[(\[]dot[)\]]\x20?[A-Za-z0-9-]+)++", "contains(text, 'at') and contains(text, 'dot')"),
    "national": ("phone", r"(?<![0-9+()-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])",
                 r"text rlike '[0-9]{3}[.-][0-9]{4}'"),
    "opaque": ("secret", r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+", "text rlike '[A-Za-z0-9+/_-]{16}'"),
}
#: Endings of addresses, issuer prefixes, reserved ip ranges, context words.
TLDS = "com|org|net|edu|gov|info|io|co|de|fr|es|it|nl|eu|uk|us|ch|at|be|pl|ru|cn|jp|br|in|au|ca"
ISSUERS = "3[47]|4|5[1-5]|2[2-7]|6011|65|35|36|30"
RESERVED = "0|10|127|255|192\\\\.168|169\\\\.254|2(?:2[4-9]|[34][0-9])"
FOR = "e-?mail|mail|contact|reach|write|call|tel|phone|mobile|fax|card|visa|mastercard|ip|host|server|address"
AGAINST = "version|isbn|issn|order|item|page|section|chapter|invoice|serial|checksum|id"
SECRETS = ("token|secret|api[_-]?key|access[_-]?key|private[_-]?key|auth|authorization|bearer|password|passwd|pwd|"
           "credentials?")
DIGESTS = "sha-?[0-9]*|md5|checksum|commit|digest|hash|etag|revision|uuid"
KEY_PREFIXES = "AKIA|ASIA|AIza|ghp_|gho_|github_pat_|glpat-|sk-|sk_live_|pk_live_|xox[abprs]-|ya29|eyJ"
VOTES = ("format", "gazetteer", "words", "touch", "grouping")

_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_DIGITS = "regexp_replace(x.m, '[^0-9]', '')"
_LUHN = f"""(length({_DIGITS}) between 14 and 19 and aggregate(sequence(1, length({_DIGITS})), 0L, (a, i) -> a +
    case when i % 2 = 1 then cast(substring({_DIGITS}, -i, 1) as int)
         else (cast(substring({_DIGITS}, -i, 1) as int) * 2) % 10 + (cast(substring({_DIGITS}, -i, 1) as int) * 2) div 10
    end) % 10 = 0)"""
#: Is a match of the pattern a base span?
VALID = {
    "email": "true",
    "ip": f"x.m rlike '^{_PART}(?:\\\\.{_PART}){{3}}$'",
    "card": _LUHN,
    "phone": f"length({_DIGITS}) between 10 and 15",
    "spelled": "false",
    "national": "false",
    "opaque": "false",
}
#: Votes 1 (personal data), 0 (not), null (abstains).
FORMAT = {
    "email": "if(x.m rlike '^[A-Za-z0-9].*@.*[.][A-Za-z]{2,}$' and length(x.m) <= 254, 1, 0)",
    "ip": f"if(x.m rlike '^{_PART}(?:\\\\.{_PART}){{3}}$', 1, 0)",
    "card": f"if({_LUHN}, 1, 0)",
    "phone": f"if(length({_DIGITS}) between 10 and 15, 1, 0)",
    "spelled": "cast(null as int)",
    "national": "cast(null as int)",
    "opaque": "if(x.m rlike '^(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})$' or (x.m rlike '[a-z]' and x.m rlike '[A-Z]' "
              "and x.m rlike '[0-9]' and not x.m rlike '[/-].*[/-]'), 1, 0)",
}
GAZETTEER = {
    "email": f"if(x.m rlike '[.](?:{TLDS})$', 1, cast(null as int))",
    "ip": f"if(x.m rlike '^(?:{RESERVED})[.]', 0, cast(null as int))",
    "card": f"if({_DIGITS} rlike '^(?:{ISSUERS})', 1, 0)",
    "phone": f"if({_DIGITS} rlike '^[1-9]', 1, 0)",
    "spelled": f"if(x.m rlike '[\\\\x20)\\\\]](?:{TLDS})$', 1, 0)",
    "national": f"if({_DIGITS} rlike '^[2-9][0-9]{{2}}[2-9]', 1, 0)",
    "opaque": f"if(x.m rlike '^(?:{KEY_PREFIXES})', 1, cast(null as int))",
}
GROUPING = {
    "email": "if(x.m rlike '[.][.]|^[.]|@-', 0, 1)",
    "ip": "if(x.a rlike '^[.][0-9]' or x.b rlike '[0-9][.]$', 0, 1)",
    "card": "if(x.m rlike '^(?:[0-9]+|[0-9]{4}(?:[\\\\x20-][0-9]{4}){2,3}(?:[\\\\x20-][0-9]{1,4})?|"
            "[0-9]{4}[\\\\x20-][0-9]{6}[\\\\x20-][0-9]{4,5})$', 1, 0)",
    "phone": "if(length(regexp_replace(x.m, '[^(]', '')) = length(regexp_replace(x.m, '[^)]', '')), 1, 0)",
    "spelled": "1",
    "national": "1",
    # letters and digits alternate as in random strings
    "opaque": "if(regexp_count(x.m, '(?:[A-Za-z][0-9]|[0-9][A-Za-z])') >= 4, 1, 0)",
}
_WORDS = (f"case when x.b rlike '(?i)(?:^|[^a-z])(?:{FOR})[^a-z0-9]{{0,3}}$' then 1 "
          f"when x.b rlike '(?i)(?:^|[^a-z])(?:{AGAINST})[^a-z0-9]{{0,3}}$' then 0 end")
_SECRET_WORDS = (f"case when x.b rlike '(?i)(?:^|[^a-z])(?:{SECRETS})[^a-z0-9]{{1,6}}$' then 1 "
                 f"when x.b rlike '(?i)(?:^|[^a-z])(?:{DIGESTS})[^a-z0-9]{{0,6}}$' then 0 end")
_SECRET_TOUCH = ("case when x.b rlike '[\"\\'=:]\\\\s?$' then 1 "
                 "when x.b rlike '[./]$' or x.a rlike '^[./][A-Za-z0-9]' then 0 end")
_TOUCH = "if(x.b rlike '[A-Za-z0-9_/=]$' or x.a rlike '^[A-Za-z0-9_/=%]', 0, cast(null as int))"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id and found: array of (s, k, e, base, kind, votes...) per row; s and e are
    code points, e exclusive; k is the kind's place in KINDS."""
    df = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    none = "cast(array() as array<string>)"
    df = df.withColumns({
        **{f"h_{n}": F.expr(f"if({c}, regexp_extract_all(text, {_quoted(p)}, 0), {none})")
           for n, (_, p, c) in PATTERNS.items()},
        **{f"p_{n}": F.expr(f"if({c}, split(text, {_quoted(p)}, -1), {none})") for n, (_, p, c) in PATTERNS.items()}})
    # length of each piece and of the match after it
    df = df.select("doc_id", *[f"h_{n}" for n in PATTERNS], *[f"p_{n}" for n in PATTERNS], *[
        F.expr(f"zip_with(slice(p_{n}, 1, size(h_{n})), h_{n}, (x, y) -> "
               "named_struct('l', cast(length(x) as bigint), 'm', cast(length(y) as bigint)))").alias(f"l_{n}")
        for n in PATTERNS])
    # running sums in chunks of 64, so that they stay linear for very many matches
    df = df.withColumns({f"c_{n}": F.expr(f"""if(size(l_{n}) = 0, cast(array() as array<array<bigint>>),
        transform(sequence(0, (size(l_{n}) - 1) div 64), c -> aggregate(slice(l_{n}, cast(c * 64 + 1 as int), 64),
            array(0L), (a, x) -> array_append(a, element_at(a, -1) + x.l + x.m))))""") for n in PATTERNS})
    df = df.withColumns({f"o_{n}": F.expr(f"""aggregate(c_{n}, array(0L),
        (a, x) -> array_append(a, element_at(a, -1) + element_at(x, -1)))""") for n in PATTERNS})
    df = df.withColumns({f"s_{n}": F.expr(f"""flatten(zip_with(c_{n}, slice(o_{n}, 1, size(c_{n})),
        (x, o) -> transform(slice(x, 1, size(x) - 1), v -> v + o)))""") for n in PATTERNS})
    df = df.withColumns({f"z_{n}": F.expr(f"""transform(arrays_zip(h_{n}, slice(p_{n}, 1, size(h_{n})),
        slice(p_{n}, 2, size(h_{n})), s_{n}), z -> named_struct('m', z.h_{n}, 'b', right(z.`1`, 32),
        'a', left(z.`2`, 8), 's', z.s_{n} + length(z.`1`)))""") for n in PATTERNS})
    found = []
    for n, (kind, _, _) in PATTERNS.items():
        # digit runs that are far from a card are not candidates
        some = f"filter(z_{n}, x -> length({_DIGITS}) >= 12)" if n == "card" else f"z_{n}"
        if n == "opaque":  # nor are numbers; long words are, for what tells them from keys
            some = f"filter(z_{n}, x -> x.m rlike '[A-Za-z]')"
        words, touch = (_SECRET_WORDS, _SECRET_TOUCH) if n == "opaque" else (_WORDS, _TOUCH)
        found.append(F.expr(f"""transform({some}, x -> named_struct('s', x.s, 'k', {KINDS.index(kind)},
            'e', x.s + length(x.m), 'base', {VALID[n]}, 'format', {FORMAT[n]}, 'gazetteer', {GAZETTEER[n]},
            'words', {words}, 'touch', {touch}, 'grouping', {GROUPING[n]}))"""))
    return df.select("doc_id", F.concat(*found).alias("found"))


@dataclass
class SpanModel:
    """Logistic weights: bias per kind, and (for, against) per kind and labeler."""

    bias: list[float]
    weights: list[list[tuple[float, float]]]

    def probability(self, x: str) -> str:
        """SQL for the probability of candidate ``x``."""
        terms = []
        for k in range(len(KINDS)):
            votes = "".join(f" + case {x}.{v} when 1 then {p:.6f}D when 0 then {q:.6f}D else 0D end"
                            for v, (p, q) in zip(VOTES, self.weights[k]))
            terms.append(f"when {k} then {self.bias[k]:.6f}D{votes}")
        return f"(1D / (1D + exp(-(case {x}.k {' '.join(terms)} end))))"


def _posteriors(rows: list[tuple], rounds: int = 50) -> list[float]:
    """EM over vote patterns of one kind: probability that a pattern is personal data.
    rows: (votes, count).  The class prior stays even: nearly all candidates of some
    kinds are personal data, which says nothing of one that breaks the format."""
    n_votes = len(VOTES)
    post = []
    for votes, _ in rows:  # a majority to begin with, in which the format has three voices
        cast = [v for v in votes if v is not None] + 2 * [v for v in votes[:1] if v is not None]
        post.append((sum(cast) + 0.5) / (len(cast) + 1))
    for _ in range(rounds):
        rates = []
        for j in range(n_votes):
            hit = [[1.0, 1.0], [1.0, 1.0]]
            hit[1][1] += 3  # labelers are taken to be better than chance
            hit[0][0] += 3
            for p, (votes, c) in zip(post, rows):
                if votes[j] is not None:
                    hit[1][votes[j]] += p * c
                    hit[0][votes[j]] += (1 - p) * c
            rates.append([h[1] / (h[0] + h[1]) for h in hit])
        new = []
        for votes, _ in rows:
            z = 0.0
            for j, v in enumerate(votes):
                if v is not None:
                    a, b = (rates[j][1], rates[j][0]) if v else (1 - rates[j][1], 1 - rates[j][0])
                    z += math.log(a / b)
            new.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
        moved = max((abs(a - b) for a, b in zip(new, post)), default=0.0)
        post = new
        if moved < 1e-6:
            break
    return post


def _logistic(rows: list[tuple], post: list[float], steps: int = 300) -> tuple[float, list[tuple[float, float]]]:
    """Soft-label logistic regression on the votes of one kind; a pattern weighs the
    square root of its count, so that rare votes are learned as well."""
    size = 1 + 2 * len(VOTES)
    rows = [(votes, math.sqrt(c)) for votes, c in rows]
    total = sum(c for _, c in rows)
    feats = [[1.0] + [f for v in votes for f in (float(v == 1), float(v == 0))] for votes, _ in rows]
    w = [0.0] * size
    for _ in range(steps):
        grad = [1e-3 * x for x in w]
        for f, p, (_, c) in zip(feats, post, rows):
            z = sum(a * b for a, b in zip(w, f))
            d = c / total * (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - p)
            for i, x in enumerate(f):
                if x:
                    grad[i] += d
        w = [a - 2.0 * g / 3 for a, g in zip(w, grad)]
    return w[0], [(w[1 + 2 * j], w[2 + 2 * j]) for j in range(len(VOTES))]


def fit(found: DataFrame) -> SpanModel:
    """Span classifier from the vote patterns of all candidates."""
    c = F.explode("found").alias("c")
    table = (found.select(c).groupBy("c.k", *[F.col(f"c.{v}").alias(v) for v in VOTES]).agg(F.count(F.lit(1)).alias("n")))
    patterns = table.collect()  # at most len(KINDS) * 3 ** len(VOTES) rows
    bias, weights = [], []
    for k in range(len(KINDS)):
        rows = sorted(((tuple(r[v] for v in VOTES), r["n"]) for r in patterns if r["k"] == k), key=repr)
        b, w = _logistic(rows, _posteriors(rows)) if rows else (-5.0, [(0.0, 0.0)] * len(VOTES))
        bias.append(b)
        weights.append(w)
    return SpanModel(bias, weights)


def _joined(array: str) -> str:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return (f"array_join(transform({array}, x -> concat_ws(':', element_at(array({names}), x.k + 1), "
            "cast(x.s as string), cast(x.e as string))), ',')")


def find_personal_data(docs: DataFrame, accept: float = 0.6) -> DataFrame:
    """doc_id, base and all: arrays of spans (s, k, e) in order, for each row."""
    found = candidates(docs).checkpoint()
    model = fit(found)
    span = "named_struct('s', x.s, 'k', x.k, 'e', x.e)"
    base = found.select("doc_id", "found", F.expr(
        f"array_sort(transform(filter(found, x -> x.base), x -> {span}))").alias("base"))
    more = F.expr(f"""transform(filter(found, x -> not x.base and {model.probability('x')} >= {accept}D
        and not exists(base, y -> y.s < x.e and x.s < y.e)), x -> {span})""")
    return base.select("doc_id", "base", F.array_distinct(F.array_sort(F.concat("base", more))).alias("all"))


def personal_data(docs: DataFrame, accept: float = 0.6) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added."""
    out = find_personal_data(docs, accept)
    count = [F.expr(f"cast(size(filter(base, x -> x.k = {i})) as bigint)").alias(f"n_{k}") for i, k in enumerate(BASE_KINDS)]
    return out.select("doc_id", *count, F.sha2(F.expr(_joined("base")), 256).alias("base_sha256"),
                      F.expr(_joined("all")).alias("spans"),
                      (F.size("all") - F.size("base")).cast("long").alias("n_added"))
