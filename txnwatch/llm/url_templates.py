"""URL filtering by a path-template tree (DataFrame functions only).

Rules (host and path prefix, longest wins) judge the urls they fit and label the
tree.  The tree is built per host over distinct urls: a node is a host and the
generalised segments before it.  Digits of a segment become ``*`` when they vary
between the urls of such a node (on any host); a whole segment does when the literals under its node are about as many as their urls.  A
host's template is compared with the same template on all hosts: if its labelled block rate does not
differ significantly the branches are merged and share one purity, else it keeps its
own, smoothed towards the shared one.  Urls without a rule are blocked where the
purity reaches ``reject``.

Sizes: each distinct url is one row per segment; counts of distinct segments are two
partial aggregates, so a hot host or segment is never gathered.  The tables of nodes
and templates are far smaller than the urls and are joined, not collected.

Defined results: a null url or one without ``://`` has an empty host and path, no
rule, and is judged with the other such rows (all share the empty template).
Repeated rows and urls get equal verdicts.  Empty tables give empty results; extra
columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: (verdict, host and path prefix)
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/"))


def url_parts(url: Column) -> tuple[Column, Column]:
    """Lower-cased host and raw path of a url."""
    u = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(u, r"://([^/?#]*)", 1)
    path = F.regexp_extract(u, r"://[^/?#]*([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null if none."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: len(r[1])):
        h, p = text.split("/", 1)
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def url_key(host: str = "host", path: str = "path") -> list[Column]:
    return [F.xxhash64(host, path).alias("u1"), F.xxhash64(F.lit(7), host, path).alias("u2")]


def path_templates(urls: DataFrame, min_literals: int = 8, share: float = 0.5) -> DataFrame:
    """u1, u2 (``url_key``), template for distinct (host, path).

    A segment's row holds hashes of its url and of the generalised segments before it, no
    strings but its own, so a path costs in proportion to its length."""
    shape = F.regexp_replace("seg", "[0-9]+", "0")
    parts = F.filter(F.split("path", "/", -1), lambda x: x != "")
    node = urls.select("host", *url_key(), F.posexplode_outer(parts).alias("at", "seg"))
    node = node.withColumn("shape", shape)
    before = Window.partitionBy("u1", "u2").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    node = node.select("host", "u1", "u2", "at", "seg", "shape", *[
        F.coalesce(F.bit_xor(F.xxhash64(F.lit(k), "at", "shape")).over(before), F.lit(0)).alias(f"above{k}") for k in (1, 2)])
    above = ["above1", "above2"]
    seen = node.filter("at IS NOT NULL").groupBy("host", "at", *above, "shape", "seg").agg(F.count(F.lit(1)).alias("n"))
    shapes = seen.groupBy("host", "at", *above, "shape").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("n"))
    places = shapes.groupBy("host", "at", *above).agg(F.count(F.lit(1)).alias("all_kinds"), F.sum("n").alias("all_n"))
    anywhere = shapes.groupBy("at", *above, "shape").agg(F.sum("kinds").alias("everywhere"))
    wild = (shapes.join(places, ["host", "at", *above]).join(anywhere, ["at", *above, "shape"])
            .withColumn("loose", (F.col("all_kinds") >= min_literals) & (F.col("all_kinds") > share * F.col("all_n")))
            .withColumn("varies", (F.col("everywhere") > 1) & F.col("shape").contains("0"))
            .select("host", "at", *above, "shape", "loose", "varies"))
    named = node.join(wild, ["host", "at", *above, "shape"], "left")
    part = (F.when(F.col("at").isNull(), F.lit(""))
            .when(F.col("loose"), F.lit("*"))
            .when(F.col("varies"), F.regexp_replace("seg", "[0-9]+", "*")).otherwise(F.col("seg")))
    whole = F.array_sort(F.collect_list(F.struct(F.coalesce("at", F.lit(0)).alias("at"), part.alias("p"))))
    return named.groupBy("u1", "u2").agg(whole.alias("w")).select(
        "u1", "u2", F.concat(F.lit("/"), F.array_join(F.transform("w", lambda x: x["p"]), "/")).alias("template"))


def template_purity(labelled: DataFrame, prior: float = 4.0, z_max: float = 2.0) -> DataFrame:
    """host, template, purity, merged from (host, template, n, blocked): smoothed share
    of blocked urls among the labelled ones; ``n`` counts labelled urls."""
    own = labelled.groupBy("host", "template").agg(F.sum("n").alias("n"), F.sum("blocked").alias("b"))
    shared = own.groupBy("template").agg(F.sum("n").alias("tn"), F.sum("b").alias("tb"))
    total = own.agg(((F.sum("b") + 0.5) / (F.sum("n") + 1.0)).alias("g"))
    root = F.coalesce(total.scalar(), F.lit(0.5))
    shared = shared.select("template", ((F.col("tb") + prior * root) / (F.col("tn") + prior)).alias("branch"))
    rows = own.join(shared, "template")
    p = F.col("branch")
    z = F.when(F.col("n") > 0, F.abs(F.col("b") / F.col("n") - p) / F.sqrt(p * (1 - p) / F.col("n") + 1e-9)
               ).otherwise(F.lit(0.0))
    merged = z < z_max
    purity = F.when(merged, p).otherwise((F.col("b") + prior * p) / (F.col("n") + prior))
    return rows.select("host", "template", purity.alias("purity"), merged.alias("merged"))


def judge_urls(pages: DataFrame, rules=RULES, reject: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity: one row per row of ``pages``."""
    host, path = url_parts(F.col("url"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    distinct = parts.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    judged = distinct.select("*", *url_key()).withColumn("rule", rule).withColumn("given", verdict).join(
        path_templates(distinct.select("host", "path")), ["u1", "u2"]).drop("u1", "u2")
    given = F.col("given").isNotNull()
    counts = judged.select("host", "template", F.when(given, F.col("n")).otherwise(0).alias("n"),
                           F.when(F.col("given") == "block", F.col("n")).otherwise(0).alias("blocked"))
    out = judged.join(template_purity(counts), ["host", "template"])
    found = F.coalesce("given", F.when(F.col("purity") >= reject, F.lit("block")).otherwise(F.lit("allow")))
    out = out.select("host", "path", "rule", found.alias("verdict"), "template", "purity")
    return (parts.join(out, ["host", "path"])
            .select("page_id", "host", "path", "rule", "verdict", "template", "purity"))
