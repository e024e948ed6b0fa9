"""Personal data by patterns, and by bootstrapped contexts, in DataFrame functions only.

Base spans come from four regular expressions. They are the seeds. What stands around a seed is a lexical pattern of its kind, in three shapes: the two words
before it, the two words after it, and one word on each side. Tokens that look like identifiers (a digit, six characters or more) and
meet no base span are the unseen instances; they are tied to the patterns around them. In this graph of patterns and instances scores go back and
forth: a pattern's confidence is the share of its occurrences that are seeds, counted by their score (base spans of other kinds and unknown tokens count against it); an
instance's score is the chance that one of its confident patterns is right. Instances that reach `MIN_CONFIDENCE` join the seeds, so that the next
round finds new patterns around them, until no instance is new. Patterns need `MIN_SEEDS` different seeds and `MIN_CONFIDENCE`.

Offsets count code points; the text is scanned once, and all after that works on rows of one span each, so that texts of very many spans take
time in proportion (and for their order, by a sort). Java's regular expressions are written so that each runs in time linear in the text: possessive, and started only
where a match can begin.

Nulls and edge cases: a null text is empty; a document without spans has empty strings; rows with the same doc_id each get a row; overlapping spans
of different kinds all stay; equal starts are ordered by kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize, table

KINDS = ("email", "ip", "card", "phone")
MIN_SEEDS, MIN_CONFIDENCE = 3, 0.8

_LOCAL, _DOMAIN = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
# \G: right after a match, where a new one may begin inside a run
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_DOMAIN}++(?:\.{_DOMAIN}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
#: Tokens that may be identifiers.
CANDIDATE = r"(?<![A-Za-z0-9._%+@-])[A-Za-z._%+@-]*+[0-9][A-Za-z0-9._%+@-]*+"
_MARKS = r"[._%+@-]+$"
MIN_LENGTH = 6
#: The kind of an identifier-like token in rows of spans.
OTHER = len(KINDS)


def _around(text: Column) -> Column:
    """(one, two): the first word and the first two words of a text."""
    pattern = r"^\s*+(\S++)(?:\s++(\S++))?+"
    first, second = F.regexp_extract(text, pattern, 1), F.regexp_extract(text, pattern, 2)
    return F.struct(first.alias("one"), F.concat_ws(" ", first, F.nullif(second, F.lit(""))).alias("two"))


def _matches(text: Column, pattern: str) -> Column:
    """Array of (skipped, hit, left, right): characters since the last match, the match, and the gaps on both sides."""
    found = F.array(F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits")))
    gap = lambda g: F.struct(F.length(g).alias("skipped"), _around(F.reverse(g)).alias("left"), _around(g).alias("right"))
    # each step is bound to the variable of a lambda, so that it is worked out once for a text
    found = F.transform(found, lambda m: F.struct(F.transform(m["gaps"], gap).alias("gaps"), m["hits"].alias("hits")))

    def pair(m: Column) -> Column:
        return F.transform(m["hits"], lambda h, i: F.struct(F.get(m["gaps"], i)["skipped"].alias("skipped"), h.alias("hit"), F.get(m["gaps"], i)["left"].alias("left"), F.get(m["gaps"], i + 1)["right"].alias("right")))

    return F.get(F.transform(found, pair), F.lit(0))


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(hit: Column) -> Column:
    """Whether the digits of the hit pass the Luhn check."""
    chars = F.split(F.reverse(_digits(hit)), "")

    def digit(c: Column, i: Column) -> Column:
        twice = c.cast("int") * (F.pmod(i, F.lit(2)) + 1)
        return twice - F.when(twice > 9, 9).otherwise(0)

    return F.aggregate(F.transform(F.filter(chars, lambda c: c != ""), digit), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return hit.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        return F.length(_digits(hit)).between(14, 19) & _luhn(hit)
    if kind == "phone":
        return F.length(_digits(hit)).between(10, 15)
    return F.lit(True)


def scan(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id) of the documents, and their spans: (row, kind, start, end, hit, left, right).

    `kind` is that of a valid base span, or `OTHER` for an identifier-like token that meets none; `left` and `right` have the words around, from the
    span outwards (to the left as reversed text).
    """
    docs = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    must = ("[@]", "[0-9]", "[0-9]", "[+]", "[0-9]")
    patterns = [PATTERNS[k] for k in KINDS] + [CANDIDATE]
    none = "array<struct<skipped:int,hit:string,left:struct<one:string,two:string>,right:struct<one:string,two:string>>>"
    kinds = [F.struct(F.lit(k).alias("kind"), F.when(F.col("text").rlike(must[k]), _matches(F.col("text"), p)).otherwise(F.array().cast(none)).alias("found")) for k, p in enumerate(patterns)]
    matches = materialize(docs.select("row", "doc_id", F.array(*kinds).alias("kinds")), "matches")
    rows = matches.select("row", F.explode("kinds").alias("k")).select("row", "k.kind", F.posexplode("k.found").alias("at", "m")).select("row", "kind", "at", "m.*")
    # all of a document's spans are in one partition and sorted there: one shuffle for the three windows
    rows = rows.repartition("row").withColumn("end", F.sum(F.col("skipped") + F.length("hit")).over(W.partitionBy("row", "kind").orderBy("at")).cast("int"))
    rows = rows.withColumn("start", F.col("end") - F.length("hit"))
    valid = F.lit(True)
    for k, kind in enumerate(KINDS):
        valid = F.when(F.col("kind") == k, _valid(kind, F.col("hit"))).otherwise(valid)
    rows = rows.where(valid).withColumn("hit", F.when(F.col("kind") == OTHER, F.regexp_replace("hit", _MARKS, "")).otherwise(F.col("hit")))
    rows = rows.withColumn("end", F.col("start") + F.length("hit")).where((F.col("kind") < OTHER) | (F.length("hit") >= MIN_LENGTH))
    # a token meets a base span that begins with it or before and ends after its start, or the next one that begins before its end
    is_base = F.col("kind") < OTHER
    up = F.max(F.when(is_base, F.col("end"))).over(W.partitionBy("row").orderBy("start", "kind").rowsBetween(W.unboundedPreceding, 0))
    down = F.min(F.when(is_base, F.col("start"))).over(W.partitionBy("row").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(W.unboundedPreceding, 0))
    rows = rows.withColumn("up", up).withColumn("down", down)
    free = is_base | (F.coalesce(F.col("up") <= F.col("start"), F.lit(True)) & F.coalesce(F.col("down") >= F.col("end"), F.lit(True)))
    return matches.select("row", "doc_id"), materialize(rows.where(free).select("row", "kind", "start", "end", "hit", "left", "right"), "spans")


def _contexts(spans: DataFrame) -> DataFrame:
    """`spans`, a row for each shape of pattern around it: shape and context."""
    both = F.when((F.col("left.one") != "") & (F.col("right.one") != ""), F.concat("left.one", F.lit(" | "), "right.one"))
    shapes = [F.col("left.two"), F.col("right.two"), both]
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("shape"), F.lower(c).alias("context")) for i, c in enumerate(shapes)]))
    return spans.select("row", "kind", "start", "end", "hit", each.alias("c")).select("row", "kind", "start", "end", "hit", "c.*").where("context <> ''")


def bootstrap(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(shape, context, kind, confidence) of the confident patterns and (hit, kind, score) of the instances they give.

    `edges` is (shape, context, kind, hit, n): how often a hit stands in a context.
    """
    known = edges.where(F.col("kind") < OTHER).select("shape", "context", F.col("kind").alias("of"), "hit", "n", F.lit(1.0).alias("score"))
    totals = edges.groupBy("shape", "context").agg(F.sum("n").alias("total"))
    loose = edges.where(F.col("kind") == OTHER).select("shape", "context", "hit", "n")
    found = None
    while True:
        if found is None:
            seeds = known
        else:
            seeds = known.unionByName(loose.join(found, "hit").select("shape", "context", F.col("kind").alias("of"), "hit", "n", "score"))
        weight = seeds.groupBy("shape", "context", F.col("of").alias("kind")).agg(F.sum(F.col("n") * F.col("score")).alias("weight"), F.countDistinct("hit").alias("seeds")).where(F.col("seeds") >= MIN_SEEDS)
        patterns = weight.join(totals, ["shape", "context"]).withColumn("confidence", F.col("weight") / F.col("total")).where(F.col("confidence") >= MIN_CONFIDENCE)
        patterns = materialize(patterns.select("shape", "context", "kind", "confidence"), "patterns")
        # 1 - the chance that all of an instance's patterns are wrong; of several kinds the likeliest
        wrong = loose.join(patterns, ["shape", "context"]).select("hit", "kind", "shape", "context", "confidence").distinct()
        scores = wrong.groupBy("hit", "kind").agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9)))))).alias("score"))
        best = scores.groupBy("hit").agg(F.max(F.struct("score", (-F.col("kind")).alias("k"))).alias("b")).select("hit", (-F.col("b.k")).alias("kind"), "b.score")
        if found is not None:  # who has joined stays, with the first score
            best = best.join(found, "hit", "left_anti").unionByName(found)
        best, before = materialize(best, "instances"), 0 if found is None else found.count()
        found = best
        if found.count() == before:
            return patterns, found


def discover(spans: DataFrame) -> DataFrame:
    """(row, start, kind, end) of unseen instances that confident patterns give, from the spans of `scan`."""
    places = _contexts(spans)
    # contexts without MIN_SEEDS occurrences can't become patterns
    often = places.groupBy("shape", "context").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_SEEDS).select("shape", "context")
    places = materialize(places.join(often, ["shape", "context"], "left_semi"), "places")
    edges = materialize(places.groupBy("shape", "context", "kind", "hit").agg(F.count(F.lit(1)).alias("n")), "edges")
    patterns, found = bootstrap(edges)
    loose = places.where(F.col("kind") == OTHER).drop("kind")
    return loose.join(patterns.select("shape", "context", "kind"), ["shape", "context"]).join(found.select("hit", "kind"), ["hit", "kind"]).select("row", "start", "kind", "end").distinct()


def _listed(spans: Column) -> Column:
    kind = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kind, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_personal_data(documents: DataFrame) -> DataFrame:
    """Counts of base spans by kind, their digest, and all spans of every document."""
    docs, spans = scan(documents)
    every = spans.where(F.col("kind") < OTHER).select("row", "start", "kind", "end", F.lit(True).alias("base"))
    every = every.unionByName(discover(spans).select("row", "start", "kind", "end", F.lit(False).alias("base")))
    span = F.struct("start", "kind", "end")
    lists = every.groupBy("row").agg(F.array_sort(F.collect_list(F.when(F.col("base"), span))).alias("base"), F.array_sort(F.collect_list(span)).alias("all"), *[F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{x}") for k, x in enumerate(KINDS)])
    out = docs.join(lists, "row", "left")
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    counts = [F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in KINDS]
    return out.select("doc_id", *counts, F.sha2(_listed(F.coalesce("base", none)), 256).alias("base_sha256"), _listed(F.coalesce("all", none)).alias("spans"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return find_personal_data(table(spark, sf_dir, "documents"))
