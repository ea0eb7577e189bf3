"""Mixing sources to target weights: hierarchical budgets over domain, language and source.

Budget. The tree's leaves are (domain, language, source). A node's capacity is the
tokens below it times `epochs`. From the root down, a node's budget is shared among its
children by their weights; a child that cannot use its share takes its capacity, and
the shortage goes to its siblings by their weights. Since a capacity counts the
whole subtree, a shortage reaches other branches only when all siblings are full.

Selection. Every epoch puts a leaf's documents in an order of its own, by a seeded hash of
the id. Whole epochs are taken while the leaf's budget allows; of the next one the
longest prefix of whole documents whose tokens fit the remainder. The prefix is
found in two steps, so that no leaf has to be sorted in one task: the order is cut into
ranges of about RANGE_ROWS documents, ranges are summed, and only the documents
of the one range that holds the end are put in order.

Only DataFrame functions. A token is a run of characters other than white space.

Defined results: null or empty text has no tokens, and is selected when its place is
before the end of the prefix. Null language, source or domain are values of their
own. Null ids come first in every order. Rows that repeat an id have the same place and are
selected together. A leaf with weight 0 gets tokens only when no weighted one can take them:
never. An empty table gives an empty table. Only the named columns are read.
"""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwire.llm.common import broadcast_if_small, stored

RANGE_ROWS = 4000
LEVELS = ("domain", "lang", "source")
NULL = "\0null"            # stands for a null level; cannot be typed by mistake

DOMAINS = 4
DOMAIN_WEIGHTS = {"d0": 4, "d1": 3, "d2": 2, "d3": 1}
LANG_WEIGHTS = {"en": 5, "de": 2, "fr": 2, "es": 1}
BUDGET_SHARE = 0.6         # of the tokens in one epoch
EPOCHS = 2
SEED = 17


def domain_of(source: Column) -> Column:
    """The tables have no domain; a source belongs to one of DOMAINS by its hash."""
    return F.concat(F.lit("d"), F.crc32(F.coalesce(source, F.lit("")).cast("binary")) % DOMAINS)


def place(doc_id: Column, epoch: Column, seed: int = SEED) -> Column:
    """Position of a document in an epoch's order, in [0, 1): 52 bits of an MD5."""
    text = F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / float(2 ** 52)


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def _weight(level: Column, weights: Mapping[str, float]) -> Column:
    if not weights:
        return F.lit(1.0)
    known = F.create_map(*[F.lit(x) for kv in weights.items() for x in (kv[0], float(kv[1]))])
    return F.coalesce(known[level], F.lit(1.0))


def _share(children: DataFrame, parent: list[str], name: list[str]) -> DataFrame:
    """Water-filling: children(parent..., name..., weight, capacity, budget of the parent) ->
    the child's `share`. Children fill up in order of capacity / weight; the first
    that does not fill sets the level for it and all after it."""
    full_at = F.when(F.col("weight") > 0, F.col("capacity") / F.col("weight"))
    w = Window.partitionBy(*parent).orderBy(F.col("full_at").asc_nulls_last(), *name)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    after = w.rowsBetween(0, Window.unboundedFollowing)
    level = ((F.col("budget") - F.coalesce(F.sum("capacity").over(before), F.lit(0.0)))
             / F.sum("weight").over(after))
    found = children.withColumn("full_at", full_at) \
        .withColumn("capacity", F.when(F.col("weight") > 0, F.col("capacity")).otherwise(0.0)) \
        .withColumn("level", level)
    stop = F.min(F.when(F.col("level") < F.col("full_at"), F.struct("full_at", *name, "level"))) \
        .over(Window.partitionBy(*parent))
    return found.withColumn("stop", stop).withColumn(
        "share", F.when(F.col("stop").isNull() | F.col("full_at").isNull(), F.col("capacity"))
        .when(F.struct("full_at", *name) < F.col("stop").dropFields("level"), F.col("capacity"))
        .otherwise(F.least(F.col("capacity"), F.col("weight") * F.col("stop.level"))))


def leaf_budgets(leaves: DataFrame, domain_weights: Mapping[str, float], lang_weights: Mapping[str, float],
                 source_weights: Mapping[str, float], budget_share: float, epochs: int) -> DataFrame:
    """(domain, lang, source, tokens, docs) -> with `budget` in tokens. Works on one
    row per leaf; windows hold the children of one node."""
    leaf = leaves.withColumn("capacity", F.col("tokens") * float(epochs))
    lang = leaf.groupBy("domain", "lang").agg(F.sum("capacity").alias("capacity"))
    # The root's budget: a sum over the few rows of the domains.
    domain = leaf.groupBy("domain").agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens")) \
        .withColumn("root", F.lit(0))
    total = F.sum("tokens").over(Window.partitionBy("root")) * F.lit(float(budget_share))
    d = _share(domain.withColumn("weight", _weight(F.col("domain"), domain_weights)).withColumn("budget", total),
               ["root"], ["domain"])
    la = _share(lang.withColumn("weight", _weight(F.col("lang"), lang_weights))
                .join(d.select("domain", F.col("share").alias("budget")), "domain"), ["domain"], ["lang"])
    s = _share(leaf.withColumn("weight", _weight(F.col("source"), source_weights))
               .join(la.select("domain", "lang", F.col("share").alias("budget")), ["domain", "lang"]),
               ["domain", "lang"], ["source"])
    return s.select(*LEVELS, "tokens", "docs", F.col("share").alias("budget"))


def mix_sources(documents: DataFrame, domain_weights: Mapping[str, float] = DOMAIN_WEIGHTS,
                lang_weights: Mapping[str, float] = LANG_WEIGHTS,
                source_weights: Mapping[str, float] | None = None, budget_share: float = BUDGET_SHARE,
                epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """doc_id, epoch (from 0), domain, lang, source, n_tokens of every selected document, once
    for each epoch it is taken in."""
    source, lang = (documents[c].cast("string") for c in ("source", "lang"))
    docs = stored(documents.select(
        documents["doc_id"].cast("long").alias("doc_id"), F.coalesce(domain_of(source), F.lit(NULL)).alias("domain"),
        F.coalesce(lang, F.lit(NULL)).alias("lang"), F.coalesce(source, F.lit(NULL)).alias("source"),
        token_count(documents["text"]).alias("n_tokens")), "mix-docs")
    keys = list(LEVELS)
    leaves = stored(docs.groupBy(*keys).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")), "mix-leaves")
    budgets = leaf_budgets(leaves, domain_weights, lang_weights, source_weights or {}, budget_share, epochs)
    plan = stored(budgets.withColumn("whole", F.when(F.col("tokens") > 0, F.least(
        F.floor(F.col("budget") / F.col("tokens")), F.lit(epochs))).otherwise(0).cast("int"))
        .withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens"))
        .withColumn("ranges", F.ceil(F.col("docs") / RANGE_ROWS))
        .select(*keys, "whole", "rest", "ranges"), "mix-plan")
    rows = docs.join(broadcast_if_small(plan, 256), keys)

    taken = rows.where("whole > 0").select(
        "doc_id", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)).alias("epoch"), *keys, "n_tokens")

    part = rows.where((F.col("rest") > 0) & (F.col("whole") < epochs)) \
        .withColumn("place", place(F.col("doc_id"), F.col("whole"), seed)) \
        .withColumn("range", F.floor(F.col("place") * F.col("ranges")).cast("long"))
    sums = part.groupBy(*keys, "range").agg(F.sum("n_tokens").alias("tokens"), F.first("rest").alias("limit"))
    # A leaf's ranges, one row each: its documents / RANGE_ROWS.
    upto = F.sum("tokens").over(Window.partitionBy(*keys).orderBy("range"))
    ends = sums.withColumn("upto", upto).where(F.col("upto") > F.col("limit")) \
        .groupBy(*keys).agg(F.min(F.struct("range", (F.col("upto") - F.col("tokens")).alias("before"))).alias("end")) \
        .select(*keys, F.col("end.range").alias("end"), F.col("end.before").alias("before"))
    ends = broadcast_if_small(stored(ends, "mix-ends"), 256)
    part = part.join(ends, keys, "left")
    inside = part.where("end IS NULL OR range < end")
    edge = part.where("range = end")
    run = F.sum("n_tokens").over(Window.partitionBy(*keys, "range").orderBy("place")
                                 .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    edge = edge.withColumn("upto", F.col("before") + run).where(F.col("upto") <= F.col("rest"))
    cols = ["doc_id", F.col("whole").alias("epoch"), *keys, "n_tokens"]
    both = taken.union(inside.select(*cols)).union(edge.select(*cols))
    def back(c):
        return F.when(F.col(c) != NULL, F.col(c)).alias(c)
    return both.select("doc_id", "epoch", "domain", back("lang"), back("source"), "n_tokens")


#: DuckDB SQL for `mix_sources` with the default parameters.
ORACLE_SQL = """
WITH docs AS (
  SELECT doc_id, coalesce(lang, chr(1)) AS lang, coalesce(source, chr(1)) AS source,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\t\\n\\x0B\\f\\r]+'))::BIGINT AS n_tokens
  FROM documents),
crc_bits AS (
  SELECT i::BIGINT AS i,
    list_reduce([i::BIGINT] || range(8), lambda a, k: CASE WHEN a & 1 = 1
      THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END) AS v
  FROM range(256) t(i)),
crc_table AS (SELECT list(v ORDER BY i) AS tab FROM crc_bits),
sources AS (SELECT DISTINCT source FROM docs),
domains AS (
  SELECT source, 'd' || (xor(list_reduce([4294967295::BIGINT] ||
      list_transform(range(1, length(replace(source, chr(1), '')) + 1),
        lambda k: ascii(substr(source, k, 1))::BIGINT),
      lambda a, b: xor(a >> 8, tab[((xor(a, b)) & 255) + 1])), 4294967295::BIGINT) % 4) AS domain
  FROM sources, crc_table),
d AS (SELECT docs.*, domain FROM docs JOIN domains USING (source)),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::DOUBLE AS tokens FROM d GROUP BY ALL),
b0 AS (SELECT sum(tokens) * 0.6::DOUBLE AS budget FROM leaves),
c1 AS (SELECT domain, sum(tokens * 2) AS cap,
    CASE domain WHEN 'd0' THEN 4.0 WHEN 'd1' THEN 3.0 WHEN 'd2' THEN 2.0 ELSE 1.0 END::DOUBLE AS w
  FROM leaves GROUP BY domain),
l1 AS (SELECT c1.*, (budget - coalesce(sum(cap) OVER (ORDER BY cap / w, domain
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY cap / w, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv,
    row_number() OVER (ORDER BY cap / w, domain) AS k FROM c1, b0),
s1 AS (SELECT min(k) AS k, arg_min(lv, k) AS lv FROM l1 WHERE lv < cap / w),
a1 AS (SELECT domain, CASE WHEN s1.k IS NULL OR l1.k < s1.k THEN cap ELSE least(cap, w * s1.lv) END AS budget
  FROM l1, s1),
c2 AS (SELECT domain, lang, sum(tokens * 2) AS cap,
    CASE lang WHEN 'en' THEN 5.0 WHEN 'de' THEN 2.0 WHEN 'fr' THEN 2.0 ELSE 1.0 END::DOUBLE AS w
  FROM leaves GROUP BY domain, lang),
l2 AS (SELECT c2.*, (budget - coalesce(sum(cap) OVER (PARTITION BY c2.domain ORDER BY cap / w, lang
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (PARTITION BY c2.domain ORDER BY cap / w, lang ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv,
    row_number() OVER (PARTITION BY c2.domain ORDER BY cap / w, lang) AS k FROM c2 JOIN a1 USING (domain)),
s2 AS (SELECT domain, min(k) AS k, arg_min(lv, k) AS lv FROM l2 WHERE lv < cap / w GROUP BY domain),
a2 AS (SELECT l2.domain, lang, CASE WHEN s2.k IS NULL OR l2.k < s2.k THEN cap ELSE least(cap, w * s2.lv) END AS budget
  FROM l2 LEFT JOIN s2 USING (domain)),
c3 AS (SELECT domain, lang, source, tokens * 2 AS cap, 1.0::DOUBLE AS w, tokens FROM leaves),
l3 AS (SELECT c3.*, (budget - coalesce(sum(cap) OVER (PARTITION BY domain, lang ORDER BY cap / w, source
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (PARTITION BY domain, lang ORDER BY cap / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv,
    row_number() OVER (PARTITION BY domain, lang ORDER BY cap / w, source) AS k
  FROM c3 JOIN a2 USING (domain, lang)),
s3 AS (SELECT domain, lang, min(k) AS k, arg_min(lv, k) AS lv FROM l3 WHERE lv < cap / w GROUP BY domain, lang),
a3 AS (SELECT domain, lang, source, tokens,
    CASE WHEN s3.k IS NULL OR l3.k < s3.k THEN cap ELSE least(cap, w * s3.lv) END AS budget
  FROM l3 LEFT JOIN s3 USING (domain, lang)),
plan AS (SELECT *, CASE WHEN tokens > 0 THEN least(floor(budget / tokens), 2) ELSE 0 END::INT AS whole FROM a3),
plan2 AS (SELECT *, budget - whole * tokens AS rest FROM plan),
taken AS (SELECT doc_id, unnest(range(whole))::INT AS epoch, domain, lang, source, n_tokens
  FROM d JOIN plan2 USING (domain, lang, source) WHERE whole > 0),
part AS (SELECT d.*, whole, rest,
    ('0x' || substr(md5('17|' || whole || '|' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT AS place
  FROM d JOIN plan2 USING (domain, lang, source) WHERE rest > 0 AND whole < 2),
run AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place
    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM part),
chosen AS (SELECT * FROM taken UNION ALL
  SELECT doc_id, whole, domain, lang, source, n_tokens FROM run WHERE upto <= rest)
SELECT doc_id, epoch, domain, nullif(lang, chr(1)) AS lang, nullif(source, chr(1)) AS source, n_tokens FROM chosen
"""
