"""Mixing sources to target weights by budgets that go down a tree of domains, languages and sources.

The root's budget is divided among its children by weight, each child's among its own,
and so on. What a node can hold is the sum of what its leaves can hold, a leaf's tokens
times ``epochs``. A child whose share is more than it can hold is filled, and what it
lacks goes to its siblings by weight; only when all children of a node are filled does
the node hold less than its share, and its own siblings get the rest. So a shortage
moves among siblings first, then to the siblings of the parent, and so on up.

Shares are whole numbers: at each node they are rounded down, so a tree loses less than
one token a node.

A leaf with budget b and t tokens gives whole epochs while b >= t, then a prefix of one
more epoch. An epoch is the leaf's documents in the order of SHA-256(seed:epoch:id),
and the prefix takes documents until their tokens reach the rest (the last document
may go past it by less than its own length). The prefix is found without ordering a
leaf: tokens are summed by the first DIGITS hexadecimal digits of the hash, sums of at
most 256 sums give the one cell in which the prefix ends, its rows are summed by the next
digits, and so on; only the rows of the last cell, a leaf's share of 1/256**STEPS, are ordered.

Weights are integers by node; a node that isn't listed weighs 1. A node's siblings are
counted among aggregated rows (one for each leaf), never among documents.

Cases: null domains, languages and sources are nodes of their own; documents without
tokens come with each whole epoch and with a prefix that passes their place; repeated
rows count each time, and those that can't be told apart by id come in one block; an
empty table gives an empty result; other columns stay, whatever their names.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracelake.llm import common

LEVELS = ("domain", "lang", "source")
EPOCHS, SEED = 3, 20240101
#: Weights by path; the path of a domain is its name, of a language "domain/lang", of a source "domain/lang/source".
WEIGHTS: Mapping[str, int] = {"reference": 3, "web": 5, "reference/en": 4, "reference/de": 2, "reference/fr": 2, "reference/es": 2, "web/en": 6, "web/de": 2, "web/fr": 2, "web/es": 1}
#: The budget as a share of the corpus's tokens, in percent.
PERCENT = 100
#: Hexadecimal digits of the hash that make a cell, and how often cells are cut into cells.
DIGITS, STEPS = 2, 2
#: The domains of sources by pattern; other sources are of the last domain.
DOMAINS: Mapping[str, str] = {"^src[0-4]$": "reference"}
OTHER = "web"
_NONE = "(none)"


def domain_of(source: Column, domains: Mapping[str, str] = DOMAINS, other: str = OTHER) -> Column:
    """The domain of the first pattern that a source matches; ``other`` for the rest and for null."""
    found = F.lit(other)
    for pattern, domain in reversed(domains.items()):
        found = F.when(source.rlike(pattern), domain).otherwise(found)
    return found


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def _weight(path: Column, weights: Mapping[str, int]) -> Column:
    table = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(int(v)).cast("bigint"))]) if weights else F.create_map().cast("map<string,bigint>")
    return F.coalesce(F.try_element_at(table, path), F.lit(1).cast("bigint"))


def _poured(nodes: DataFrame, parent: list[str], order: str) -> DataFrame:
    """Adds ``budget``: the share of each of ``nodes`` (weight, holds, order) in its parent's ``given``.

    Children are filled from the one whose share runs out first; ties by name.
    """
    ratio = F.col("holds") / F.col("weight")
    by = Window.partitionBy(*parent).orderBy(ratio, order)
    before, whole = by.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*parent)
    earlier = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0).cast("bigint"))
    seen = nodes.withColumns({"_w": F.sum("weight").over(whole) - earlier("weight"), "_b": earlier("holds")})
    # full while the rest at this child's ratio is at most what is left
    full = F.col("holds").cast("decimal(38,0)") * F.col("_w") <= (F.col("given") - F.col("_b")).cast("decimal(38,0)") * F.col("weight")
    seen = seen.withColumn("_full", full)
    seen = seen.withColumns({"_filled": F.sum(F.when(F.col("_full"), F.col("holds")).otherwise(0)).over(whole), "_open": F.sum(F.when(~F.col("_full"), F.col("weight")).otherwise(0)).over(whole)})
    share = F.expr("cast((cast(given - _filled as decimal(38,0)) * weight) div nullif(_open, 0) as bigint)")
    return seen.withColumn("budget", F.when(F.col("_full"), F.col("holds")).otherwise(F.least("holds", share))).drop("_w", "_b", "_full", "_filled", "_open", "given")


def budgets(leaves: DataFrame, total: int | None = None, weights: Mapping[str, int] = WEIGHTS, epochs: int = EPOCHS, percent: int = PERCENT) -> DataFrame:
    """(domain, lang, source, tokens, budget) from one row for each leaf (domain, lang, source, tokens).

    ``total``: the root's budget; ``percent`` of all tokens if not given. Names are not null.
    """
    leaf = leaves.withColumn("holds", F.col("tokens") * epochs)
    path = [F.col("domain"), F.concat_ws("/", "domain", "lang"), F.concat_ws("/", "domain", "lang", "source")]
    domains = leaf.groupBy("domain").agg(F.sum("holds").alias("holds"), F.sum("tokens").alias("_t"))
    root = F.lit(total).cast("bigint") if total is not None else F.expr(f"sum(_t) over () * {int(percent)} div 100")
    domains = _poured(domains.withColumns({"weight": _weight(path[0], weights), "given": root, "_root": F.lit(0)}), ["_root"], "domain").select("domain", F.col("budget").alias("given"))
    langs = leaf.groupBy("domain", "lang").agg(F.sum("holds").alias("holds")).join(domains, "domain")
    langs = _poured(langs.withColumn("weight", _weight(path[1], weights)), ["domain"], "lang").select("domain", "lang", F.col("budget").alias("given"))
    sources = leaf.join(langs, ["domain", "lang"])
    return _poured(sources.withColumn("weight", _weight(path[2], weights)), ["domain", "lang"], "source").select(*LEVELS, "tokens", "budget")


def mix(
    df: DataFrame,
    id_col: str = "doc_id",
    tokens: Column | None = None,
    levels: tuple[Column, Column, Column] | None = None,
    total: int | None = None,
    weights: Mapping[str, int] = WEIGHTS,
    epochs: int = EPOCHS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """(row: struct of all columns of ``df``, domain, lang, source, n_tokens, epoch): a row for each time a document is taken."""
    tokens = n_words(F.col("text")) if tokens is None else tokens
    levels = (domain_of(F.col("source")), F.col("lang"), F.col("source")) if levels is None else levels
    named = {f"_{k}": F.coalesce(c.cast("string"), F.lit(_NONE)) for k, c in zip(LEVELS, levels, strict=True)}
    docs = df.select(F.struct("*").alias("row"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), *[c.alias(k) for k, c in named.items()], tokens.cast("bigint").alias("n_tokens"))
    docs = docs.toDF("row", "id", *LEVELS, "n_tokens")
    keys = list(LEVELS)
    slim = common.stored(docs.drop("row"), "leaves")
    leaves = budgets(slim.groupBy(*keys).agg(F.sum("n_tokens").alias("tokens")), total, weights, epochs, percent)
    leaves = leaves.withColumns({"whole": F.expr("if(tokens = 0, 0L, budget div tokens)"), "rest": F.expr("if(tokens = 0, 0L, budget % tokens)")})
    leaves = common.stored(leaves, "budgets")
    last = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), "id"), 256)
    leaves = leaves.withColumns({"prefix": F.lit(""), "before": F.lit(0).cast("bigint")})
    for _ in range(STEPS):
        # stored, these small tables have a known size: Spark broadcasts them, or splits a hot leaf in the join
        plan = slim.join(leaves.filter("rest > 0").select(*keys, "whole", "rest", "prefix", "before"), keys).withColumn("key", last).filter(F.col("key").startswith(F.col("prefix")))
        cells = plan.groupBy(*keys, F.substring("key", 1, F.length("prefix") + DIGITS).alias("cell")).agg(F.sum("n_tokens").alias("n"), F.first("rest").alias("rest"), F.first("before").alias("before"))
        upto = F.sum("n").over(Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
        cells = cells.withColumn("before", F.col("before") + F.coalesce(upto, F.lit(0).cast("bigint")))
        ends = cells.filter("before < rest and before + n >= rest").select(*keys, F.col("cell").alias("prefix"), "before")
        leaves = common.stored(leaves.drop("prefix", "before").join(ends, keys, "left"), "ends")
    near = slim.join(leaves.filter("prefix is not null"), keys).withColumn("key", last).filter(F.col("key").startswith(F.col("prefix")))
    order = Window.partitionBy(*keys).orderBy("key").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    # the last hash that is taken: the first at which the tokens reach the rest
    stop = near.withColumn("upto", F.col("before") + F.sum("n_tokens").over(order)).filter("upto >= rest").groupBy(*keys).agg(F.min("key").alias("stop"))
    leaves = common.stored(leaves.select(*keys, "whole").join(stop, keys, "left"), "stops")
    taken = docs.join(leaves, keys).withColumn("times", F.col("whole") + F.when(last <= F.col("stop"), 1).otherwise(0)).filter("times > 0")
    epoch = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times"))).alias("epoch")
    return taken.select("row", *keys, "n_tokens", epoch)


def report(df: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """(id, domain, lang, source, n_tokens, epoch)."""
    return mix(df, id_col, **options).select(F.col(f"row.{id_col}").alias(id_col), *LEVELS, "n_tokens", "epoch")


def mixed(df: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows that are taken, each as often as it is, with their own columns."""
    return mix(df, id_col, **options).select("row.*")


def oracle() -> str:
    """DuckDB SQL for ``report`` over ``documents`` with production parameters: leaves are ordered as a whole."""
    weights = ", ".join(f"('{k}', {v})" for k, v in WEIGHTS.items())

    def poured(name: str, of: str, parent: str, order: str) -> str:
        by = f"PARTITION BY {parent} ORDER BY holds / weight, {order}"
        return f"""
        {name}_a AS (SELECT *, sum(weight) OVER ({by} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS w,
            coalesce(sum(holds) OVER ({by} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS b FROM {of}),
        {name}_b AS (SELECT *, holds * w <= (given - b) * weight AS filled FROM {name}_a),
        {name}_c AS (SELECT *, sum(CASE WHEN filled THEN holds ELSE 0 END) OVER (PARTITION BY {parent})::HUGEINT AS fill, sum(CASE WHEN filled THEN 0 ELSE weight END) OVER (PARTITION BY {parent})::HUGEINT AS free FROM {name}_b),
        {name} AS (SELECT *, CASE WHEN filled THEN holds ELSE least(holds, (given - fill) * weight // free) END AS budget FROM {name}_c)"""

    return f"""
        WITH weights AS (SELECT * FROM (VALUES {weights}) t(path, weight)),
        docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id::VARCHAR, '') AS id, CASE WHEN regexp_matches(source, '^src[0-4]$') THEN 'reference' ELSE 'web' END AS domain,
            coalesce(lang, '{_NONE}') AS lang, coalesce(source, '{_NONE}') AS source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens FROM documents),
        leaf AS (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS tokens, sum(n_tokens)::HUGEINT * {EPOCHS} AS holds FROM docs GROUP BY ALL),
        d0 AS (SELECT domain, sum(holds)::HUGEINT AS holds, 0 AS root, coalesce(any_value(weight), 1)::HUGEINT AS weight, ((SELECT sum(tokens) FROM leaf) * {PERCENT})::HUGEINT // 100 AS given
            FROM leaf LEFT JOIN weights ON path = domain GROUP BY domain),
        {poured('d1', 'd0', 'root', 'domain')},
        l0 AS (SELECT x.*, coalesce(weight, 1)::HUGEINT AS weight, d1.budget AS given FROM (SELECT domain, lang, sum(holds)::HUGEINT AS holds FROM leaf GROUP BY ALL) x
            JOIN (SELECT domain, budget FROM d1) d1 USING (domain) LEFT JOIN weights ON path = domain || '/' || lang),
        {poured('l1', 'l0', 'domain', 'lang')},
        s0 AS (SELECT leaf.*, coalesce(weight, 1)::HUGEINT AS weight, l1.budget AS given FROM leaf JOIN (SELECT domain, lang, budget FROM l1) l1 USING (domain, lang) LEFT JOIN weights ON path = domain || '/' || lang || '/' || source),
        {poured('s1', 's0', 'domain, lang', 'source')},
        plan AS (SELECT domain, lang, source, CASE WHEN tokens = 0 THEN 0 ELSE budget // tokens END AS whole, CASE WHEN tokens = 0 THEN 0 ELSE budget % tokens END AS rest FROM s1),
        keyed AS (SELECT docs.*, whole, rest, sha256('{SEED}:' || whole || ':' || id) AS k FROM docs JOIN plan USING (domain, lang, source)),
        run AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY k RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM keyed),
        stops AS (SELECT domain, lang, source, min(k) AS stop FROM run WHERE rest > 0 AND upto >= rest GROUP BY ALL),
        taken AS (SELECT run.*, (whole + CASE WHEN k <= stop THEN 1 ELSE 0 END)::BIGINT AS times FROM run LEFT JOIN stops USING (domain, lang, source))
        SELECT doc_id, domain, lang, source, n_tokens, unnest(range(1, times + 1)) AS epoch FROM taken"""
