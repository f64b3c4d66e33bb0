"""Mixing sources to target weights by budgets over a tree, with whole seeded epochs and a prefix.

The tree is given by ordered columns, such as domain, language and source. A budget of tokens flows
from the root to the leaves by weight. A child that has too few tokens gets all it has, and what it
lacks goes to its siblings first; only what a whole subtree lacks reaches the siblings of its parent.

A leaf that owes more tokens than it has repeats its documents, epoch by epoch in a seeded order. The
last epoch is a prefix of that order, cut to the token. Budgets are whole numbers, exact at every
size: the tokens left over by division go to the first children.

The order within a leaf is never sorted as a whole. Tokens are summed per leading digits of the order
key, which finds the digits the cut falls into, and only documents with those digits are ranked.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.operators.skew import join_unique
from daybook.session import checkpointed

WORD = r"[^\x20\x09-\x0D]+"
BROADCAST_LEAVES = 200_000  # rows of about 100 bytes
DIGITS = 4  # hex digits of the order key that are summed: 65,536 groups of a leaf

_WIDE = "decimal(20,0)"


@dataclass(frozen=True)
class Level:
    """A level of the tree: its column, weights by value (positive integers), weight of all others."""

    column: str
    weights: Mapping[str, int] = field(default_factory=dict)
    other: int = 1

    def weight(self) -> Column:
        if not self.weights:
            return F.lit(self.other)
        known = F.create_map(*[F.lit(x) for pair in self.weights.items() for x in pair])
        return F.coalesce(F.try_element_at(known, F.col(self.column)), F.lit(self.other))


def token_count(text: Column) -> Column:
    """Words between ASCII white space; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _share(nodes: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """Split ``budget`` of each parent over its children (weight, has) into ``share``.

    Children are taken by how soon they run out. Those that do get all they have; the rest of the
    budget is divided by weight among the others.
    """
    siblings = Window.partitionBy(*parent).orderBy(F.col("has") / F.col("weight"), F.col(name))
    before = siblings.rowsBetween(Window.unboundedPreceding, -1)
    after = siblings.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everyone = Window.partitionBy(*parent)
    has, weight, budget = (F.col(c).cast(_WIDE) for c in ("has", "weight", "budget"))
    taken = F.coalesce(F.sum(has).over(before), F.lit(0)).cast(_WIDE)
    short = has * F.sum(weight).over(after).cast(_WIDE) <= weight * (budget - taken)
    nodes = nodes.withColumn("__short", short)
    others = F.sum(F.when(~F.col("__short"), weight)).over(everyone).cast(_WIDE)
    spent = F.sum(F.when(F.col("__short"), has)).over(everyone)
    nodes = nodes.withColumn("__rest", (budget - F.coalesce(spent, F.lit(0))).cast(_WIDE))
    nodes = nodes.withColumn("__others", others).withColumn(
        "share",
        F.when(F.col("__short"), F.col("has")).otherwise(
            F.expr(f"(cast(weight as {_WIDE}) * __rest) div __others")
        ),
    )
    given = F.sum(F.when(~F.col("__short"), F.col("share"))).over(everyone)
    place = F.sum(F.when(~F.col("__short"), 1)).over(siblings)
    left_over = (F.col("__rest") - given).cast("long")
    extra = F.when(~F.col("__short") & (place <= left_over), 1).otherwise(0)
    return nodes.withColumn("share", (F.col("share") + extra).cast("long")).drop(
        "__short", "__others", "__rest"
    )


def budgets(leaves: DataFrame, levels: Sequence[Level], total: int, max_epochs: int) -> DataFrame:
    """leaves with ``budget``: tokens each leaf gives, from its ``tokens`` and the weights above it.

    The sum is ``total``, or all the tree can give in ``max_epochs`` epochs where that is less.
    """
    names = [level.column for level in levels]
    leaves = leaves.withColumn("has", F.col("tokens") * max_epochs)
    above = None
    for depth, level in enumerate(levels):
        path = names[: depth + 1]
        nodes = leaves.groupBy(*path).agg(F.sum("has").alias("has"))
        nodes = nodes.withColumn("weight", level.weight().cast("long"))
        if above is None:
            nodes = nodes.withColumn("budget", F.lit(total).cast("long"))
        else:
            nodes = _same(nodes, above, path[:-1], "inner")
        above = _share(nodes, path[:-1], level.column).select(*path, F.col("share").alias("budget"))
    return _same(leaves.drop("has"), above, names, "inner")


def _same(left: DataFrame, right: DataFrame, names: Sequence[str], how: str) -> DataFrame:
    """Join on path columns, which are never NULL here."""
    return left.join(right, list(names), how)


def _with_leaf(docs: DataFrame, leaves: DataFrame, names: Sequence[str]) -> DataFrame:
    """Documents with the row of their leaf, which is one of ``leaves`` that are written already.

    Up to ``BROADCAST_LEAVES`` no document is moved; beyond that hot leaves are split.
    """
    if leaves.count() <= BROADCAST_LEAVES:
        return docs.join(F.broadcast(leaves), list(names))
    return join_unique(docs, leaves, names)


def plan(
    docs: DataFrame, levels: Sequence[Level], total: int | None, max_epochs: int, seed: int
) -> DataFrame:
    """What each leaf gives: tokens, budget, whole ``epochs``, and the cut of its last one.

    ``docs`` has the path columns, ``doc_id`` and ``n_tokens``. Without ``total`` the mixture has as many
    tokens as docs. ``cut`` is the order key the cut falls on, ``left`` the tokens taken of the
    ``at_cut`` tokens there; all three are NULL where whole epochs use up the budget.
    """
    names = [level.column for level in levels]
    leaves = checkpointed(
        docs.groupBy(*names).agg(
            F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("documents")
        )
    )
    if total is None:
        total = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    shared = budgets(leaves, levels, int(total), max_epochs)
    tokens, budget = F.col("tokens"), F.col("budget")
    epochs = F.when(tokens > 0, F.expr("budget div tokens")).otherwise(0)
    shared = shared.withColumn("epochs", epochs).withColumn("rest", budget - F.col("epochs") * tokens)
    shared = checkpointed(shared)

    open_leaves = shared.filter("rest > 0").select(*names, "epochs", "rest")
    placed = _with_leaf(docs, open_leaves, names).withColumn("place", order_key(seed))
    group = F.substring("place", 1, DIGITS)
    sums = placed.groupBy(*names, "rest", group.alias("digits")).agg(F.sum("n_tokens").alias("n"))
    running = Window.partitionBy(*names).orderBy("digits")
    sums = sums.withColumn("before", F.sum("n").over(running) - F.col("n"))
    hit = sums.filter("before < rest AND rest <= before + n")
    hit = checkpointed(hit.select(*names, "digits", (F.col("rest") - F.col("before")).alias("rest")))
    near = _with_leaf(placed.drop("rest").withColumn("digits", group), hit, [*names, "digits"])
    blocks = near.groupBy(*names, "rest", "place").agg(F.sum("n_tokens").alias("n"))
    running = Window.partitionBy(*names).orderBy("place")
    blocks = blocks.withColumn("before", F.sum("n").over(running) - F.col("n"))
    cuts = blocks.filter("before < rest AND rest <= before + n").select(
        *names,
        F.col("place").alias("cut"),
        (F.col("rest") - F.col("before")).alias("left"),
        F.col("n").alias("at_cut"),
    )
    return checkpointed(shared.drop("rest").join(cuts, names, "left"))


def order_key(seed: int) -> Column:
    """Place of a document in the last epoch of its leaf; rows with one id share a place."""
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.md5(F.concat_ws(":", F.lit(str(seed)), (F.col("epochs") + 1).cast("string"), id_text))


def mix(
    docs: DataFrame,
    levels: Sequence[Level],
    total: int | None = None,
    max_epochs: int = 4,
    seed: int = 7,
) -> DataFrame:
    """All rows of docs with its leaf's ``budget``, ``epochs`` and ``prefix_tokens``.

    ``epochs`` is how often a row is taken whole.

    ``docs`` has the path columns (no NULLs), ``doc_id``, ``n_tokens`` and, where whole rows are wanted
    back, a struct ``row``; other columns are left out.
    ``prefix_tokens`` is what the last, partial epoch takes of the row: all, a prefix of its tokens, or
    0. Rows with the same id stand at the same place; at the cut each gives its share, rounded
    down. Rows without tokens follow their leaf's whole epochs. An empty table gives no rows.
    """
    names = [level.column for level in levels]
    whole = ["row"] if "row" in docs.columns else []
    docs = docs.select("doc_id", *names, "n_tokens", *whole)
    leaves = plan(docs.drop("row"), levels, total, max_epochs, seed)
    placed = _with_leaf(docs, leaves.drop("documents"), names).withColumn("__place", order_key(seed))
    part = (
        F.when(F.col("cut").isNull(), 0)
        .when(F.col("__place") < F.col("cut"), F.col("n_tokens"))
        .when(
            F.col("__place") == F.col("cut"),
            F.expr(f"(cast(n_tokens as {_WIDE}) * left) div at_cut"),
        )
        .otherwise(0)
    )
    return placed.withColumn("prefix_tokens", part.cast("long")).drop(
        "__place", "cut", "left", "at_cut", "tokens"
    )


# The tree that the registered query and the pipeline use.
DOMAINS = ("web", "books", "code", "forum")
TREE = (
    Level("domain", {"web": 40, "books": 30, "code": 20, "forum": 10}, other=5),
    Level("lang", {"en": 50, "de": 20, "fr": 20, "es": 10}, other=5),
    Level("source"),
)


def domain_of(source: Column) -> Column:
    """Sources ``src<n>`` go to the domains in turn; any other one is ``other``."""
    number = F.regexp_extract(source, "^src([0-9]{1,9})$", 1)
    place = F.when(number == "", len(DOMAINS)).otherwise(F.try_to_number(number, F.lit("999999999")) % len(DOMAINS))
    return F.element_at(F.array(*map(F.lit, (*DOMAINS, "other"))), place.cast("int") + 1)


def leaf_columns(docs: DataFrame, *more: Column) -> DataFrame:
    """doc_id, domain, lang, source and n_tokens of each row; a NULL language or source is empty."""
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    return docs.select(
        "doc_id",
        domain_of(source).alias("domain"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"),
        source.alias("source"),
        token_count(F.col("text").cast("string")).alias("n_tokens"),
        *more,
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The documents of the mixture with their columns, a row per time a document is taken.

    Documents stay whole: one that the cut of the last epoch falls into is taken. Sources below their
    share repeat, sources above it lose documents; that is what the weights ask for.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = leaf_columns(docs, row.alias("row"))
    taken = mix(keyed, TREE)
    times = F.col("epochs") + (F.col("prefix_tokens") > 0).cast("int")
    repeated = taken.select("row", F.explode(F.array_repeat(F.lit(1), times.cast("int"))).alias("__n"))
    return repeated.select("row.*")


def _share_sql(name: str, source: str, parent: str, child: str) -> str:
    """One level of the tree: shares of the children of each parent."""
    order = f"PARTITION BY {parent} ORDER BY has::DOUBLE / weight, {child}"
    return f"""
    {name}_1 AS (
      SELECT *, coalesce(sum(has) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken,
             sum(weight) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after
      FROM {source}),
    {name}_2 AS (SELECT *, has * after <= weight * (budget - taken) AS short FROM {name}_1),
    {name}_3 AS (
      SELECT *, sum(CASE WHEN NOT short THEN weight END) OVER (PARTITION BY {parent}) AS others,
             budget - coalesce(sum(CASE WHEN short THEN has END) OVER (PARTITION BY {parent}), 0) AS rest
      FROM {name}_2),
    {name}_4 AS (SELECT *, CASE WHEN short THEN has ELSE (weight * rest) // others END AS part FROM {name}_3),
    {name} AS (
      SELECT *, part + CASE WHEN NOT short AND
               sum(CASE WHEN NOT short THEN 1 END) OVER ({order})
               <= rest - sum(CASE WHEN NOT short THEN part END) OVER (PARTITION BY {parent})
             THEN 1 ELSE 0 END AS share
      FROM {name}_4)"""


def _weight_sql(level: Level) -> str:
    cases = " ".join(f"WHEN '{value}' THEN {weight}" for value, weight in level.weights.items())
    return f"(CASE {level.column} {cases} ELSE {level.other} END)" if cases else str(level.other)


def mix_sql(max_epochs: int = 4, seed: int = 7) -> str:
    """The rows of ``mix`` over documents with ``TREE``, as many tokens as there are."""
    domains = " ".join(f"WHEN {k} THEN '{name}'" for k, name in enumerate(DOMAINS))
    return f"""
    WITH d AS (
      SELECT doc_id,
             CASE try_cast(regexp_extract(source, '^src([0-9]{{1,9}})$', 1) AS INTEGER) % {len(DOMAINS)}
               {domains} ELSE 'other' END AS domain,
             coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             coalesce(len(regexp_extract_all(text, '[^ \\t-\\r]+')), 0)::HUGEINT AS n_tokens
      FROM documents),
    leaves AS (SELECT domain, lang, source, sum(n_tokens) AS tokens FROM d GROUP BY ALL),
    domains AS (
      SELECT domain, sum(tokens) * {max_epochs} AS has, {_weight_sql(TREE[0])}::HUGEINT AS weight,
             (SELECT sum(tokens) FROM leaves) AS budget
      FROM leaves GROUP BY ALL),
    {_share_sql("by_domain", "domains", "1", "domain")},
    langs AS (
      SELECT l.domain, l.lang, sum(tokens) * {max_epochs} AS has,
             {_weight_sql(TREE[1]).replace("CASE lang", "CASE l.lang")}::HUGEINT AS weight,
             any_value(share) AS budget
      FROM leaves l JOIN by_domain b ON b.domain = l.domain GROUP BY l.domain, l.lang),
    {_share_sql("by_lang", "langs", "domain", "lang")},
    sources AS (
      SELECT l.domain, l.lang, l.source, tokens, tokens * {max_epochs} AS has,
             {_weight_sql(TREE[2])}::HUGEINT AS weight, share AS budget
      FROM leaves l JOIN by_lang b ON b.domain = l.domain AND b.lang = l.lang),
    {_share_sql("by_source", "sources", "domain, lang", "source")},
    leaf AS (
      SELECT domain, lang, source, share AS budget,
             CASE WHEN tokens > 0 THEN share // tokens ELSE 0 END AS epochs,
             CASE WHEN tokens > 0 THEN share % tokens ELSE 0 END AS rest
      FROM by_source),
    placed AS (
      SELECT d.*, budget, epochs, rest,
             md5(concat_ws(':', '{seed}', (epochs + 1)::VARCHAR, coalesce(doc_id::VARCHAR, ''))) AS place
      FROM d JOIN leaf USING (domain, lang, source)),
    blocks AS (
      SELECT domain, lang, source, place, sum(n_tokens) AS n,
             sum(sum(n_tokens)) OVER (PARTITION BY domain, lang, source ORDER BY place) - sum(n_tokens) AS before
      FROM placed GROUP BY domain, lang, source, place)
    SELECT doc_id, domain, lang, source, n_tokens::BIGINT AS n_tokens, budget::BIGINT AS budget,
           epochs::BIGINT AS epochs,
           (CASE WHEN before + n <= rest THEN n_tokens
                 WHEN before < rest THEN n_tokens * (rest - before) // n ELSE 0 END)::BIGINT AS prefix_tokens
    FROM placed JOIN blocks USING (domain, lang, source, place)
    """
