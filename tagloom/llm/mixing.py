"""Mixing sources to target weights by hierarchical budgeting.

Leaves are (domain, language, source).  A token budget runs down the tree: each
node's budget is split among its children by weight.  A child whose subtree
can't use its share (its tokens times the allowed epochs) takes what it can;
its shortage goes to its siblings first, again by weight, and only what all of
them can't use is missing from their parent, whose own siblings then take it.
As a node's capacity is that of its subtree, filling level by level from the
root gives just this order.

Within a leaf the documents of each epoch have their own seeded order.  A
budget of A tokens out of V is A div V whole epochs, then the prefix of the
next epoch's order whose tokens fit in the rest.  The end of the prefix is
found by two histogram passes over the leading digits of the order key and one
window over the documents of a single slot (one in 65,536), so that no task
sees a whole leaf, however large.  Texts are read twice: once for a slim table
of leaf, identity and tokens, which these passes go over, and once for the
result.  Everything is integer arithmetic on built-in functions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import WORD, cut_lineage

#: Up to so many leaves their thresholds (a few dozen bytes each) are broadcast; beyond it they are joined by key.
BROADCAST_LEAVES = 50_000
#: Hexadecimal digits of the order key that each histogram pass takes.
DIGITS = 2

LEAF = ["__domain", "__language", "__source"]


@dataclass(frozen=True)
class MixWeights:
    """Integer weights of nodes among their siblings; names not listed have ``default``. 0 leaves a node out."""

    domain: dict[str, int] = field(default_factory=dict)
    language: dict[str, int] = field(default_factory=dict)
    source: dict[str, int] = field(default_factory=dict)
    default: int = 1

    def column(self, level: str) -> Column:
        out = F.lit(self.default)
        for name, w in getattr(self, level).items():
            out = F.when(F.col(f"__{level}") == name, F.lit(int(w))).otherwise(out)
        return out.cast("long")


def token_count(text: str = "text") -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def fill(nodes: DataFrame, parents: list[str], name: str, cap: str, weight: str, budget: str, out: str) -> DataFrame:
    """Adds each node's budget: the parent's split by weight, limited by ``cap``, shortages given to siblings."""
    among = Window.partitionBy(*[F.col(p) for p in parents]) if parents else Window.partitionBy(F.lit(0))
    order = among.orderBy((F.col(cap) / F.col(weight)).asc(), F.col(name).asc())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    x = nodes.withColumn("__cap_before", F.coalesce(F.sum(cap).over(before), F.lit(0)))
    x = x.withColumn("__weight_rest", F.sum(weight).over(among) - F.coalesce(F.sum(weight).over(before), F.lit(0)))
    big = lambda c: F.col(c).cast("decimal(38,0)")  # noqa: E731  a product of two longs fits
    x = x.withColumn("__short", big(cap) * big("__weight_rest") <= (big(budget) - big("__cap_before")) * big(weight))
    x = x.withColumn("__used", F.coalesce(F.sum(F.when(F.col("__short"), F.col(cap))).over(among), F.lit(0)))
    x = x.withColumn("__free_weight", F.sum(F.when(~F.col("__short"), F.col(weight))).over(among))
    share = F.expr(f"(CAST({budget} - __used AS decimal(38,0)) * CAST({weight} AS decimal(38,0))) div __free_weight")
    return x.withColumn(out, F.when(F.col("__short"), F.col(cap)).otherwise(share)).drop("__cap_before", "__weight_rest", "__short", "__used", "__free_weight")


def leaf_budgets(leaves: DataFrame, weights: MixWeights, budget: Column, epochs: int) -> DataFrame:
    """(leaf, __tokens) with __budget: what each leaf is to give. ``budget`` may use __total, the tokens of all leaves."""
    x = leaves
    for level in ("domain", "language", "source"):
        x = x.withColumn(f"__w_{level}", weights.column(level))
    total = leaves.agg(F.coalesce(F.sum("__tokens"), F.lit(0)).cast("long").alias("__total"))
    x = x.filter((F.col("__w_domain") > 0) & (F.col("__w_language") > 0) & (F.col("__w_source") > 0))
    x = x.withColumn("__cap", F.col("__tokens") * epochs)
    languages = x.groupBy("__domain", "__language").agg(F.max("__w_domain").alias("__w_domain"), F.max("__w_language").alias("__w_language"), F.sum("__cap").alias("__cap"))
    domains = languages.groupBy("__domain").agg(F.max("__w_domain").alias("__w_domain"), F.sum("__cap").alias("__cap"))
    domains = domains.crossJoin(F.broadcast(total)).withColumn("__budget", budget.cast("long")).drop("__total")
    domains = fill(domains, [], "__domain", "__cap", "__w_domain", "__budget", "__given").select("__domain", "__given")
    languages = languages.join(domains, "__domain")
    languages = fill(languages, ["__domain"], "__language", "__cap", "__w_language", "__given", "__part").select("__domain", "__language", "__part")
    x = x.join(languages, ["__domain", "__language"])
    return fill(x, ["__domain", "__language"], "__source", "__cap", "__w_source", "__part", "__budget").select(*LEAF, "__tokens", "__budget")


def mix(
    docs: DataFrame,
    weights: MixWeights,
    domain: Column,
    budget: Column,
    epochs: int = 2,
    seed: int = 0,
    doc_id: str = "doc_id",
    text: str = "text",
    language: str = "lang",
    source: str = "source",
) -> DataFrame:
    """The rows of ``docs`` with domain, n_tokens and n_copies (0: left out).

    * A null domain, language or source is the node with the empty name.
    * A document without tokens (null, empty, white space) has no copies.
    * Rows that agree in id and text share a place in the order: they are
      taken or left together.
    * Columns that already bear the new names are replaced; an empty table
      gives no rows.
    """
    name = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    columns = [c for c in docs.columns if c not in ("domain", "n_tokens", "n_copies")]
    identity = F.concat_ws(":", F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("__whole").cast("string"), F.col("__identity")).cast("binary"))

    row = F.struct(F.lit(0).alias("0"), *[F.col(f"`{c}`") for c in columns]).alias("__row")  # so that no name in it clashes with one in between
    of_leaf = [name(c).alias(x) for c, x in zip((domain, F.col(language), F.col(source)), LEAF)]
    keyed = docs.select(row, *of_leaf, identity.alias("__identity"), token_count(text).alias("__n"))

    slim = cut_lineage(keyed.drop("__row"))
    leaves = cut_lineage(slim.groupBy(*LEAF).agg(F.sum("__n").alias("__tokens")))
    budgets = leaf_budgets(leaves, weights, budget, epochs)
    whole = F.when(F.col("__tokens") > 0, F.least(F.expr("__budget div __tokens"), F.lit(epochs))).otherwise(0).cast("long")
    budgets = budgets.withColumn("__whole", whole).withColumn("__rest", F.col("__budget") - F.col("__whole") * F.col("__tokens")).drop("__tokens", "__budget")
    budgets = cut_lineage(budgets)
    small = budgets.count() <= BROADCAST_LEAVES
    side = (lambda t: F.broadcast(t)) if small else (lambda t: t)

    # Two passes of leading digits narrow the end of each prefix down to one slot.
    at = budgets.filter(F.col("__rest") > 0).withColumn("__head", F.lit("")).withColumn("__before", F.lit(0).cast("long"))
    for step in (1, 2):
        rows = slim.join(side(at.select(*LEAF, "__whole", "__head")), LEAF).withColumn("__key", key).filter(F.col("__key").startswith(F.col("__head")))
        slots = rows.withColumn("__slot", F.substring("__key", 1, DIGITS * step)).groupBy(*LEAF, "__slot").agg(F.sum("__n").alias("__n"))
        upto = Window.partitionBy(*LEAF).orderBy("__slot").rowsBetween(Window.unboundedPreceding, 0)
        slots = slots.withColumn("__upto", F.sum("__n").over(upto)).join(side(at.select(*LEAF, "__rest", "__before")), LEAF)
        over = slots.filter(F.col("__before") + F.col("__upto") > F.col("__rest"))
        first = over.groupBy(*LEAF).agg(F.min_by(F.struct("__slot", (F.col("__before") + F.col("__upto") - F.col("__n")).alias("b")), "__slot").alias("__f"))
        at = budgets.join(side(first), LEAF).select(*LEAF, "__whole", "__rest", F.col("__f.__slot").alias("__head"), F.col("__f.b").alias("__before"))
        at = cut_lineage(at)
    rows = slim.join(side(at), LEAF).withColumn("__key", key).filter(F.col("__key").startswith(F.col("__head")))
    peers = Window.partitionBy(*LEAF).orderBy("__key").rangeBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("__upto", F.col("__before") + F.sum("__n").over(peers))
    last = rows.filter(F.col("__upto") <= F.col("__rest")).groupBy(*LEAF).agg(F.max("__key").alias("__last"))
    ends = budgets.join(side(at.select(*LEAF, "__head")), LEAF, "left").join(side(last), LEAF, "left")
    ends = cut_lineage(ends.select(*LEAF, "__whole", "__head", "__last"))

    out = keyed.join(side(ends), LEAF, "left").withColumn("__key", key)
    taken = (F.col("__key") < F.col("__head")) | (F.col("__key") <= F.col("__last"))
    copies = F.when(F.col("__n") > 0, F.coalesce(F.col("__whole"), F.lit(0)) + F.when(taken, 1).otherwise(0)).otherwise(0).cast("long")
    return out.select(F.col("__domain").alias("domain"), *[F.col("__row")[c].alias(c) for c in columns], F.col("__n").alias("n_tokens"), copies.alias("n_copies"))


def repeat(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Each row as often as n_copies says; rows without copies go."""
    return mixed.filter(F.col("n_copies") > 0).select(*columns, F.explode(F.sequence(F.lit(1), F.col("n_copies").cast("int"))).alias("__copy")).select(*columns)
