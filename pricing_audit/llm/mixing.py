"""Mixing sources to target weights by budgets that go down a tree of domain, language and source.

Each node shares its budget among its children in proportion to their weights; a child that has
less than its share (its tokens times the most epochs) gives what it can, and the shortage goes to its
siblings. Only what all siblings together can't take is short at their parent, and there goes to
the parent's siblings. A leaf's budget is so many whole epochs of its documents and, of one epoch more,
the documents first in that epoch's seeded order, as long as their tokens fit.

Texts never move: documents are summed up to leaves, leaves to the tree, and a leaf's selection is a
cut in the seeded order, found from sums over ``BUCKETS`` stretches of it and the one stretch the cut
falls in. So a leaf with a third of all rows is summed by many tasks. All amounts are whole numbers.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import spread, stage
from .common import sized_join, whole_text

BUCKETS = 4096
LEVELS = ("domain", "lang", "source")
WORD = r"[^\x20\x09-\x0D]+"
_HASH_BITS = 60


@dataclass(frozen=True)
class Plan:
    """Weights are whole numbers from 1 (names not listed weigh 1); the budget is a share of all
    tokens in millionths."""

    budget: int = 600_000
    most_epochs: int = 2
    seed: int = 20
    domains: int = 4
    weights: Mapping[str, Mapping[str, int]] = field(default_factory=dict)

    def __post_init__(self):
        if any(w < 1 for level in self.weights.values() for w in level.values()):
            raise ValueError("weights are whole numbers from 1; filter out what should not appear")

    def domain(self) -> Column:
        """The tables name no domain, so sources are dealt to ``domains`` groups by checksum."""
        number = F.crc32(F.coalesce(F.col("source"), F.lit("")).cast("binary")) % self.domains
        return F.concat(F.lit("d"), number.cast("string"))

    def weight(self, level: str) -> Column:
        given = self.weights.get(level, {})
        if not given:
            return F.lit(1).cast("long")
        table = F.create_map(*[F.lit(x) for pair in given.items() for x in pair])
        return F.coalesce(F.try_element_at(table, F.col(level)), F.lit(1)).cast("long")


DEFAULT = Plan(
    weights={
        "domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 2},
    }
)


def place_in_epoch(key: Column, epoch: Column, seed: int) -> Column:
    """The document's number in the seeded order of an epoch, 0 to 2**60 - 1."""
    text = F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), key)
    return F.conv(F.substring(F.md5(text), 1, _HASH_BITS // 4), 16, 10).cast("long")


def document_key() -> Column:
    """What orders a document: its id, or for a null id its text."""
    return F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), F.md5(whole_text())))


def _share(nodes: DataFrame, parents: Sequence[str], name: str) -> DataFrame:
    """Adds ``given`` to nodes with weight, cap and the parent's ``budget``."""
    family = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    order = family.orderBy((F.col("cap") / F.col("weight")), name).rowsBetween(Window.unboundedPreceding, -1)
    nodes = nodes.withColumns(
        {
            "caps_before": F.coalesce(F.sum("cap").over(order), F.lit(0)),
            "weight_from": F.sum("weight").over(family) - F.coalesce(F.sum("weight").over(order), F.lit(0)),
        }
    ).withColumn("full", F.expr("cap * weight_from <= (budget - caps_before) * weight"))
    rest = F.col("budget") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(family)
    others = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(family)
    nodes = nodes.withColumns({"rest": rest, "others": others}).withColumn(
        "given", F.expr("if(full, cap, (rest * weight) div nullif(others, 0))")
    )
    nodes = nodes.withColumns(
        {
            "short": F.col("budget") - F.sum("given").over(family),
            "turn": F.row_number().over(family.orderBy("full", name)),
        }
    ).withColumn("given", F.expr("given + if(not full and turn <= short, 1, 0)"))
    return nodes.drop("caps_before", "weight_from", "full", "rest", "others", "short", "turn", "budget")


def leaf_budgets(leaves: DataFrame, plan: Plan) -> DataFrame:
    """(domain, lang, source, tokens, given) from (domain, lang, source, tokens)."""
    leaves = leaves.withColumns(
        {"cap": F.col("tokens") * plan.most_epochs, "weight": plan.weight("source")}
    )
    langs = leaves.groupBy("domain", "lang").agg(F.sum("cap").alias("cap")).withColumn("weight", plan.weight("lang"))
    domains = langs.groupBy("domain").agg(F.sum("cap").alias("cap")).withColumn("weight", plan.weight("domain"))
    root = leaves.agg(
        F.least(F.expr(f"cast(sum(cast(tokens as decimal(38))) * {plan.budget} div 1000000 as long)"), F.sum("cap"))
        .alias("budget")
    )
    domains = _share(domains.join(F.broadcast(root)), [], "domain")
    langs = langs.join(domains.select("domain", F.col("given").alias("budget")), "domain")
    langs = _share(langs, ["domain"], "lang")
    leaves = leaves.join(langs.select("domain", "lang", F.col("given").alias("budget")), ["domain", "lang"])
    return _share(leaves, ["domain", "lang"], "source").select(*LEVELS, "tokens", "given")


def _summary(docs: DataFrame, plan: Plan) -> DataFrame:
    unknown = {x: F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("lang", "source")}
    return docs.select(
        "doc_id", plan.domain().alias("domain"), unknown["lang"].alias("lang"), unknown["source"].alias("source"),
        document_key().alias("key"), F.call_function("regexp_count", whole_text(), F.lit(WORD)).cast("long").alias("n_tokens"),
    )


def leaf_cuts(documents: DataFrame, plan: Plan) -> DataFrame:
    """Per leaf: whole epochs, and the last place in the next epoch's order that is still taken."""
    leaves = stage(documents.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")), "leaves")
    given = stage(leaf_budgets(leaves, plan), "budgets").select(
        *LEVELS, F.expr("coalesce(given div nullif(tokens, 0), 0)").alias("epochs"),
        F.expr("coalesce(given % nullif(tokens, 0), 0)").alias("rest"),
    )
    placed = sized_join(
        documents, given.withColumnsRenamed({x: f"leaf_{x}" for x in LEVELS}),
        [F.col(x) == F.col(f"leaf_{x}") for x in LEVELS], "inner",
    ).filter("rest > 0").select(
        *LEVELS, "epochs", "rest", "n_tokens", place_in_epoch(F.col("key"), F.col("epochs"), plan.seed).alias("place")
    ).withColumn("stretch", F.shiftright("place", _HASH_BITS - (BUCKETS.bit_length() - 1)))
    sums = placed.groupBy(*LEVELS, "rest", "stretch").agg(
        F.sum("n_tokens").alias("n"), F.max("place").alias("last")
    )
    line = Window.partitionBy(*LEVELS).orderBy("stretch").rowsBetween(Window.unboundedPreceding, 0)
    sums = stage(sums.withColumn("upto", F.sum("n").over(line)), "stretches")
    whole = sums.filter("upto <= rest").groupBy(*LEVELS).agg(F.max("last").alias("cut"))
    edge = (
        sums.filter("upto > rest").groupBy(*LEVELS).agg(F.min("stretch").alias("stretch"))
        .join(sums.select(*LEVELS, "stretch", (F.col("upto") - F.col("n")).alias("before")), [*LEVELS, "stretch"])
    )
    inside = Window.partitionBy(*LEVELS).orderBy("place").rangeBetween(Window.unboundedPreceding, 0)
    partial = (
        placed.join(edge, [*LEVELS, "stretch"])
        .withColumn("upto", F.col("before") + F.sum("n_tokens").over(inside))
        .filter("upto <= rest").groupBy(*LEVELS).agg(F.max("place").alias("edge_cut"))
    )
    return given.join(whole, list(LEVELS), "left").join(partial, list(LEVELS), "left").select(
        *LEVELS, "epochs",
        F.greatest(F.coalesce("cut", F.lit(-1)), F.coalesce("edge_cut", F.lit(-1))).alias("cut"),
    )


def _copies(plan: Plan) -> Column:
    extra = place_in_epoch(F.col("key"), F.col("epochs"), plan.seed) <= F.col("cut")
    return (F.col("epochs") + F.when(extra, 1).otherwise(0)).cast("int")


def mix(docs: DataFrame, plan: Plan = DEFAULT) -> DataFrame:
    """Per document: doc_id, domain, lang, source, n_tokens, copies (0: not in the mix).

    Tokens are words. Null lang and source count as one unnamed value each; a null text has no
    tokens, and documents without tokens go with those around them in their leaf's order (a leaf
    without any tokens gives nothing). Rows with the same id stand at one place and are taken
    together, null ids with the same text likewise. Empty input gives no rows. Other columns
    are not read.
    """
    rows = spread(docs.select("doc_id", "text", "lang", "source"))
    documents = stage(_summary(rows, plan), "documents")
    cuts = stage(leaf_cuts(documents, plan), "cuts")
    joined = sized_join(
        documents, cuts.withColumnsRenamed({x: f"leaf_{x}" for x in LEVELS}),
        [F.col(x) == F.col(f"leaf_{x}") for x in LEVELS], "inner",
    )
    return joined.select("doc_id", *LEVELS, "n_tokens", _copies(plan).alias("copies"))


def mixed_documents(docs: DataFrame, plan: Plan = DEFAULT) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    rows = docs.select("doc_id", "text", "lang", "source")
    documents = stage(_summary(spread(rows), plan), "documents")
    cuts = stage(leaf_cuts(documents, plan), "cuts").select(
        *[F.col(x).alias(f"__{x}") for x in (*LEVELS, "epochs", "cut")]
    )
    on = [
        plan.domain() == F.col("__domain"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")) == F.col("__lang"),
        F.coalesce(F.col("source").cast("string"), F.lit("")) == F.col("__source"),
    ]
    extra = place_in_epoch(document_key(), F.col("__epochs"), plan.seed) <= F.col("__cut")
    copies = (F.col("__epochs") + F.when(extra, 1).otherwise(0)).cast("int")
    taken = sized_join(docs, cuts, on, "inner").withColumn("__copies", copies).filter("__copies > 0")
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*docs.columns)
