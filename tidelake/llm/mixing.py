"""Mixing sources to target weights by hierarchical token budgets.

The budget goes down a domain - language - source tree.  At each node the children share
it by weight; a child that cannot use its share (its supply times the epochs allowed)
gives the shortage to its siblings first, and only what a whole subtree cannot use goes
to its parent's siblings.  Each leaf's documents are read in epochs, each in a seeded
order of its own: whole epochs, then the longest prefix of the next that fits.

All of it is DataFrame code.  As the last epoch is a prefix of a leaf's order, a leaf needs
one boundary: the first row that does not fit.  It is searched in three steps.  Order keys
are hexadecimal digests, so a prefix of the digest cuts the order into buckets, whose token
sums say in which bucket the budget ends.  That bucket's rows are range-cut along the whole
order, so that rows of one id, and equal rows, fall into several ranges, and sums of ranges
say in which range.  Only that range's rows are summed one by one.  Every row is then held
to its leaf's boundary where it is: no row is moved to be chosen.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelake.llm.shared import table

LEVELS = ("domain", "lang", "source")
#: Hexadecimal digits of the order key that make a bucket.
BUCKET_DIGITS = 3
MOST_WEIGHT = 10_000
#: Leaves whose plans (a few short columns) are broadcast; and the parts a leaf is cut to beyond.
MOST_BROADCAST, SALTS = 50_000, 64


@dataclass(frozen=True)
class Mix:
    """Integer weights by level and name (1 where a name is missing; 0 leaves it out).

    The budget is ``share[0] / share[1]`` of the supply, or ``budget`` tokens.
    """

    weights: Mapping[str, Mapping[str, int]] = field(default_factory=dict)
    share: tuple[int, int] = (1, 1)
    budget: int | None = None
    max_epochs: int = 2
    seed: int = 11

    def __post_init__(self) -> None:
        for level, names in self.weights.items():
            if level not in LEVELS or any(not 0 <= w <= MOST_WEIGHT for w in names.values()):
                raise ValueError(f"weights are integers from 0 to {MOST_WEIGHT} by {LEVELS}")

    def weight(self, level: str) -> Column:
        known = self.weights.get(level) or {}
        if not known:
            return F.lit(1).cast("long")
        table = F.create_map(*(F.lit(x) for kv in sorted(known.items()) for x in kv))
        return F.coalesce(F.try_element_at(table, F.col(level)), F.lit(1)).cast("long")


def word_count(text: Column) -> Column:
    """Words of a text, runs of anything but ASCII white space; null has none.

    Each word becomes a letter and the letters are counted, which makes no array of words.
    """
    letters = F.regexp_replace(F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "w"), r"[\x20\x09-\x0D]+", "")
    return F.coalesce(F.length(letters), F.lit(0)).cast("long")


def _shared(children: DataFrame, parents: list[str], level: str) -> DataFrame:
    """Adds got: each child's part of its parent's budget. children: parents, level, weight, cap, budget."""
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    order = Window.partitionBy(*parents).orderBy(F.try_divide(F.col("cap").cast("double"), F.col("weight").cast("double")).asc_nulls_first(), F.col(level))
    every = Window.partitionBy(*parents)
    first = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    out = children.withColumn("before", F.coalesce(F.sum("cap").over(first), F.lit(0))).withColumn("after", F.sum("weight").over(rest))
    out = out.withColumn("full", wide("cap") * wide("after") <= wide("weight") * (wide("budget") - wide("before")).cast("decimal(19,0)"))
    out = out.withColumn("used", F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(every), F.lit(0)))
    out = out.withColumn("open", F.sum(F.when(~F.col("full"), F.col("weight"))).over(every))
    out = out.withColumn("floor", F.when(F.col("full"), F.col("cap")).otherwise(F.expr("(weight * (budget - used)) div open")))
    out = out.withColumn("left", F.col("budget") - F.sum("floor").over(every))
    out = out.withColumn("turn", F.sum((~F.col("full")).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return out.withColumn("got", F.col("floor") + (~F.col("full") & (F.col("turn") <= F.col("left"))).cast("long"))


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """domain, lang, source, tokens, got for each leaf. leaves: domain, lang, source, tokens."""
    caps = leaves.withColumn("w1", mix.weight("domain")).withColumn("w2", mix.weight("lang")).withColumn("w3", mix.weight("source"))
    used = (F.col("w1") > 0) & (F.col("w2") > 0) & (F.col("w3") > 0)
    caps = caps.withColumn("cap", F.when(used, F.col("tokens") * mix.max_epochs).otherwise(0)).withColumn("root", F.lit(0))
    nodes, path = None, ["root"]
    for level, weight in zip(LEVELS, ("w1", "w2", "w3")):
        children = caps.groupBy(*path, level, weight).agg(F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens"))
        children = children.withColumn("weight", F.when(F.col("cap") > 0, F.col(weight)).otherwise(0))
        if nodes is None:  # a row for each domain: the root's budget is a sum over them
            whole = Window.partitionBy("root")
            supply = F.sum("tokens").over(whole)
            wanted = F.lit(mix.budget).cast("long") if mix.budget is not None else ((supply * mix.share[0] - F.pmod(supply * mix.share[0], F.lit(mix.share[1]))) / mix.share[1]).cast("long")
            shared = children.withColumn("budget", F.least(wanted, F.sum("cap").over(whole)))
        else:
            shared = children.join(nodes, path)
        shared = _shared(shared, path, level)
        path = [*path, level]
        nodes = shared.select(*path, "tokens", F.col("got").alias("budget")) if level == LEVELS[-1] else shared.select(*path, F.col("got").alias("budget"))
    return nodes.select(*LEVELS, "tokens", F.col("budget").alias("got"))


def _with_plan(rows: DataFrame, plan: DataFrame, how: str = "inner") -> DataFrame:
    """rows with their leaf's plan, without moving a leaf's rows to one task.

    The plan has a row for each leaf.  Up to MOST_BROADCAST of them are broadcast; more are
    joined on the leaf and a salt.
    """
    if plan.count() <= MOST_BROADCAST:
        return rows.join(F.broadcast(plan), list(LEVELS), how)
    salted = plan.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).join(salted, [*LEVELS, "salt"], how).drop("salt")


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns of a row; maps, which have no order, are left out."""
    return F.xxhash64(*(F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()))


_ORDER = ("key", "n_tokens", "tie", "row")


def _first_over(sums: DataFrame, by: list[str], piece: str) -> DataFrame:
    """The piece of each leaf in which its tokens pass what is left, and the tokens ahead of it.

    sums: by, piece, tokens, rest: a row for each piece.
    """
    order = Window.partitionBy(*by).orderBy(piece)
    reached = F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    over = sums.withColumn("reached", reached).where("reached > rest")
    first = over.groupBy(*by).agg(F.min(F.struct(piece, (F.col("reached") - F.col("tokens")).alias("ahead"))).alias("f"))
    return first.select(*by, F.col(f"f.{piece}").alias(piece), F.col("f.ahead").alias("ahead"))


def boundaries(narrow: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """LEVELS and the order (key, n_tokens, tie, row) of the first row of each leaf that its last epoch has no room for.

    narrow: id, LEVELS, n_tokens, tie, row.  plan: LEVELS, whole, rest; leaves without a rest
    have no boundary.
    """
    leaf = list(LEVELS)
    rows = _keyed(_with_plan(narrow, plan.where("rest > 0").select(*LEVELS, "whole", "rest")), seed).withColumn("bucket", F.substring("key", 1, BUCKET_DIGITS))
    buckets = rows.groupBy(*leaf, "bucket").agg(F.sum("n_tokens").alias("tokens"), F.any_value("rest").alias("rest"))
    inside = table(_first_over(buckets, leaf, "bucket"), "mix-buckets")
    near = _with_plan(rows.select(*leaf, "bucket", "rest", *_ORDER, "id"), inside.withColumnRenamed("bucket", "at")).where(F.col("bucket") == F.col("at"))
    near = near.select(*leaf, "id", *_ORDER, (F.col("rest") - F.col("ahead")).alias("rest")).repartitionByRange(*leaf, *_ORDER)
    near = table(near.withColumn("piece", F.spark_partition_id()), "mix-near")
    pieces = near.groupBy(*leaf, "piece").agg(F.sum("n_tokens").alias("tokens"), F.any_value("rest").alias("rest"))
    inside = table(_first_over(pieces, leaf, "piece"), "mix-pieces").withColumnRenamed("piece", "at")
    last = _with_plan(near, inside).where(F.col("piece") == F.col("at"))
    within = Window.partitionBy(*leaf).orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    over = last.withColumn("reached", F.col("ahead") + F.sum("n_tokens").over(within)).where("reached > rest")
    return over.groupBy(*leaf).agg(F.min(F.struct(*_ORDER)).alias("b")).select(*leaf, "b")


def _keyed(rows: DataFrame, seed: int) -> DataFrame:
    """rows with key, their place in the order of their leaf's last epoch; they have whole and id."""
    return rows.withColumn("key", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"), F.col("id")).cast("binary")))


def mix_rows(docs: DataFrame, mix: Mix, id_col: Column, domain: Column, lang: Column, source: Column, tokens: Column, payload: list[Column], wide: bool = False) -> DataFrame:
    """payload, domain, lang, source, n_tokens, epoch, leaf_budget of every chosen row.

    Null names are the empty name.  Rows with equal ids share an order key and are taken by
    their tokens, then by a hash of the whole row, so the rows' order in docs decides
    nothing.  In a leaf with tokens, a document without any is in every whole epoch, and in
    the last one if the order comes to it before the budget is spent; a leaf without tokens
    has no budget and gives no rows.  A text counts whole, however long.  An empty table
    gives no rows.

    Tokens are counted once, into a narrow table with the payload; wide payloads stay out
    of it and are read with a second count.  Of equal rows that a boundary falls between,
    as many as fit are taken.
    """
    name = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    kept = [F.coalesce(id_col.cast("string"), F.lit("")).alias("id"), name(domain).alias("domain"), name(lang).alias("lang"), name(source).alias("source"), tokens.alias("n_tokens"), row_hash(docs).alias("tie")]
    own, row = F.struct(*payload).alias("payload"), F.monotonically_increasing_id().alias("row")
    narrow = table(docs.select(*kept, *([] if wide else [own]), row), "mix-tokens")
    leaves = narrow.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    plan = table(leaf_budgets(leaves, mix).where("got > 0").select(
        *LEVELS, F.expr("got div tokens").alias("whole"), F.expr("got % tokens").alias("rest"), F.col("got").alias("leaf_budget"),
    ), "leaf-plan")
    ends = table(boundaries(narrow, plan, mix.seed), "mix-boundaries")
    plan = plan.join(ends, list(LEVELS), "left")
    place = lambda cols, of="": F.struct(*(F.col(f"{of}{c}") for c in cols))

    def chosen(rows: DataFrame, fits: Column) -> DataFrame:
        last = F.when((F.col("rest") > 0) & fits, F.col("whole")).otherwise(F.col("whole") - 1)
        rows = rows.withColumn("last", last).where("last >= 0")
        return rows.select("payload.*", *LEVELS, "n_tokens", F.explode(F.sequence(F.lit(0), F.col("last").cast("int"))).alias("epoch"), "leaf_budget")

    if not wide:
        return chosen(_keyed(_with_plan(narrow, plan), mix.seed), F.coalesce(place(_ORDER) < F.col("b"), F.lit(True)))
    same = _ORDER[:-1]  # what a second reading of docs can tell of a row
    at_end = _keyed(_with_plan(narrow, plan), mix.seed).where(place(same) == place(same, "b."))
    split = at_end.groupBy(*LEVELS).agg(F.count("*").alias("n"), F.count_if(F.col("row") < F.col("b.row")).alias("fit")).where("fit > 0")
    split = table(split, "mix-split")
    rows = _keyed(_with_plan(docs.select(*kept, own), plan), mix.seed)
    clear = F.coalesce(place(same) < place(same, "b."), F.lit(True))
    if split.isEmpty():
        return chosen(rows, clear)
    cut = _with_plan(rows.where(place(same) == place(same, "b.")), split)  # equal rows of a leaf, of which the first few fit
    cut = table(cut.withColumns({"row": F.monotonically_increasing_id(), "part": F.spark_partition_id()}), "mix-equal")
    parts = cut.groupBy(*LEVELS, "part").count()
    ahead = Window.partitionBy(*LEVELS).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*LEVELS, "part", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("before"))
    number = F.row_number().over(Window.partitionBy(*LEVELS, "part").orderBy("row"))
    fits = cut.select(*LEVELS, "part", "row", "fit").withColumn("number", number).join(parts, [*LEVELS, "part"])
    fits = fits.where(F.col("before") + F.col("number") <= F.col("fit")).select("row", F.lit(True).alias("fits"))
    rest = _with_plan(rows, split.select(*LEVELS, "fit"), "left")
    rest = rest.where(F.col("fit").isNull() | (place(same) != place(same, "b.")))
    return chosen(rest, clear).unionByName(chosen(cut.join(fits, "row", "left"), F.coalesce("fits", F.lit(False))))


def mixture(docs: DataFrame, mix: Mix, domain: Column, id_col: str = "doc_id") -> DataFrame:
    """doc_id, domain, lang, source, n_tokens, epoch, leaf_budget of the mixture of docs; other columns are not returned."""
    return mix_rows(docs, mix, F.col(id_col), domain, F.col("lang"), F.col("source"), word_count(F.col("text")), [F.col(id_col).alias("doc_id")])


def mixed_documents(docs: DataFrame, mix: Mix, domain: Column, id_col: str = "doc_id") -> DataFrame:
    """The mixture as rows of docs, with their own columns; a row for each epoch it is in."""
    picked = mix_rows(docs, mix, F.col(id_col), domain, F.col("lang"), F.col("source"), word_count(F.col("text")), [F.struct("*").alias("__doc")], wide=True)
    return picked.select("__doc.*")


def domain_of_source(source: Column) -> Column:
    """The production tree's domains: sources dealt to four by the number in their name."""
    number = F.coalesce(F.regexp_extract(source, "[0-9]+", 0).try_cast("bigint"), F.lit(0))
    return F.concat(F.lit("domain"), (number % 4).cast("string"))


PRODUCTION = Mix(
    weights={"domain": {"domain0": 4, "domain1": 3, "domain2": 2, "domain3": 1}, "lang": {"en": 6, "de": 2, "fr": 2, "es": 1}, "source": {"src0": 2}},
    share=(3, 5),
    max_epochs=2,
)

_SPLIT = """
{name}_a AS (
    SELECT *, coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after
    FROM {name}_in WINDOW o AS (PARTITION BY {parent} ORDER BY CASE WHEN weight = 0 THEN NULL ELSE CAST(cap AS DOUBLE) / CAST(weight AS DOUBLE) END NULLS FIRST, {level})
), {name}_b AS (
    SELECT *, cap * after <= weight * (budget - before) AS is_full FROM {name}_a
), {name}_c AS (
    SELECT *, coalesce(sum(cap) FILTER (WHERE is_full) OVER (PARTITION BY {parent}), 0) AS used, sum(weight) FILTER (WHERE NOT is_full) OVER (PARTITION BY {parent}) AS open FROM {name}_b
), {name}_d AS (
    SELECT *, CASE WHEN is_full THEN cap ELSE (weight * (budget - used)) // open END AS base FROM {name}_c
), {name}_e AS (
    SELECT *, budget - sum(base) OVER (PARTITION BY {parent}) AS remains,
           sum(CASE WHEN is_full THEN 0 ELSE 1 END) OVER (PARTITION BY {parent} ORDER BY CASE WHEN weight = 0 THEN NULL ELSE CAST(cap AS DOUBLE) / CAST(weight AS DOUBLE) END NULLS FIRST, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS turn
    FROM {name}_d
), {name} AS (
    SELECT {keys}, base + CASE WHEN NOT is_full AND turn <= remains THEN 1 ELSE 0 END AS budget FROM {name}_e
)"""


def _case(level: str, mix: Mix) -> str:
    known = mix.weights.get(level) or {}
    return f"CASE {level} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in known.items()) + " ELSE 1 END" if known else "1"


def mixture_sql(mix: Mix = PRODUCTION, documents: str = "documents") -> str:
    """DuckDB SQL for the rows of mixture() with the production domains."""
    return f"""
WITH row0 AS (
    SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS id, 'domain' || CAST(coalesce(TRY_CAST(nullif(regexp_extract(source, '[0-9]+'), '') AS BIGINT), 0) % 4 AS VARCHAR) AS domain,
           coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS n_tokens
    FROM {documents}
), leaf AS (
    SELECT domain, lang, source, sum(n_tokens) AS tokens, {_case("domain", mix)} AS w1, {_case("lang", mix)} AS w2, {_case("source", mix)} AS w3 FROM row0 GROUP BY domain, lang, source
), caps AS (
    SELECT *, CASE WHEN w1 > 0 AND w2 > 0 AND w3 > 0 THEN tokens * {mix.max_epochs} ELSE 0 END AS cap, 0 AS root FROM leaf
), top AS (
    SELECT least({mix.budget if mix.budget is not None else f"(sum(tokens) * {mix.share[0]}) // {mix.share[1]}"}, sum(cap)) AS budget FROM caps
), n1_in AS (
    SELECT root, domain, sum(cap) AS cap, CASE WHEN sum(cap) > 0 THEN w1 ELSE 0 END AS weight, any_value(budget) AS budget FROM caps, top GROUP BY root, domain, w1
), {_SPLIT.format(name="n1", parent="root", level="domain", keys="domain")}, n2_in AS (
    SELECT caps.domain, lang, sum(cap) AS cap, CASE WHEN sum(cap) > 0 THEN w2 ELSE 0 END AS weight, any_value(budget) AS budget FROM caps JOIN n1 ON caps.domain = n1.domain GROUP BY caps.domain, lang, w2
), {_SPLIT.format(name="n2", parent="domain", level="lang", keys="domain, lang")}, n3_in AS (
    SELECT caps.domain, caps.lang, source, tokens, cap, CASE WHEN cap > 0 THEN w3 ELSE 0 END AS weight, budget FROM caps JOIN n2 ON caps.domain = n2.domain AND caps.lang = n2.lang
), {_SPLIT.format(name="n3", parent="domain, lang", level="source", keys="domain, lang, source, tokens")}, plan AS (
    SELECT *, budget // tokens AS whole, budget % tokens AS rest FROM n3 WHERE budget > 0
), keyed AS (
    SELECT row0.*, plan.whole, plan.rest, plan.budget, md5('{mix.seed}:' || CAST(CAST(plan.whole AS BIGINT) AS VARCHAR) || ':' || id) AS key
    FROM row0 JOIN plan ON row0.domain = plan.domain AND row0.lang = plan.lang AND row0.source = plan.source
), placed AS (
    SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS reached FROM keyed
), chosen AS (
    SELECT *, CAST(CASE WHEN rest > 0 AND reached <= rest THEN whole ELSE whole - 1 END AS BIGINT) AS last FROM placed
)
SELECT {{columns}}, CAST(unnest(range(0, last + 1)) AS INTEGER) AS epoch FROM chosen WHERE last >= 0
""".replace("{columns}", "doc_id, domain, lang, source, CAST(n_tokens AS BIGINT) AS n_tokens, CAST(budget AS BIGINT) AS leaf_budget")
