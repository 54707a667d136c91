"""Mixing sources to target weights by Sainte-Laguë apportionment; DataFrame functions only.

Every source is cut, in a seeded order, into cells of a few thousand documents, and each cell's
words into blocks of equal length. Blocks are allotted to sources by highest quotients of their
targets, then to the source's cells by highest quotients of the cell sizes. A cell's quota is
taken as whole passes and then the first blocks of its seeded order, so all of it is arithmetic
on running sums; nothing is expanded block by block.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareline.llm.common import store

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
BLOCK_WORDS = 64
CELL_DOCS = 4096
MOST_REPEATS = 3


def words(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_key(seed: int) -> Column:
    """Seeded pseudo-random order of documents: 60 bits of an MD5 over seed, id and text."""
    parts = F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    return F.conv(F.substring(F.md5(parts), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, repeats: int = MOST_REPEATS) -> DataFrame:
    """(source, sid, n, source_size, target): weights repeat over the sources by code point, null
    last; a target stops at `repeats` times the source's size, the rest shared by weight."""
    per = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    all_, by_name = Window.partitionBy(F.lit(0)), Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("sid", F.row_number().over(by_name) - 1)
    per = per.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), F.pmod("sid", F.lit(len(weights))).cast("int") + 1).cast("double"))
    per = per.withColumn("cap", repeats * F.col("source_size").cast("double")).withColumn("total", F.sum("source_size").over(all_).cast("double"))
    before = Window.partitionBy(F.lit(0)).orderBy(F.col("cap") / F.col("w"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    rest = F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    open_w = F.sum("w").over(all_) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    per = per.withColumn("full", F.col("w") * rest / open_w >= F.col("cap"))
    spent = F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(all_)
    left_w = F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("w"))).over(all_)
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.col("w") * (F.col("total") - spent) / left_w)
    return per.select("source", "sid", "n", "source_size", target.alias("target"))


def apportion(parties: DataFrame, group: list[str], name: str, votes: str, seats: str) -> DataFrame:
    """Sainte-Laguë: `quota` seats for each party of a group, by highest quotients
    votes / (2 k + 1), ties to the smaller name. `seats` is the group's number of seats.

    Rounding votes by the mean votes per seat is off by at most half a seat per party, so only
    quotients that near the border are ranked; all above are given, all below are not."""
    w = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    p = parties.withColumn("__sum", F.sum(votes).over(w)).withColumn("__m", F.count(F.lit(1)).over(w))
    p = p.withColumn("__s0", F.when((F.col("__sum") > 0) & (F.col(seats) > 0), F.floor(F.col(votes) * F.col(seats) / F.col("__sum") + 0.5)).otherwise(0))
    gap = F.abs(F.col(seats) - F.sum("__s0").over(w)) + F.col("__m")
    reach = F.when(F.col("__sum") > 0, F.ceil(gap * F.col(votes) / F.col("__sum")) + 1).otherwise(1)
    p = p.withColumn("__r", reach).withColumn("__lo", F.greatest(F.lit(0), F.col("__s0") - F.col("__r")))
    p = p.withColumn("__open", F.col(seats) - F.sum("__lo").over(w))
    q = p.select(*group, name, "__open", votes, F.explode(F.sequence("__lo", F.col("__s0") + F.col("__r"))).alias("__k"))
    q = q.withColumn("__q", F.col(votes) / (2 * F.col("__k") + 1)).where(F.col("__q") > 0)
    q = q.withColumn("__rank", F.row_number().over(w.orderBy(F.col("__q").desc(), name, "__k"))).where(F.col("__rank") <= F.col("__open"))
    won = q.groupBy(*group, name).agg(F.count(F.lit(1)).alias("__won"))
    return p.join(won, [*group, name], "left").select(*parties.columns, (F.col("__lo") + F.coalesce("__won", F.lit(0))).alias("quota"))


def mix(docs: DataFrame, seed: int = 9, block: int = BLOCK_WORDS, cell_docs: int = CELL_DOCS, weights: tuple = WEIGHTS, repeats: int = MOST_REPEATS) -> DataFrame:
    """`docs` (columns source, size, rk and any others) with sid, source_size, target, taken.

    size is the number of words, rk the seeded order. Null source is a source of its own; a null
    text counts as no words and is never taken. Equal rows are interchangeable. No document gives
    more than `repeats` times its size, and the taken words of a source differ from its target by
    less than a block, or by its capped cells' rounding."""
    sources, _ = store(source_targets(docs.select("source", "size"), weights, repeats), "op9-sources")
    cells_of = F.greatest(F.lit(1), F.ceil(F.col("n") / cell_docs))
    placed = docs.withColumnRenamed("source", "__src").join(sources.select(F.col("source").alias("__s"), "sid", "source_size", "target", cells_of.alias("__cells")), F.col("__src").eqNullSafe(F.col("__s")))
    placed = placed.withColumn("cell", F.pmod("rk", "__cells")).drop("__s", "__cells").withColumnRenamed("__src", "source")
    blocks = F.floor(F.sum("source_size").over(Window.partitionBy(F.lit(0))) / block + 0.5)
    quotas = apportion(sources.withColumn("seats", blocks), [], "sid", "target", "seats").select("sid", F.col("quota").alias("seats"))
    cells, _ = store(placed.groupBy("sid", "cell").agg(F.sum("size").alias("words")), "op9-cells")
    cells = apportion(cells.join(quotas, "sid"), ["sid"], "cell", "words", "seats")
    taken = F.least(F.col("quota") * block, repeats * F.col("words"))
    whole = F.when(F.col("words") > 0, F.floor(taken / F.col("words"))).otherwise(0)
    cells, _ = store(cells.select("sid", "cell", whole.alias("passes"), (taken - whole * F.col("words")).alias("rest")), "op9-quotas")
    up_to = Window.partitionBy("sid", "cell").orderBy("rk", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = placed.withColumn("__end", F.sum("size").over(up_to))
    out = run.join(cells, ["sid", "cell"])
    part = F.greatest(F.lit(0), F.least("__end", "rest") - (F.col("__end") - F.col("size")))
    return out.withColumn("taken", (F.col("passes") * F.col("size") + part).cast("long")).drop("__end", "passes", "rest", "cell")


def sized(docs: DataFrame, seed: int = 9) -> DataFrame:
    return docs.withColumn("size", words("text")).withColumn("rk", order_key(seed))


def mix_documents(docs: DataFrame, seed: int = 9) -> DataFrame:
    """The mixed corpus: each document once per pass over its cell, and once more if the taken
    part of the cell begins or lies in it. Columns of `docs`; rows repeat up to three times."""
    names = {c: f"__d_{c}" for c in docs.columns}
    wide = docs.select(*[F.col(c).alias(n) for c, n in names.items()], F.col("source"), words("text").alias("size"), order_key(seed).alias("rk"))
    mixed = mix(wide, seed)
    copies = F.ceil(F.col("taken") / F.greatest(F.col("size"), F.lit(1)))
    out = mixed.where("taken > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), copies.cast("int"))))
    return out.select(*[F.col(n).alias(c) for c, n in names.items()])
