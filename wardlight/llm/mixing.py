"""Sources mixed to target weights by a splitting tree of block quotas.

1. Targets: all words are shared out by the sources' weights; a source stops at
   ``max_repeats`` times its own words and the excess is shared again.
2. Each source's documents fall into blocks by a seeded hash, which is a random
   permutation of them cut into bounded blocks. A source gives every block for
   each whole pass its target holds, then blocks in order until the target is
   reached; within the last block documents are picked to come nearest, and
   room that stays goes to the blocks behind it until no document fits.
3. Every pass of a block is one unit. Units are divided among output shards
   from the root of a binary tree: a node's units, counted by source, are
   divided between its children by a multivariate hypergeometric draw, so each
   shard's counts are exact and together they use up every unit once.
4. A shard takes its units as consecutive runs of each source's permuted units,
   and orders its documents by a seeded hash.

Only counts go through the tree, one row per node with one count per source: it is
meant for up to some ten thousand sources. A document is taken as often as the
tree has dealt a unit of its block that holds it; texts move once, to their shard.
All of it is DataFrame operations. Draws depend on seed, node and source alone, so
reruns agree.

Defined cases: null text or a text without words has size 0 and is never taken;
a null source is a source of its own, the last; repeated rows are documents of
their own, except that rows with equal ``doc_id`` and size are picked together
in a source's last blocks; an empty table gives an empty mix; further columns
of any name are carried along by :func:`mixed_documents` and, but for the two it
adds, by :func:`mixture`, and never read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardlight.session import settled

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
# Documents of one block, on average.
BLOCK_DOCS = 512
# Words of one output shard, about; their number is a power of two.
SHARD_WORDS = 1 << 24
# Levels of the tree that one plan works; their counts are then written.
_LEVELS = 3


@dataclass(frozen=True)
class Mix:
    """A worked-out mix: sizes per document, the taken blocks, and the targets."""

    documents: DataFrame   # doc_id, mix_source, size, mix_ticket
    targets: DataFrame     # mix_source, source_size, target, blocks
    blocks: DataFrame      # mix_source, mix_block, passes, tickets
    units: DataFrame       # mix_source, mix_block, mix_pass, shard


def text_size(text: Column) -> Column:
    """Number of words of a text; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _ticket(seed: int) -> Column:
    return F.xxhash64(F.col("doc_id"), F.col("size"), F.lit(seed))


def _uniform(*parts: Column) -> Column:
    """A repeatable number in (0, 1)."""
    return (F.pmod(F.xxhash64(*parts), F.lit(1 << 40)) + F.lit(0.5)) / F.lit(float(1 << 40))


def source_targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS,
                   max_repeats: int = 3) -> DataFrame:
    """Adds ``target`` to one row per source (``mix_source``, ``source_size``).

    The sources that stop at their limit are those whose limit per weight is
    lowest, so one pass in that order settles all of them: a source stops if
    its limit is below its share of what the ones before it have left. The
    windows span one row per source.
    """
    position = Window.orderBy(F.col("mix_source").asc_nulls_last())
    arms = F.array(*(F.lit(w) for w in weights))
    weighted = totals.withColumn("weight", F.element_at(
        arms, (F.pmod(F.row_number().over(position) - 1, F.lit(len(weights))) + 1).cast("int")
    ).cast("bigint"))
    limit = F.col("source_size") * max_repeats
    tightest = Window.orderBy(limit / F.col("weight"), F.col("mix_source").asc_nulls_last())
    before = tightest.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    shared = weighted.withColumns({
        "left_size": F.sum("source_size").over(whole)
        - F.coalesce(F.sum(limit).over(before), F.lit(0)),
        "left_weight": F.sum("weight").over(whole)
        - F.coalesce(F.sum("weight").over(before), F.lit(0)),
    }).withColumn("stops", F.col("left_size") * F.col("weight") > limit * F.col("left_weight"))
    # The first source that does not stop fixes the level for all that follow.
    free = F.when(~F.col("stops"), F.struct("left_weight", "left_size"))
    level = shared.withColumn("level", F.max(free).over(whole))
    share = (F.col("level.left_size") * F.col("weight")).cast("double") / F.col(
        "level.left_weight")
    return level.select("mix_source", "source_size", "docs", F.when(
        F.col("stops"), limit.cast("double")).otherwise(share).alias("target"))


def running_total(rows: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` up to each row of its source, by the integer ``order``.

    Rows are summed in runs of 4096 order values first, so that a window holds
    one run, or one row per run, however large a source is.
    """
    runs = rows.withColumn("run", F.floor(F.col(order) / 4096))
    earlier = (Window.partitionBy("mix_source").orderBy("run")
               .rowsBetween(Window.unboundedPreceding, -1))
    sums = (runs.groupBy("mix_source", "run").agg(F.sum(value).alias("sum"))
            .select(F.col("mix_source").alias("e_source"), F.col("run").alias("e_run"),
                    F.coalesce(F.sum("sum").over(earlier), F.lit(0))
                    .alias("earlier")))
    inside = (Window.partitionBy("mix_source", "run").orderBy(order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (runs.join(sums, F.col("mix_source").eqNullSafe(F.col("e_source"))
                      & (F.col("run") == F.col("e_run")))
            .withColumn(name, F.col("earlier") + F.sum(value).over(inside))
            .drop("run", "e_source", "e_run", "earlier"))


def _blocks_taken(documents: DataFrame, targets: DataFrame) -> DataFrame:
    """Passes over each block, and the tickets picked once more in a source's last block."""
    located = located_in_blocks(documents, targets)
    sizes = located.groupBy("mix_source", "mix_block").agg(F.sum("size").alias("block_size"))
    same = F.col("b.mix_source").eqNullSafe(F.col("t.mix_source"))
    placed = (running_total(sizes, "mix_block", "block_size", "end_size").alias("b")
              .join(targets.alias("t"), same)
              .select("b.*", "t.target", "t.source_size"))
    passes = F.when(F.col("source_size") > 0,
                    F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("bigint")
    marked = settled(placed.withColumn("passes", passes.cast("bigint")).withColumn(
        "rest", rest).select(
        "mix_source", "mix_block", "passes",
        (F.col("end_size") <= F.col("rest")).alias("whole"),
        F.greatest(F.lit(0), F.col("rest") - F.col("end_size") + F.col("block_size"))
        .alias("room")), "mix-marked")
    # Rows with one ticket stand for one pick of all of them together.
    tickets = settled(located.groupBy("mix_source", "mix_block", "mix_ticket").agg(
        F.sum("size").alias("size")), "mix-tickets")
    picked = settled(_filled(tickets, marked.where(~F.col("whole") & (F.col("room") > 0))),
                     "mix-picked")
    ended = picked
    while True:
        # What fits nowhere in its block leaves room for documents of the blocks behind it.
        # A block that overflows is at least half filled, so rounds grow with the logarithm.
        rooms = ended.where(~F.col("whole") & (F.col("left") > 0)).select(
            F.col("mix_source").alias("r_source"), F.col("mix_block").alias("after"),
            F.col("left").alias("room"))
        open_ = settled(tickets.join(rooms, F.col("mix_source").eqNullSafe(F.col("r_source"))
                                     & (F.col("mix_block") > F.col("after"))
                                     & F.col("size").between(1, F.col("room")))
                        .select(*tickets.columns, "room"), "mix-open")
        if open_.isEmpty():
            break
        behind = running_total(
            open_.groupBy("mix_source", "mix_block").agg(
                F.sum("size").alias("block_size"), F.first("room").alias("room")),
            "mix_block", "block_size", "end_size")
        touched = behind.select(
            "mix_source", "mix_block", (F.col("end_size") <= F.col("room")).alias("whole"),
            (F.col("room") - F.col("end_size") + F.col("block_size")).alias("room"))
        ended = settled(_filled(open_.drop("room"), touched.where("room > 0")), "mix-picked")
        picked = picked.unionByName(ended)
    picks = picked.select(F.col("mix_source").alias("p_source"),
                          F.col("mix_block").alias("p_block"), "tickets")
    return marked.join(
        picks, F.col("mix_source").eqNullSafe(F.col("p_source"))
        & (F.col("mix_block") == F.col("p_block")), "left").select(
        "mix_source", "mix_block",
        (F.col("passes") + F.col("whole").cast("bigint")).alias("passes"),
        F.coalesce("tickets", F.array().cast("array<bigint>")).alias("tickets"))


def _filled(tickets: DataFrame, rooms: DataFrame) -> DataFrame:
    """Per block of ``rooms`` the tickets picked for its ``room``, and the room ``left``.

    Largest first, as long as it fits; the block bounds the list.
    """
    fitted = F.aggregate(
        F.sort_array(F.collect_list(F.struct("size", "mix_ticket")), asc=False),
        F.struct(F.first("room").alias("room"),
                 F.array().cast("array<bigint>").alias("tickets")),
        lambda acc, doc: F.when(
            (doc["size"] > 0) & (doc["size"] <= acc["room"]),
            F.struct((acc["room"] - doc["size"]).alias("room"),
                     F.array_append(acc["tickets"], doc["mix_ticket"]).alias("tickets"))
        ).otherwise(acc))
    in_block = (F.col("d.mix_source").eqNullSafe(F.col("l.mix_source"))
                & (F.col("d.mix_block") == F.col("l.mix_block")))
    return (tickets.alias("d").join(rooms.alias("l"), in_block)
            .select("d.*", "l.room", "l.whole")
            .groupBy("mix_source", "mix_block")
            .agg(fitted.alias("fit"), F.first("whole").alias("whole"))
            .select("mix_source", "mix_block", "whole", F.col("fit.tickets").alias("tickets"),
                    F.col("fit.room").alias("left")))


def located_in_blocks(documents: DataFrame, targets: DataFrame) -> DataFrame:
    """Adds ``mix_block``; the targets are one small row per source."""
    slim = targets.select(F.col("mix_source").alias("t_source"), "blocks")
    return (documents.join(slim, F.col("mix_source").eqNullSafe(F.col("t_source")))
            .withColumn("mix_block", F.pmod(F.col("mix_ticket"), F.col("blocks")))
            .drop("t_source", "blocks"))


def _hypergeometric(mine: Column, others: Column, room: Column, *salt: Column) -> Column:
    """How many of ``mine`` fall among ``room`` units drawn from ``mine + others``.

    By inversion from the most likely count outwards: neighbouring probabilities are simple
    multiples of each other, so they are added up relative to the first one, which needs no
    factorials, and the draw falls where a uniform share of their sum is reached. Ten standard
    deviations hold all that a double can tell; the steps grow with the root of the units.
    """
    def real(value: Column) -> Column:
        return value.cast("double")

    def first(b: Column) -> Column:
        """The most likely count, the steps to take from it, and the counts that are possible."""
        total = b["mine"] + b["others"]
        low, high = F.greatest(F.lit(0), b["room"] - b["others"]), F.least(b["mine"], b["room"])
        near = F.floor((b["room"] + F.lit(1.0)) * (b["mine"] + F.lit(1.0)) / (total + F.lit(2.0)))
        share = real(b["mine"]) / F.greatest(total, F.lit(1))
        spread = F.sqrt(F.greatest(F.lit(0.0), real(b["room"]) * share * (F.lit(1.0) - share)
                                   * real(total - b["room"]) / F.greatest(total - 1, F.lit(1))))
        return F.struct(
            real(b["mine"]).alias("mine"), real(b["room"]).alias("room"),
            real(b["others"] - b["room"]).alias("apart"), low.cast("bigint").alias("low"),
            high.cast("bigint").alias("high"), b["share"].alias("share"),
            F.greatest(low, F.least(high, near.cast("bigint"))).cast("bigint").alias("mode"),
            F.sequence(F.lit(1), (F.ceil(spread * 10) + 64).cast("int")).alias("steps"))

    def draw(b: Column) -> Column:
        def start(**more: Column) -> Column:
            return F.struct(b["mode"].alias("up"), b["mode"].alias("down"), F.lit(1.0).alias("w_up"),
                            F.lit(1.0).alias("w_down"), *(c.alias(n) for n, c in more.items()))

        def moved(acc: Column, _: Column) -> Column:
            up, down = real(acc["up"]), real(acc["down"])
            above = acc["w_up"] * (b["mine"] - up) * (b["room"] - up) / ((up + 1) * (b["apart"] + up + 1))
            below = acc["w_down"] * down * (b["apart"] + down) / (
                (b["mine"] - down + 1) * (b["room"] - down + 1))
            return F.struct((acc["up"] + 1).alias("up"), (acc["down"] - 1).alias("down"), above.alias("w_up"),
                            below.alias("w_down"), acc["sum"].alias("sum"), acc["found"].alias("found"))

        def added(acc: Column, _: Column) -> Column:
            return bound(moved(acc, _), lambda m: F.struct(
                *(m[n].alias(n) for n in ("up", "down", "w_up", "w_down")),
                (m["sum"] + m["w_up"] + m["w_down"]).alias("sum"), m["found"].alias("found")))

        def sought(acc: Column, _: Column) -> Column:
            return bound(moved(acc, _), lambda m: F.struct(
                *(m[n].alias(n) for n in ("up", "down", "w_up", "w_down")),
                (m["sum"] - m["w_up"] - m["w_down"]).alias("sum"),
                F.when(m["found"] >= 0, m["found"]).when(m["sum"] < m["w_up"], m["up"])
                .when(m["sum"] < m["w_up"] + m["w_down"], m["down"]).otherwise(none).alias("found")))

        none = F.lit(-1).cast("bigint")
        whole = F.aggregate(b["steps"], start(sum=F.lit(1.0), found=none), added)["sum"]
        left = b["share"] * whole - 1
        found = bound(left, lambda rest: F.aggregate(b["steps"], start(
            sum=rest, found=F.when(rest < 0, b["mode"]).otherwise(none)), sought)["found"])
        return bound(found, lambda k: F.greatest(b["low"], F.least(b["high"], F.when(
            k >= 0, k).otherwise(b["mode"]))).cast("bigint"))

    given = F.struct(mine.alias("mine"), others.alias("others"), room.alias("room"),
                     _uniform(*salt).alias("share"))
    return bound(bound(given, first), draw)


def bound(value: Column, use) -> Column:
    """``use`` of a value that is worked out, and written in the plan, once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def splitting_tree(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """Exact counts of units per (``shard``, ``mix_source``) from ``mix_source``, ``units``.

    ``shards`` is a power of two. A level works one row per node, which holds
    one count per source.
    """
    nodes = quotas.where(F.col("units") > 0).select(
        F.lit(0).cast("bigint").alias("node"), "mix_source",
        F.col("units").cast("bigint").alias("units"))
    for level in range(shards.bit_length() - 1):
        counts = F.sort_array(F.collect_list(F.struct("mix_source", "units")))
        start = F.struct(
            F.floor((F.col("all") + F.pmod(F.col("node"), F.lit(2))) / 2).alias("room"),
            F.col("all").alias("total"),
            F.array().cast("array<struct<mix_source:string,near:bigint,far:bigint>>")
            .alias("out"))

        salt = [F.lit(seed), F.lit(level), F.col("node")]

        def step(acc, one):
            near = _hypergeometric(one["units"], acc["total"] - one["units"], acc["room"],
                                   *salt, one["mix_source"])
            return F.struct(
                (acc["room"] - near).alias("room"),
                (acc["total"] - one["units"]).alias("total"),
                F.array_append(acc["out"], F.struct(
                    one["mix_source"].alias("mix_source"), near.alias("near"),
                    (one["units"] - near).alias("far"))).alias("out"))

        split = (nodes.groupBy("node").agg(counts.alias("counts"), F.sum("units").alias("all"))
                 .select("node", F.explode(F.aggregate("counts", start, step)["out"])
                         .alias("part")))
        nodes = split.select(
            F.explode(F.array(
                F.struct((F.col("node") * 2).alias("node"), F.col("part.near").alias("units")),
                F.struct((F.col("node") * 2 + 1).alias("node"),
                         F.col("part.far").alias("units")))).alias("child"),
            F.col("part.mix_source").alias("mix_source")).select(
            "child.node", "mix_source", "child.units").where(F.col("units") > 0)
        if level % _LEVELS == _LEVELS - 1:
            nodes = settled(nodes, "mix-nodes")
    return nodes.withColumnRenamed("node", "shard")


def _units(blocks: DataFrame, shards: int, seed: int) -> DataFrame:
    """One row per pass of a taken block, with the shard it goes to."""
    drawn = blocks.withColumn("draws", F.col("passes") + (F.size("tickets") > 0).cast("bigint"))
    each = drawn.where(F.col("draws") > 0).select(
        "mix_source", "mix_block",
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("draws"))).alias("mix_pass"))
    # Blocks are hash buckets, so their numbers already are a permuted order.
    numbered = running_total(
        each.withColumns({"turn": F.col("mix_pass") * F.lit(1 << 40) + F.col("mix_block"),
                          "one": F.lit(1).cast("bigint")}), "turn", "one", "unit")
    quotas = drawn.groupBy("mix_source").agg(F.sum("draws").alias("units"))
    leaves = splitting_tree(quotas, shards, seed)
    to = (Window.partitionBy("mix_source").orderBy("shard")
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    runs = leaves.withColumn("stop", F.sum("units").over(to)).select(
        F.col("mix_source").alias("r_source"), "shard", "stop",
        (F.col("stop") - F.col("units")).alias("begin"))
    return numbered.join(
        runs, F.col("mix_source").eqNullSafe(F.col("r_source"))
        & (F.col("unit") > F.col("begin")) & (F.col("unit") <= F.col("stop"))).select(
        "mix_source", "mix_block", "mix_pass", "shard")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = 3,
        shards: int | None = None, seed: int = 8) -> Mix:
    """Works out which documents the mix takes, how often, and into which shard.

    Without ``shards`` (a power of two) there are so many that each holds some ``SHARD_WORDS``.

    Sizes and targets are written to the shared folder: both are read several
    times, and the targets' real size lets the planner choose their join.
    """
    documents = settled(docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string")
        .alias("mix_source"), text_size(F.col("text")).alias("size")).withColumn(
        "mix_ticket", _ticket(seed)), "mix-sizes")
    totals = documents.groupBy("mix_source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    targets = settled(source_targets(totals, weights, max_repeats).withColumn(
        "blocks", F.ceil(F.col("docs") / BLOCK_DOCS)).drop("docs"), "mix-targets")
    blocks = settled(_blocks_taken(documents, targets), "mix-blocks")
    if shards is None:
        words = targets.agg(F.sum("target")).first()[0] or 0
        shards = 1 << max(0, int(words / SHARD_WORDS).bit_length())
    return Mix(documents, targets, blocks, settled(_units(blocks, shards, seed), "mix-units"))


def with_deals(documents: DataFrame, mixed: Mix, seed: int) -> DataFrame:
    """Adds ``mix_deals``: the units that hold each document (``mix_source``, ``mix_ticket``,
    ``size``), with the ``shard`` each was dealt to and the document's ``place`` there."""
    located = located_in_blocks(documents, mixed.targets)
    dealt = mixed.units.groupBy("mix_source", "mix_block").agg(F.sort_array(
        F.collect_list(F.struct("mix_pass", "shard"))).alias("mix_dealt"))
    taken = (mixed.blocks.alias("b").join(
        dealt.alias("u"), F.col("b.mix_source").eqNullSafe(F.col("u.mix_source"))
        & (F.col("b.mix_block") == F.col("u.mix_block")))
        .select(F.col("b.mix_source").alias("k_source"), F.col("b.mix_block").alias("k_block"),
                "passes", "tickets", "mix_dealt"))
    once_more = F.array_contains("tickets", F.col("mix_ticket")).cast("bigint")
    holding = F.filter("mix_dealt", lambda unit: (F.col("size") > 0) & (
        unit["mix_pass"] <= F.col("passes") + once_more))
    deals = F.transform(holding, lambda unit: F.struct(
        unit["shard"].alias("shard"),
        F.xxhash64(F.lit(seed), F.col("mix_ticket"), unit["mix_pass"]).alias("place")))
    none = F.array().cast("array<struct<shard:bigint,place:bigint>>")
    return (located.join(taken, F.col("mix_source").eqNullSafe(F.col("k_source"))
                         & (F.col("mix_block") == F.col("k_block")), "left")
            .withColumn("mix_deals", F.coalesce(deals, none))
            .drop("k_source", "k_block", "passes", "tickets", "mix_dealt"))


def mix_table(docs: DataFrame, seed: int = 8, **settings) -> DataFrame:
    """Per document: its size, its source's size and target, the words the mix takes, and
    for every time it is taken its shard and its place in the shard's order."""
    mixed = mix(docs, seed=seed, **settings)
    of = mixed.targets.select(F.col("mix_source").alias("o_source"), "source_size", "target")
    return (with_deals(mixed.documents, mixed, seed)
            .join(of, F.col("mix_source").eqNullSafe(F.col("o_source")))
            .select("doc_id", "size", "source_size", "target",
                    (F.col("size") * F.size("mix_deals")).alias("taken"),
                    F.col("mix_deals.shard").alias("shards"),
                    F.col("mix_deals.place").alias("places")))


def _dealt_rows(docs: DataFrame, seed: int, **settings) -> DataFrame:
    """Each document whole in ``mix_row``, once for every unit that holds it, with its ``deal``."""
    mixed = mix(docs, seed=seed, **settings)
    rows = docs.select(
        F.struct("*").alias("mix_row"), F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("mix_source"),
        text_size(F.col("text")).alias("size")).withColumn("mix_ticket", _ticket(seed))
    return with_deals(rows, mixed, seed).select("mix_row", F.explode("mix_deals").alias("deal"))


def mixture(docs: DataFrame, seed: int = 8, **settings) -> DataFrame:
    """The mixed rows: ``docs``' columns, repeated as taken, with ``mix_shard`` and ``mix_place``.

    Sorting a shard by ``mix_place`` shuffles it. Columns of ``docs`` with these two names are
    replaced.
    """
    kept = [F.col(f"mix_row.`{c}`").alias(c) for c in docs.columns if c not in ("mix_shard", "mix_place")]
    return _dealt_rows(docs, seed, **settings).select(
        *kept, F.col("deal.shard").alias("mix_shard"),
        F.col("deal.place").alias("mix_place"))


def mixed_documents(docs: DataFrame, seed: int = 8, **settings) -> DataFrame:
    """The mixed rows with the columns of ``docs`` only, shard by shard, each shuffled.

    Tasks hold ranges of (shard, place), so a large shard is the work of several.
    """
    return (_dealt_rows(docs, seed, **settings).repartitionByRange("deal.shard", "deal.place")
            .sortWithinPartitions("deal.shard", "deal.place").select("mix_row.*"))
