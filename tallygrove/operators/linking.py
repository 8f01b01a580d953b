"""First-wins dedupe, repeat linking and change tracking between snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallygrove.functions.parse import round_half_up
from tallygrove.operators.checkpoints import checkpointed


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    min_by over a struct of the order is a partial aggregate, so a key with very many
    rows is reduced before the shuffle; a window would collect it in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    got = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__first"))
    return got.select(*keys, "__first.*").select(df.columns)


def link_repeats(items: DataFrame, fingerprint: str, order: Sequence[Column]) -> DataFrame:
    """items with repeat_group and repeat_seq: members of a group numbered in order.

    items is computed once. Only groups of two or more are numbered: they are dealt by
    ranges of (fingerprint, order), so a hot group lies in many partitions in order; each
    numbers its own rows, and the counts of those before it are added.
    """
    items = checkpointed(items)
    sizes = items.groupBy(fingerprint).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(fingerprint)
    one = items.join(sizes, fingerprint, "left_anti").withColumn("repeat_seq", F.lit(1))
    many = items.join(sizes, fingerprint, "left_semi").repartitionByRange(F.col(fingerprint), *order).withColumn("__part", F.spark_partition_id())
    many = checkpointed(many)
    inside = F.row_number().over(Window.partitionBy(fingerprint, "__part").orderBy(*order))
    counts = many.groupBy(fingerprint, "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(fingerprint).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = counts.select(fingerprint, "__part", F.coalesce(before, F.lit(0)).alias("__shift"))
    placed = many.withColumn("__inside", inside).join(shifts, [fingerprint, "__part"])
    placed = placed.withColumn("repeat_seq", (F.col("__inside") + F.col("__shift")).cast("int")).drop("__inside", "__shift", "__part")
    return one.unionByName(placed).withColumn("repeat_group", F.col(fingerprint))


def repeat_counters(linked: DataFrame, round_col: str) -> DataFrame:
    """One row: the longest group, items in repeats, groups with several rounds, items naming a later round."""
    groups = linked.groupBy("repeat_group").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct(round_col).alias("rounds"), F.count_if(F.col(round_col) > 1).alias("declared")
    )
    return groups.agg(
        F.max("n").alias("max_attempts"),
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("items_in_repeats"),
        F.count_if((F.col("n") > 1) & (F.col("rounds") > 1)).alias("groups_with_rounds"),
        F.sum("declared").alias("self_declared"),
    )


def price_drop(items: DataFrame, group: str, price: str, order: Sequence[Column]) -> DataFrame:
    """First and last price of each group in order, the drop in percent, and whether the price fell."""
    priced = items.where(F.col(price).isNotNull() & (F.col(price) != 0))
    got = priced.groupBy(group).agg(
        F.min_by(price, F.struct(*order)).alias("first_price"), F.max_by(price, F.struct(*order)).alias("last_price"), F.count(F.lit(1)).alias("n")
    )
    drop = round_half_up((F.col("first_price") - F.col("last_price")) / F.col("first_price") * 100)
    return got.where("n > 1").withColumn("drop_pct", drop).withColumn("fell", F.col("last_price") < F.col("first_price"))


def meaningful_repeats(items: DataFrame, group: str, round_col: str, price: str) -> DataFrame:
    """Groups of two or more with several rounds (a missing one counts) or several rounded prices."""
    got = items.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        (F.countDistinct(round_col) + F.max(F.col(round_col).isNull().cast("int"))).alias("rounds"),
        F.countDistinct(round_half_up(F.col(price))).alias("prices"),
    )
    return got.where((F.col("n") >= 2) & ((F.col("rounds") > 1) | (F.col("prices") > 1)))


def snapshot_diff(today: DataFrame, before: DataFrame, key: str, numeric: Sequence[str], status: str) -> DataFrame:
    """Changes between two states: (key, event, field, old_value, new_value, pct).

    Events: nova (new; none if there was no earlier state), status (any difference,
    missing values included), cijena (both present and unequal to the cent) and nestala
    (gone). One full outer join on the key.
    """
    a, b = today.alias("a"), before.select(F.lit(True).alias("__was"), *before.columns).alias("b")
    both = a.join(b, F.col(f"a.{key}") == F.col(f"b.{key}"), "full_outer")
    new, gone = F.col("b.__was").isNull(), F.col(f"a.{key}").isNull()
    had_state = F.lit(not before.isEmpty())

    def text(c: Column) -> Column:
        return c.cast("string")

    none = F.lit(None).cast("string")
    events = [
        F.when(new & had_state, F.struct(F.lit("nova").alias("event"), F.lit("").alias("field"), none.alias("old_value"), none.alias("new_value"), F.lit(None).cast("double").alias("pct"))),
        F.when(gone, F.struct(F.lit("nestala").alias("event"), F.lit("").alias("field"), none.alias("old_value"), none.alias("new_value"), F.lit(None).cast("double").alias("pct"))),
        F.when(
            ~new & ~gone & ~F.col(f"a.{status}").eqNullSafe(F.col(f"b.{status}")),
            F.struct(F.lit("status").alias("event"), F.lit(status).alias("field"), text(F.col(f"b.{status}")).alias("old_value"), text(F.col(f"a.{status}")).alias("new_value"), F.lit(None).cast("double").alias("pct")),
        ),
    ]
    for f in numeric:
        old, now = round_half_up(F.col(f"b.{f}")), round_half_up(F.col(f"a.{f}"))
        pct = F.when(old != 0, round_half_up(((now - old) / old * 100))).cast("double")
        events.append(F.when(~new & ~gone & (old != now), F.struct(F.lit("cijena").alias("event"), F.lit(f).alias("field"), text(old).alias("old_value"), text(now).alias("new_value"), pct.alias("pct"))))
    out = both.select(F.coalesce(f"a.{key}", f"b.{key}").alias(key), F.explode(F.filter(F.array(*events), lambda e: e.isNotNull())).alias("e"))
    return out.select(key, "e.*")


def merge_state(state: DataFrame, batch: DataFrame, key: str, now: Column) -> DataFrame:
    """Upsert: batch columns win, first_seen stays, last_seen and times_seen move on, absent rows are kept."""
    fields = [c for c in batch.columns if c != key]
    s, b = state.alias("s"), batch.select(F.lit(True).alias("__new"), *batch.columns).alias("b")
    seen = F.col("b.__new").isNotNull()
    merged = s.join(b, F.col(f"s.{key}") == F.col(f"b.{key}"), "full_outer")
    return merged.select(
        F.coalesce(f"b.{key}", f"s.{key}").alias(key),
        *(F.when(seen, F.col(f"b.{f}")).otherwise(F.col(f"s.{f}")).alias(f) for f in fields),
        F.coalesce("s.first_seen", now).alias("first_seen"),
        F.when(seen, now).otherwise(F.col("s.last_seen")).alias("last_seen"),
        (F.coalesce("s.times_seen", F.lit(0)) + seen.cast("int")).alias("times_seen"),
    )


def event_detail(events: DataFrame) -> DataFrame:
    """Events with their values as one JSON text, for an append-only log."""
    return events.withColumn("detail", F.to_json(F.struct("field", "old_value", "new_value", "pct")))


def repeat_order(round_no: Column, decision: Column, publish: Column) -> tuple[Column, Column]:
    """What the attempts of a group are ordered by: the round's number (none or zero last), then the decision, or else the publication; a missing time comes first."""
    return F.coalesce(F.nullif(round_no.cast("int"), F.lit(0)), F.lit(99)), F.coalesce(decision.cast("timestamp_ntz"), publish.cast("timestamp_ntz"))


def group_heads(linked: DataFrame, order: Sequence[str]) -> DataFrame:
    """(repeat_group, members, last): what linking more items to a group needs to know of it; last is its last item's order."""
    return linked.groupBy("repeat_group").agg(F.count(F.lit(1)).alias("members"), F.max(F.struct(*order)).alias("last"))


def link_increment(state: DataFrame, batch: DataFrame, key: str, order: Sequence[str], heads: DataFrame | None = None) -> DataFrame:
    """(key, repeat_group, *order, repeat_seq, how) of all items after a batch, without numbering untouched groups again.

    state: linked items of earlier snapshots; batch: key, repeat_group and order of today's
    snapshot, which is a full copy, so most of it is in the state already. A new item that
    comes after its group's head is appended with the next number. Groups that a new item enters
    before the head, and those that an item changes or leaves, are numbered anew. Items absent
    from the batch stay. how is kept, appended or renumbered. heads, if the caller keeps them,
    saves counting the state's groups. order must tell all items of a group apart; nulls first.
    """
    own = list(dict.fromkeys([key, "repeat_group", *order]))
    before = state.select(*own, "repeat_seq")
    known = before.select(F.col(key).alias("__key"), F.struct("repeat_group", *order).alias("__was"))
    met = batch.select(*own).join(known, F.col(key) == F.col("__key"), "left")
    met = checkpointed(met.where(~F.struct("repeat_group", *order).eqNullSafe(F.col("__was"))).withColumn("__new", F.col("__key").isNull()).drop("__key"))
    heads = group_heads(before, order) if heads is None else heads
    first = met.where("__new").groupBy("repeat_group").agg(F.min(F.struct(*order)).alias("__first"))
    late = first.join(heads, "repeat_group").where("__first < last").select("repeat_group")
    moved = met.where("not __new")
    anew = checkpointed(late.unionByName(moved.select("repeat_group")).unionByName(moved.select("__was.repeat_group")).distinct())

    by_order = [F.col(c).asc_nulls_first() for c in order]
    changed = met.select(*own)
    added = met.where("__new").select(*own).join(anew, "repeat_group", "left_anti")
    appended = link_repeats(added, "repeat_group", by_order).join(heads.select("repeat_group", "members"), "repeat_group", "left")
    appended = appended.withColumn("repeat_seq", (F.col("repeat_seq") + F.coalesce("members", F.lit(0))).cast("int"))
    left = before.join(changed.select(key), key, "left_anti")
    again = left.select(*own).unionByName(changed).join(anew, "repeat_group", "left_semi")
    numbered = link_repeats(again, "repeat_group", by_order)
    kept = left.join(anew, "repeat_group", "left_anti")
    told = lambda df, how: df.select(*own, F.col("repeat_seq").cast("int").alias("repeat_seq"), F.lit(how).alias("how"))
    return told(kept, "kept").unionByName(told(appended, "appended")).unionByName(told(numbered, "renumbered"))


#: Members of one row of a group's list.
CHUNK = 1000


def group_lists(items: DataFrame, group: str, key: str, order: Sequence[str], chunk: int = CHUNK) -> DataFrame:
    """(group, chunk, first, members): each group of two and more once, in order, in rows of `chunk` members at most.

    chunk counts from 0, first is the place of a row's first member, from 1. A page of a large
    group is one row; nothing holds a whole group, and nothing grows with its square.
    """
    placed = _placed_members(items, group, key, order)
    rows = placed.groupBy(group, F.floor((F.col("repeat_seq") - 1) / chunk).cast("int").alias("chunk")).agg(F.array_sort(F.collect_list(F.struct("repeat_seq", key))).alias("__m"))
    return rows.select(group, "chunk", (F.col("chunk") * chunk + 1).alias("first"), F.transform("__m", lambda x: x[key]).alias("members"))


def membership(items: DataFrame, group: str, key: str, order: Sequence[str], chunk: int = CHUNK) -> DataFrame:
    """(key, group, place, members, chunk): where each item of a group of two and more stands in it, and the row of group_lists that has it."""
    placed = checkpointed(_placed_members(items, group, key, order))
    sizes = placed.groupBy(group).agg(F.max("repeat_seq").alias("members"))
    told = placed.join(sizes, group)
    return told.select(key, group, F.col("repeat_seq").alias("place"), "members", F.floor((F.col("repeat_seq") - 1) / chunk).cast("int").alias("chunk"))


def _placed_members(items: DataFrame, group: str, key: str, order: Sequence[str]) -> DataFrame:
    columns = list(dict.fromkeys([group, key, *order]))
    own = checkpointed(items.where(F.col(group).isNotNull()).select(*columns))
    many = own.groupBy(group).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(group)
    return link_repeats(own.join(many, group, "left_semi"), group, [F.col(c).asc_nulls_first() for c in dict.fromkeys([*order, key])]).select(*columns, "repeat_seq")
