"""Record matching on any of several keys.

``a JOIN b ON k1(a)=k1(b) OR k2(a)=k2(b) OR ...`` is planned by Spark as a
nested-loop join. Rewritten: every record is emitted once per rule with a
non-null key, as ``(rule, hash(key), record)``; one equi self join on
``(rule, hash)`` finds every candidate ordered pair; the exact keys are
compared after the join, and a pair found by several rules is kept only
under its first matching rule, so no ``distinct`` shuffle is needed. A key shared
by m records yields m² pairs by definition; the pairs of a hot key are shared out
over a grid of blocks of its members. Where records that meet share the values of
some columns, what depends on these alone is worked out once per record and group.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import checkpoint_root

HOT_KEY_BROADCAST_LIMIT = 1_000_000
PAIRS_PER_TASK = 2_000_000

Side = Callable[[str], Column]  # a column's value in one record of a pair


def _grid_pairs(members: DataFrame, block_rows: int) -> DataFrame:
    """All ordered pairs of the members of crowded keys, by blocks of about ``block_rows`` members.

    ``members`` has (_rule, _h, rec, _n), the last the key's number of members.
    A place in the written table numbers the members, so equal records spread
    over the blocks as well, and a task that is run again deals them alike. Only the
    pairs of blocks (i, j) with i <= j are joined; of different blocks each
    pair is then given in both orders.
    """
    blocks = F.ceil(F.col("_n") / block_rows).cast("int")
    placed = members.checkpoint(eager=True).withColumn("_id", F.monotonically_increasing_id())
    own = placed.withColumn("_own", F.pmod("_id", blocks.cast("bigint")).cast("int"))
    left = own.select("_rule", "_h", F.col("rec").alias("a"), F.col("_own").alias("_i"), F.explode(F.sequence("_own", blocks - 1)).alias("_j"))
    right = own.select("_rule", "_h", F.col("rec").alias("b"), F.col("_own").alias("_j"), F.explode(F.sequence(F.lit(0), "_own")).alias("_i"))
    met = left.join(right, ["_rule", "_h", "_i", "_j"])
    once, twice = F.array(F.struct(F.col("a").alias("l"), F.col("b").alias("r"))), F.struct(F.col("b").alias("l"), F.col("a").alias("r"))
    return met.select("_rule", F.inline(F.when(F.col("_i") == F.col("_j"), once).otherwise(F.concat(once, F.array(twice)))))


def _group_pairs(df: DataFrame, rules: Mapping[str, Column], shared: Sequence[str], shared_rules: Sequence[str],
                 once: Callable[[Side, Side], Mapping[str, Column]], block_rows: int | None) -> DataFrame:
    """``or_match_pairs`` with ``shared``: a record is joined with the groups of its keys, not with every member.

    A group is an array of the members of a key, or of a block of a crowded key, that
    agree on ``shared``. The block is drawn from the record's place in the written table,
    so equal records spread over the blocks, and a task that is run again deals them
    alike. A crowded key is a grid: a record goes to all cells of its block's row, a
    group to all cells of its block's column, so they meet in one cell.
    """
    names, cols = list(rules), df.columns
    place = {c: k for k, c in enumerate(cols)}
    apart = [c for c in cols if c not in shared]

    def keyed(records: DataFrame, *more: str) -> DataFrame:
        hashed = [F.when(rules[n].isNotNull(), F.xxhash64(rules[n].cast("string"))) for n in names]
        return records.select(
            *[F.col(f"`{c}`").alias(f"_f{place[c]}") for c in cols], *more,
            F.inline(F.array(*[F.struct(F.lit(i).alias("_rule"), h.alias("_h")) for i, h in enumerate(hashed)])),
        ).filter(F.col("_h").isNotNull())

    def fields(side: str, some: Sequence[str]) -> list[Column]:
        return [F.col(f"_f{place[c]}").alias(f"_{side}{place[c]}") for c in some]

    members, key = keyed(df), ["_rule", "_h"]
    sizes = members.groupBy(key).agg(F.count("*").alias("_n"))
    crowd = F.lit(False) if block_rows is None else F.col("_n") > block_rows
    n_pairs, n_crowded = sizes.agg(F.sum(F.col("_n").cast("double") ** 2), F.count_if(crowd)).first()
    if n_crowded:
        checkpoint_root(df.sparkSession)
        crowded = sizes.filter(crowd).select(*key, F.ceil(F.col("_n") / block_rows).cast("int").alias("_blocks"))
        if n_crowded <= HOT_KEY_BROADCAST_LIMIT:  # 25 bytes a key
            crowded = F.broadcast(crowded)
        placed = df.checkpoint(eager=True).withColumn("_id", F.monotonically_increasing_id())
        members = keyed(placed, "_id").join(crowded, key, "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1))) \
            .withColumn("_own", F.pmod(F.xxhash64("_id", "_rule"), F.col("_blocks")).cast("int"))
        every = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
        own, left_cell, right_cell, key = ["_blocks", "_own"], [F.col("_own").alias("_i"), every.alias("_j")], \
            [every.alias("_i"), F.col("_own").alias("_j")], [*key, "_i", "_j"]
    else:
        own, left_cell, right_cell = [], [], []

    left = members.select("_rule", "_h", *fields("l", cols), *left_cell)
    group = F.collect_list(F.struct(*(fields("r", apart) or [F.lit(0).alias("_")])))
    right = members.groupBy("_rule", "_h", *own, *fields("r", shared)).agg(group.alias("_group")) \
        .select("_rule", "_h", *[f"_r{place[c]}" for c in shared], "_group", *right_cell)
    if (n_pairs or 0) > PAIRS_PER_TASK:  # by the pairs: few bytes are shuffled for many of them
        n_tasks = max(ceil(n_pairs / PAIRS_PER_TASK), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        left, right = left.repartition(n_tasks, *key), right.repartition(n_tasks, *key)
    # a sort merge join takes the left rows one by one, so a task holds the pairs of a record, not those of a key
    pairs = left.join(right.hint("merge"), key)

    def equal(i: int) -> Column:
        return F.coalesce(F.col(f"_lk{i}") == F.col(f"_rk{i}"), F.lit(False))

    def obey(pairs: DataFrame, some: Sequence[int], have: Sequence[str]) -> DataFrame:
        # as far as the rules ``some`` on the columns ``have`` tell: the joined rule really matches, and no earlier one does
        for side in "lr":  # the rule expressions evaluated against one side's fields, under the fields' own names
            pairs = pairs.select("*", *[F.col(f"_{side}{place[c]}").alias(c) for c in have]) \
                .select(*pairs.columns, *[rules[names[i]].cast("string").alias(f"_{side}k{i}") for i in some])
        return pairs.filter(reduce(lambda a, b: a | b, [
            reduce(lambda a, b: a & b, [F.col("_rule") == F.lit(i), *([equal(i)] if i in some else []), *[~equal(j) for j in some if j < i]])
            for i in range(len(names))
        ]))

    early = [i for i, n in enumerate(names) if n in shared_rules]
    late = [i for i in range(len(names)) if i not in early]
    if early:
        pairs = obey(pairs, early, shared)
    extra = once(lambda c: F.col(f"_l{place[c]}"), lambda c: F.col(f"_r{place[c]}"))
    known = ["_rule", *[f"_l{place[c]}" for c in cols], *[f"_r{place[c]}" for c in shared]]
    pairs = pairs.select(*known, "_group", *[v.alias(f"_x{k}") for k, v in enumerate(extra.values())])
    pairs = pairs.select(*known, *[f"_x{k}" for k in range(len(extra))], F.inline("_group"))
    if late:
        pairs = obey(pairs, late, cols)
    return pairs.select(*[F.struct(*[F.col(f"_{side}{place[c]}").alias(c) for c in cols]).alias(side) for side in "lr"],
                        *[F.col(f"_x{k}").alias(n) for k, n in enumerate(extra)])


def or_match_pairs(df: DataFrame, rules: Mapping[str, Column], *, block_rows: int | None = 1_000, shared: Sequence[str] = (),
                   shared_rules: Sequence[str] = (), once: Callable[[Side, Side], Mapping[str, Column]] | None = None) -> DataFrame:
    """Ordered pairs ``(l, r)`` of records of ``df`` equal on at least one rule key.

    ``rules`` maps a rule name to a key expression over ``df``'s columns; a null
    key never matches. Self pairs are included, both orders are returned.
    Output: struct columns ``l`` and ``r`` holding the records.

    The shuffle carries each record once per non-null rule key plus a 64-bit
    hash of that key; the join is on ``(rule, hash)`` and the exact keys are
    re-derived from both records afterwards, so hash collisions never leak
    into the result and long keys (whole texts) are not shuffled twice.

    Keys held by more than ``block_rows`` records (one aggregate finds them, now) are
    joined block by block, so many tasks share a hot key's pairs, also those of
    identical records; ``None`` leaves hot keys to AQE's skew join.

    ``shared`` names columns whose values many records of a key have in common.
    ``once(l, r)`` gives further output columns from these; they, and ``shared_rules``,
    the rules on these columns alone, are evaluated once per record and group instead
    of per pair.
    """
    if shared:
        return _group_pairs(df, rules, shared, shared_rules, once or (lambda l, r: {}), block_rows)
    names = list(rules)
    cols = df.columns
    rec = F.struct(*[F.col(f"`{c}`") for c in cols]).alias("rec")
    hashed = [F.when(rules[n].isNotNull(), F.xxhash64(rules[n].cast("string"))) for n in names]
    exploded = df.select(
        rec,
        F.inline(F.array(*[F.struct(F.lit(i).alias("_rule"), h.alias("_h")) for i, h in enumerate(hashed)])),
    ).filter(F.col("_h").isNotNull())

    few, hot = exploded, None
    if block_rows is not None:
        crowded = exploded.groupBy("_rule", "_h").agg(F.count("*").alias("_n")).filter(F.col("_n") > block_rows)
        n_crowded = crowded.count()
        if n_crowded:
            if n_crowded <= HOT_KEY_BROADCAST_LIMIT:  # 25 bytes a key
                crowded = F.broadcast(crowded)
            checkpoint_root(df.sparkSession)
            tagged = exploded.join(crowded, ["_rule", "_h"], "left")
            few, hot = tagged.filter(F.col("_n").isNull()).drop("_n"), tagged.filter(F.col("_n").isNotNull())
    pairs = (few.select("_rule", "_h", F.col("rec").alias("l"))
             .join(few.select("_rule", "_h", F.col("rec").alias("r")), ["_rule", "_h"]).select("_rule", "l", "r"))
    if hot is not None:
        pairs = pairs.unionByName(_grid_pairs(hot, block_rows))

    def keys_of(side: str) -> list[Column]:
        # the rule expressions evaluated against one side's record fields
        return [F.col(f"{side}.`{c}`").alias(c) for c in cols]

    left = pairs.select("_rule", "l", "r", *keys_of("l")) \
        .select("_rule", "l", "r", *[rules[n].cast("string").alias(f"l_k{i}") for i, n in enumerate(names)])
    both = left.select("_rule", "l", "r", *[f"l_k{i}" for i in range(len(names))], *keys_of("r")) \
        .select("_rule", "l", "r", *[f"l_k{i}" for i in range(len(names))],
                *[rules[n].cast("string").alias(f"r_k{i}") for i, n in enumerate(names)])

    def equal(i: int) -> Column:
        return F.coalesce(F.col(f"l_k{i}") == F.col(f"r_k{i}"), F.lit(False))

    # the joined rule really matches, and no earlier rule does
    keep = reduce(lambda a, b: a | b, [
        (F.col("_rule") == F.lit(i)) & equal(i)
        & reduce(lambda x, y: x & y, [~equal(j) for j in range(i)], F.lit(True))
        for i in range(len(names))
    ])
    return both.filter(keep).select("l", "r")


# Fixed output shape of the applications matching query: four 0/1 flags, the
# edit distance of "first last" names, then both sides' name/email/phone/address.
def match_applications(apps: DataFrame) -> DataFrame:
    """The applications matching query: same name, email, phone or address."""
    apps = apps.select("first_name", "last_name", "email", "phone", "address")
    name = F.concat(F.col("first_name"), F.col("last_name"))

    def flag(a: Column, b: Column) -> Column:
        return F.when(a == b, 1).otherwise(0)

    def of_names(l: Side, r: Side) -> dict[str, Column]:
        l_name, r_name = F.concat(l("first_name"), l("last_name")), F.concat(r("first_name"), r("last_name"))
        return {"matched_name": flag(l_name, r_name),
                "name_distance": F.levenshtein(F.concat(l("first_name"), F.lit(" "), l("last_name")),
                                               F.concat(r("first_name"), F.lit(" "), r("last_name"))),
                "name": l_name, "name2": r_name}

    pairs = or_match_pairs(apps, {"name": name, "email": F.col("email"),
                                  "phone": F.col("phone"), "address": F.col("address")},
                           shared=["first_name", "last_name"], shared_rules=["name"], once=of_names)
    return pairs.select(
        "matched_name",
        flag(F.col("l.address"), F.col("r.address")).alias("matched_address"),
        flag(F.col("l.phone"), F.col("r.phone")).alias("matched_phone"),
        flag(F.col("l.email"), F.col("r.email")).alias("matched_email"),
        "name_distance",
        "name", F.col("l.email").alias("email"), F.col("l.phone").alias("phone"),
        F.col("l.address").alias("address"),
        "name2", F.col("r.email").alias("email2"), F.col("r.phone").alias("phone2"),
        F.col("r.address").alias("address2"),
    )
