"""Feature-store joins (JON-1..4).

Strategy is left to AQE: a side that turns out small at run time is broadcast, otherwise
both sides shuffle on the join keys.  Right-hand sides are made unique on the keys first
(D15), so a left join never multiplies the base rows and a skewed key on the right cannot fan
out: the dedupe is a map-side-combined aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.operators.clean import dedupe_keys


def left_chain(base: DataFrame, sides: Sequence[tuple], dedupe: bool = True) -> DataFrame:
    """JON-1: ``base LEFT JOIN side_1 USING (keys_1) LEFT JOIN side_2 ...``.

    Each side is ``(frame, keys)`` or ``(frame, keys, unique)``; ``unique=True`` says the frame
    is already one row per key (e.g. an aggregate grouped by exactly those keys), which skips
    the dedupe aggregation for that side.
    """
    prepared = []
    for side in sides:
        frame, keys = side[0], list(side[1])
        unique = len(side) > 2 and bool(side[2])
        prepared.append((dedupe_keys(frame, keys) if dedupe and not unique else frame, keys))
    # With every right side unique per key, the left joins commute.  Joining the sides that share
    # a key set one after another lets each group reuse the base's hash partitioning, so the
    # (large) base is shuffled once per distinct key set instead of once per key change.
    first_seen: dict[tuple, int] = {}
    for i, (_, keys) in enumerate(prepared):
        first_seen.setdefault(tuple(keys), i)
    order = sorted(range(len(prepared)), key=lambda i: (first_seen[tuple(prepared[i][1])], i))
    out = base
    for i in order:
        frame, keys = prepared[i]
        out = out.join(frame, keys, "left")
    columns = list(base.columns)
    for frame, keys in prepared:  # original column order: base, then each side as listed
        columns += [c for c in frame.columns if c not in columns]
    return out.select(*columns)


def heavy_keys(df: DataFrame, keys: Sequence[str], limit: int = 1000) -> DataFrame:
    """The keys with more than a ``limit``-th of the rows of ``df``: fewer than ``limit`` rows, exact.

    One map-side-combined count; written once with a reliable checkpoint.  Null keys match nothing and
    are left out.
    """
    from sparkmart.session import shared_dir

    shared_dir(df.sparkSession)
    keys = list(keys)
    whole = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])
    n, = free_columns(df, "n")
    total = df.select(F.count(F.lit(1)).alias("t")).first()["t"]
    counts = df.where(whole).groupBy(*keys).agg(F.count(F.lit(1)).alias(n))
    return counts.where(F.col(n) * limit > F.lit(total)).select(*keys).checkpoint(eager=True)


def free_columns(df: DataFrame, *stems: str) -> list[str]:
    """A column name for each stem that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    out = []
    for stem in stems:
        while stem.lower() in taken:
            stem += "_"
        out.append(stem)
    return out


def heavy_left_join(base: DataFrame, side: DataFrame, keys: Sequence[str], limit: int = 1000,
                    unique: bool = False) -> DataFrame:
    """JON-1/JON-3 with heavy keys split in the plan: ``base LEFT JOIN side USING (keys)``.

    Rows of a key that holds more than a ``limit``-th of ``base`` never move: their side rows, at most
    one per key and so fewer than ``limit``, are sent to every task.  All other rows, null keys
    included, are joined by a shuffle in which no key holds more than that share.  ``side`` is made
    unique per key first unless ``unique`` says that it is.
    """
    keys = list(keys)
    side = side if unique else dedupe_keys(side, keys)
    heavy = heavy_keys(base, keys, limit)
    # the side's rows of heavy keys: written once, one small row per heavy key
    replicated = heavy.join(side, keys, "left").checkpoint(eager=True)
    hot = base.join(F.broadcast(replicated), keys)
    rest = base.join(F.broadcast(heavy), keys, "left_anti").join(side, keys, "left")
    columns = [*base.columns, *[c for c in side.columns if c not in keys]]
    return rest.select(*columns).union(hot.select(*columns))


def outer_chain(frames: Sequence, keys: Sequence[str], drop_keys: bool = False, dedupe: bool = True) -> DataFrame:
    """JON-2: full outer joins on shared keys; ``USING`` keys come out coalesced.

    Each frame is a DataFrame or ``(frame, unique)``.  All rows of the first frame stay; the other
    frames are made unique per key (unless known to be), so nothing multiplies.  A first frame that
    may repeat keys is extended by a row for each key that only the others have, and the others are
    left-joined to it: AQE can split a hot key of the left side there, which it cannot do in a full
    outer join.  Null keys match nothing, as in any join: such rows stay on their own.
    Keys are kept by default (D18): a store without them cannot be joined to labels.
    """
    keys = list(keys)
    pairs = [f if isinstance(f, tuple) else (f, False) for f in frames]
    (base, base_unique), rest = pairs[0], pairs[1:]
    sides = [dedupe_keys(f, keys) if dedupe and not unique else f for f, unique in rest]
    if base_unique or not dedupe or not sides:
        out = base
        for f in sides:
            out = out.join(f, keys, "full")
        return out.drop(*keys) if drop_keys else out
    whole = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])
    seen = reduce(DataFrame.union, [f.select(*keys).where(whole) for f in sides]).distinct()
    extra = seen.join(base.select(*keys).distinct(), keys, "left_anti")
    out = left_chain(base.unionByName(extra, allowMissingColumns=True),
                     [(f.where(whole), keys, True) for f in sides])
    for f in sides:
        out = out.unionByName(f.where(~whole), allowMissingColumns=True)
    return out.drop(*keys) if drop_keys else out


def attach_features(labels: DataFrame, features: DataFrame, keys: Sequence[str], unique: bool = False) -> DataFrame:
    """JON-3 / MLD-1: labels LEFT JOIN features (features made unique per key unless already so)."""
    return left_chain(labels, [(features, keys, unique)], dedupe=True)


def inner_with_suffixes(left: DataFrame, right: DataFrame, keys: Sequence[str],
                        suffixes: tuple[str, str] = ("_x", "_y"), latest_by: str | None = None) -> DataFrame:
    """JON-4: inner join; columns present on both sides get suffixes.

    The reference paired every feature row of a key with every label row of it (D22).  Here
    the right side is first reduced to one row per key - the one with the greatest
    ``latest_by`` value when given - so the join is 1:N and never emits all pairs of a group.
    """
    keys = list(keys)
    if latest_by is not None:
        rest = [c for c in right.columns if c not in keys]
        right = (right.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(latest_by)).alias("_r"))
                      .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]))
    else:
        right = dedupe_keys(right, keys)
    common = (set(left.columns) & set(right.columns)) - set(keys)
    lsel = [F.col(c).alias(c + suffixes[0]) if c in common else F.col(c) for c in left.columns]
    rsel = [F.col(c).alias(c + suffixes[1]) if c in common else F.col(c) for c in right.columns]
    return left.select(*lsel).join(right.select(*rsel), keys, "inner")
