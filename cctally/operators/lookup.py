"""Lookups: J1-J9 and keep-first dimensions.

All lookups are equi left-outer joins.  Null keys never match (Q1/Q2).

Broadcast policy: a dimension is broadcast only after its rows and bytes have
been checked against bounds (``cctally.broadcast.maxRows``, default 2,000,000,
and ``cctally.broadcast.maxBytes``, default 512 MiB);
beyond the bound the join is left to the planner (sort-merge, with AQE skew
splitting of hot fact keys).  ``broadcast=False`` skips the check.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, FractionalType, IntegralType, MapType, NumericType, StringType, StructType)

DEFAULT_BROADCAST_MAX_ROWS = 2_000_000


def _as_list(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, (str, Column)) else list(x)


def _col(c) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


#: Bytes of text and numbers that a broadcast side may hold, beside its row bound.
DEFAULT_BROADCAST_MAX_BYTES = 512 * 1024 * 1024


def broadcast_max_bytes(spark) -> int:
    v = spark.conf.get("cctally.broadcast.maxBytes", None)
    return int(v) if v else DEFAULT_BROADCAST_MAX_BYTES


def _size(df: DataFrame) -> list[Column]:
    """Rows and bytes of a table as two global aggregates."""
    def wide(f) -> Column:
        c = _col(f.name)
        if isinstance(f.dataType, (StringType, BinaryType)):
            return F.coalesce(F.octet_length(c), F.lit(0)).cast("long") + 16
        if isinstance(f.dataType, (ArrayType, MapType, StructType)):
            return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)).cast("long") + 16
        return F.lit(16).cast("long")
    total = F.lit(16).cast("long")
    for f in df.schema.fields:
        total = total + wide(f)
    return [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(total), F.lit(0)).alias("b")]


def broadcast_max_rows(spark) -> int:
    v = spark.conf.get("cctally.broadcast.maxRows", None)
    return int(v) if v else DEFAULT_BROADCAST_MAX_ROWS


def guarded_broadcast(dim: DataFrame, max_rows: int | None = None, mode="auto",
                      bound_by: DataFrame | None = None, factor: int = 1) -> DataFrame:
    """Broadcast hint only when the dimension is proven to have at most
    ``max_rows`` rows.

    The proof is a row count of ``bound_by`` (default: ``dim`` itself) --
    for a keep-first dimension the raw rows before the reduction, which bound
    its size (times ``factor`` when several key projections are unioned).
    The count is a global aggregate: every task counts its own rows and only
    one number per task reaches the final step (no rows funnel into one
    task), and as only a count is asked, no projected expression is computed.
    Beyond the bound no hint is given and the planner picks a sort-merge
    join (AQE splits skewed fact partitions).  ``mode=True`` forces the
    hint, ``False`` never hints.
    """
    if mode is False:
        return dim
    if mode is True:
        return F.broadcast(dim)
    source = bound_by if bound_by is not None else dim
    return F.broadcast(dim) if _proven_small(source, max_rows, "auto", factor) else dim


SPREAD_BUCKETS = 1024
SALT_BUCKETS = 32
HOT_SAMPLE_FRACTION = 0.01
HOT_MIN_SHARE = 0.01


def hot_keys(fact: DataFrame, key: Column, *, fraction: float = HOT_SAMPLE_FRACTION,
             min_share: float = HOT_MIN_SHARE, seed: int = 17) -> list:
    """Keys that hold at least ``min_share`` of a row sample of ``fact``.

    One pass: a grouped count over a Bernoulli sample (partial aggregation
    per task), kept while its total and its qualifying keys are read.  A key
    qualifies with at least ``min_share`` of the sampled rows (and at least
    two of them); as the shares add up to one, at most ``1 / min_share``
    keys qualify, so the list reaching the driver is bounded.  The sample
    only detects hot keys; no row is dropped.
    """
    sample = fact.select(key.alias("__hk")).where(F.col("__hk").isNotNull()).sample(fraction=fraction, seed=seed)
    counts = sample.groupBy("__hk").agg(F.count(F.lit(1)).alias("__n")).persist()
    try:
        total = counts.agg(F.sum("__n").alias("t")).first()["t"]
        if not total:
            return []
        threshold = max(2.0, min_share * total)
        return [r["__hk"] for r in counts.where(F.col("__n") >= F.lit(threshold)).collect()]
    finally:
        counts.unpersist()


def hot_keys_of(fact: DataFrame, keys: Mapping[str, Column], *, fraction: float = HOT_SAMPLE_FRACTION,
                min_share: float = HOT_MIN_SHARE, seed: int = 17) -> dict[str, list]:
    """The hot keys of several lookups, found in one job over the raw fact.

    Every sampled row gives one entry per lookup; counts of (lookup, key) and
    of all rows come from one grouped aggregate, of which only the greatest
    counts are fetched: at most ``1 / min_share`` keys of a lookup hold that
    share of the rows, so their number bounds the fetch and none is missed.
    The sample only detects hot keys; no row is dropped.
    """
    names = list(keys)
    if not names:
        return {}
    entry = F.array(*[F.struct(F.lit(i).alias("i"), keys[n].cast("string").alias("k")) for i, n in enumerate(names)],
                    F.struct(F.lit(-1).alias("i"), F.lit("").alias("k")))
    seen = fact.sample(fraction=fraction, seed=seed).select(F.explode(entry).alias("e")).where("e.k IS NOT NULL")
    most = (int(1 / min_share) + 1) * len(names) + 1
    top = seen.groupBy("e.i", "e.k").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "i").limit(most).collect()
    total = max([r["n"] for r in top if r["i"] == -1], default=0)
    return {n: [r["k"] for r in top if r["i"] == i and r["n"] >= max(2.0, min_share * total)] for i, n in enumerate(names)}


def hashable(df: DataFrame) -> list[Column]:
    """The columns of a row as values that can be hashed (maps as their JSON text)."""
    def holds_map(t) -> bool:
        if isinstance(t, MapType):
            return True
        if isinstance(t, ArrayType):
            return holds_map(t.elementType)
        return isinstance(t, StructType) and any(holds_map(f.dataType) for f in t.fields)
    return [F.to_json(F.struct(_col(f.name))) if holds_map(f.dataType) else _col(f.name) for f in df.schema.fields]


#: Reducers of a key that is hot on both sides: SIDE x SIDE.
SIDE = 6

#: Runs that the rows of one key in one cell and one input split are packed into.
RUNS = 8


def packed_runs(right: DataFrame, key: str, row_hash: str, by: list[str], values: list[str]) -> DataFrame:
    """The rows of ``right`` in arrays ``__rows``, several for each key and ``by``.

    A run lies in one piece of memory, so a fan-out reads it in order instead
    of following one row to the next. It holds rows of one input split only,
    chosen by their hash, which a repeated task computes alike.
    """
    kept = F.struct(*[_col(v) for v in values]) if values else F.struct(F.lit(True).alias("__hit"))
    run = F.struct(F.spark_partition_id().alias("p"), F.pmod(F.shiftright(row_hash, 20), F.lit(RUNS)).alias("r"))
    return right.withColumn("__run", run).groupBy(key, *by, "__run").agg(F.collect_list(kept).alias("__rows")).drop("__run")


def salted_fanout(fact: DataFrame, right: DataFrame, fact_key: Column, right_key: str, hot: list, hot_right: list,
                  buckets: int = SALT_BUCKETS) -> DataFrame:
    """Left join that keeps every match, with keys that are hot on either side dealt over a grid.

    The rows of a side on which a key is hot are dealt over the rows or the
    columns of the grid by their hash; the other side's are copied to each of
    them. A key hot on both sides has ``SIDE`` by ``SIDE`` reducers, so no row
    is copied more than ``SIDE`` times; a key hot on one side has ``buckets``
    on that side, and only the few rows of the other are copied. Only facts of
    keys that are hot on the right have copies, and those have a match.
    With a key hot on the right, right rows are joined in runs (:func:`packed_runs`)
    and every run is expanded to its rows behind the join.
    """
    both = [h for h in hot if h in set(hot_right)]
    left_only, right_only = [h for h in hot if h not in set(both)], [h for h in hot_right if h not in set(both)]

    def sizes(key: Column) -> tuple[Column, Column]:
        """Cells along the fact's and the right side's axis."""
        is_in = lambda some: key.isin([F.lit(h) for h in some]) if some else F.lit(False)
        a = F.when(is_in(both), SIDE).when(is_in(left_only), buckets).otherwise(1)
        b = F.when(is_in(both), SIDE).when(is_in(right_only), buckets).otherwise(1)
        return a, b

    def cells(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), n - 1))

    f = fact.withColumn("__fk", fact_key)
    a, b = sizes(F.col("__fk"))
    f = f.withColumn("__i", (F.pmod(F.xxhash64(*hashable(fact)), a)).cast("int")).withColumn("__j", cells(b))
    r = right.withColumn("__h", F.xxhash64(*hashable(right)))
    a, b = sizes(F.col(right_key))
    r = r.withColumn("__rj", F.pmod(F.col("__h"), b).cast("int"))
    if hot_right:
        r = packed_runs(r, right_key, "__h", ["__rj"], [c for c in right.columns if c != right_key])
    r = r.withColumn("__ri", cells(a))
    joined = f.join(r, (F.col("__fk") == F.col(right_key)) & (F.col("__i") == F.col("__ri")) & (F.col("__j") == F.col("__rj")), "left")
    if hot_right:
        # a key that is hot on the right has rows there, so its copies without one in their cell are no unmatched rows
        alone = ~F.coalesce(F.col("__fk").isin([F.lit(h) for h in hot_right]), F.lit(False))
        joined = joined.where(F.col("__rows").isNotNull() | alone).select("*", F.inline_outer("__rows")).drop("__rows", "__hit")
    return joined.drop("__fk", "__i", "__j", "__h", "__ri", "__rj", right_key)


def salted_join(fact: DataFrame, right: DataFrame, fact_key: Column, right_key: str,
                hot: list, buckets: int = SALT_BUCKETS) -> DataFrame:
    """Left join ``fact`` to ``right`` on ``fact_key == right[right_key]``
    with hot keys salted: their fact rows get ``salt = hash % buckets`` and
    their (one-per-key) dimension rows are replicated once per salt, so a
    key holding a third of the fact is spread over ``buckets`` reducers.
    Other keys use salt 0.  The result equals the plain left join."""
    hot_lit = [F.lit(h) for h in hot]
    f = fact.withColumn("__fk", fact_key)
    is_hot_f = F.col("__fk").isin(hot_lit) if hot else F.lit(False)
    f = f.withColumn("__salt", F.when(is_hot_f, F.pmod(F.xxhash64(*hashable(fact)), F.lit(buckets)))
                     .otherwise(F.lit(0)).cast("int"))
    is_hot_r = F.col(right_key).isin(hot_lit) if hot else F.lit(False)
    r = right.withColumn("__salt", F.explode(F.when(is_hot_r, F.sequence(F.lit(0), F.lit(buckets - 1)))
                                              .otherwise(F.array(F.lit(0)))))
    cond = (F.col("__fk") == F.col(right_key)) & (f["__salt"] == r["__salt"])
    return f.join(r, cond, "left").drop("__fk", right_key).drop(f["__salt"]).drop(r["__salt"])


def _common_type(fact: DataFrame, fact_key: Column, dim: DataFrame, dim_key: Column) -> tuple[Column, Column]:
    """Both keys as one type, the same for every join path: text meets a
    number or date as that type (unreadable text never matches), integers
    meet as bigint, other numbers as double."""
    a = fact.select(fact_key.alias("k")).schema["k"].dataType
    b = dim.select(dim_key.alias("k")).schema["k"].dataType
    if a == b:
        return fact_key, dim_key
    if isinstance(a, StringType):
        return fact_key.try_cast(b), dim_key
    if isinstance(b, StringType):
        return fact_key, dim_key.try_cast(a)
    if isinstance(a, NumericType) and isinstance(b, NumericType):
        kind = "bigint" if isinstance(a, IntegralType) and isinstance(b, IntegralType) else "double"
        return fact_key.cast(kind), dim_key.cast(kind)
    raise ValueError(f"lookup keys of types {a.simpleString()} and {b.simpleString()} cannot be compared")


def _join_keys(fact: DataFrame, fact_key: Column, dim_key: Column, broadcast_side: bool) -> tuple[Column, Column]:
    """Join key expressions for a left lookup.

    With a broadcast dimension the keys are used as they are.  Otherwise a
    null fact key (which can never match) would hash every such row to one
    reducer; it is replaced by a spread value ``'n' || (row hash % 1024)``
    while real keys become ``'k' || key`` on both sides, so a spread value
    can never equal a dimension key -- the result is exact.
    """
    if broadcast_side:
        return fact_key, dim_key
    spread = F.concat(F.lit("n"), F.pmod(F.xxhash64(*hashable(fact)), F.lit(SPREAD_BUCKETS)).cast("string"))
    fractional = isinstance(fact.select(fact_key.alias("k")).schema["k"].dataType, FractionalType)
    # -0.0 equals 0.0, but its text does not
    text = lambda c: F.concat(F.lit("k"), (c + F.lit(0) if fractional else c).cast("string"))
    return F.when(fact_key.isNull(), spread).otherwise(text(fact_key)), text(dim_key)


def prove_small(dims: Mapping[str, DataFrame | None], max_rows: int | None = None,
                factors: Mapping[str, int] | None = None) -> dict[str, bool]:
    """Check several dimensions' row bounds in one job.

    Returns ``{name: rows * factor <= max_rows}``, with the same for bytes,
    from a union of global sums (one small job instead of one per lookup); pass the flags on as
    ``broadcast=`` so each lookup skips its own check.  ``factors`` covers a
    dimension whose key projections are unioned (J2).
    """
    factors = dict(factors or {})
    present = {k: v for k, v in dims.items() if v is not None}
    if not present:
        return {k: False for k in dims}
    spark = next(iter(present.values())).sparkSession
    limit = max_rows if max_rows is not None else broadcast_max_rows(spark)
    caps = {k: limit // max(factors.get(k, 1), 1) for k in present}
    room = {k: broadcast_max_bytes(spark) // max(factors.get(k, 1), 1) for k in present}
    parts = [df.agg(*_size(df)).select(F.lit(k).alias("k"), "n", "b") for k, df in present.items()]
    counts = parts[0]
    for p in parts[1:]:
        counts = counts.unionByName(p)
    got = {r["k"]: r for r in counts.collect()}
    return {k: (k in got and got[k]["n"] <= caps[k] and got[k]["b"] <= room[k]) for k in dims}


def _proven_small(bound_by: DataFrame, max_rows: int | None, mode, factor: int = 1) -> bool:
    """``mode``: True/False given by the caller (e.g. from :func:`prove_small`),
    or ``"auto"`` to check ``bound_by`` now."""
    if mode is True or mode is False:
        return mode
    spark = bound_by.sparkSession
    limit = max_rows if max_rows is not None else broadcast_max_rows(spark)
    got = bound_by.agg(*_size(bound_by)).first()
    return got["n"] <= limit // max(factor, 1) and got["b"] <= broadcast_max_bytes(spark) // max(factor, 1)


def first_wins(dim: DataFrame, key: str, values: Sequence[str], order: Sequence) -> DataFrame:
    """One row per non-null key with the values of its first row.

    "First" is the smallest ``order`` (a total order such as source file then
    row ordinal, Q6).  A null value of the first row is kept, as
    ``drop_duplicates(keep='first')`` keeps it.  ``min_by`` is aggregated
    partially on the map side, so a hot key is reduced before the shuffle.
    """
    values = list(values)
    ordering = F.struct(*[_col(o) for o in _as_list(order)])
    packed = F.struct(*[_col(v) for v in values])
    return (
        dim.where(_col(key).isNotNull())
        .groupBy(_col(key).alias(key))
        .agg(F.min_by(packed, ordering).alias("__first"))
        .select(_col(key), *[F.col("__first").getField(v).alias(v) for v in values])
    )


def lookup(fact: DataFrame, dim: DataFrame | None, *, fact_key: str, dim_key: str,
           values: Sequence[str], order: Sequence | None = None, dedupe: bool = True,
           fill: Mapping[str, str] | None = None, marker: str | None = None,
           rename: Mapping[str, str] | None = None, broadcast="auto",
           max_rows: int | None = None, salt_hot_keys: bool = True, hot: list | None = None,
           hot_right: list | None = None) -> DataFrame:
    """Left lookup of ``values`` from ``dim``.

    * ``dedupe=True`` reduces the dimension to its first row per key (D1,
      needs ``order``); ``False`` keeps every match (J4 fan-out).
    * ``dim=None`` (absent dimension, J7) or a missing key / value column
      (J8) adds the value columns as ``marker`` (null when no marker).
    * ``fill`` null-fills attributes after the join (J9).
    * ``rename`` renames attributes on the way out (P6).
    * Beyond the broadcast bound, hot fact keys are salted
      (``salt_hot_keys``, see :func:`salted_join`, and :func:`salted_fanout`
      where every match is kept) and null fact keys are spread (see
      :func:`_join_keys`). ``hot`` gives the fact's hot keys as text when a job
      has found those of all its lookups at once (:func:`hot_keys_of`),
      ``hot_right`` those of a fan-out's right side (keys that have rows there).
    Key canonicalisation (J6) is done by the caller on both sides.
    """
    values = list(values)
    rename = dict(rename or {})
    outs = [rename.get(v, v) for v in values]
    if dim is None or fact_key not in fact.columns or dim_key not in dim.columns \
            or any(v not in dim.columns for v in values):
        return fact.withColumns({o: F.lit(marker).cast("string") for o in outs})
    clash = [o for o in outs if o in fact.columns]
    if clash:
        raise ValueError(f"lookup would duplicate columns {clash}; pass rename=")
    if dedupe:
        if order is None:
            raise ValueError("dedupe=True needs an order (first row wins)")
        right = first_wins(dim, dim_key, values, order)
    else:
        right = dim.where(_col(dim_key).isNotNull()).select(_col(dim_key), *[_col(v) for v in values])
    right = right.select(_col(dim_key).alias("__lk"), *[_col(v).alias(o) for v, o in zip(values, outs)])
    small = _proven_small(dim, max_rows, broadcast)
    fk, dk = _join_keys(fact, *_common_type(fact, _col(fact_key), right, F.col("__lk")), small)
    right = right.withColumn("__lk", dk)
    if small:
        joined = fact.withColumn("__fk", fk).join(F.broadcast(right), F.col("__fk") == F.col("__lk"), "left") \
            .drop("__fk", "__lk")
    else:
        hot_fact = [f"k{h}" for h in hot] if hot is not None else hot_keys(fact, fk) if salt_hot_keys else []
        if dedupe:
            joined = salted_join(fact, right, fk, "__lk", hot_fact)
        else:
            found = [f"k{h}" for h in hot_right] if hot_right is not None else \
                hot_keys(right, F.col("__lk")) if salt_hot_keys else []
            joined = salted_fanout(fact, right, fk, "__lk", hot_fact, found)
    if fill:
        joined = joined.withColumns({c: F.coalesce(_col(c), F.lit(v)) for c, v in fill.items()})
    return joined


def fallback_lookup(fact: DataFrame, dim: DataFrame, *, keys: Sequence[tuple[str, str]],
                    value: str, out: str, order: Sequence, default: str | None = None,
                    broadcast="auto", max_rows: int | None = None, salt_hot_keys: bool = True,
                    hot: Mapping[str, list] | None = None) -> DataFrame:
    """Prioritised lookup over several (fact key, dimension key) pairs.

    For each pair the first dimension row per key gives a candidate (which
    may be null); the result is the first non-null candidate in pair order,
    else ``default``.  Adjacent pairs that probe the same fact key share one
    join: their candidates are computed in one aggregation over a union of
    the dimension's key projections, so the fact is joined once per distinct
    run of fact keys instead of once per pair. ``hot`` may give the hot keys of
    each fact column (:func:`hot_keys_of`).
    """
    order = _as_list(order)
    runs: list[tuple[str, list[str]]] = []
    for fk, dk in keys:
        if runs and runs[-1][0] == fk:
            runs[-1][1].append(dk)
        else:
            runs.append((fk, [dk]))
    ordering = F.struct(*[_col(o) for o in order])
    result_cols = []
    joined = fact
    for i, (fk, dks) in enumerate(runs):
        # one pass over the dimension per run: each row yields one
        # (priority, key) pair per key column of the run
        types = {dict(dim.dtypes)[dk] for dk in dks}
        as_key = (lambda c: c) if len(types) == 1 else (lambda c: c.cast("string"))
        pairs = F.array(*[F.struct(F.lit(p).alias("__p"), as_key(_col(dk)).alias("__k"))
                          for p, dk in enumerate(dks)])
        cand = (dim.select(F.explode(pairs).alias("__e"), _col(value).alias("__v"), ordering.alias("__o"))
                .select(F.col("__e.__k").alias("__k"), F.col("__e.__p").alias("__p"), "__v", "__o")
                .where(F.col("__k").isNotNull()))
        # per key: first row's value within each priority, then the first non-null
        per_prio = [
            F.min_by(F.col("__v"), F.when(F.col("__p") == p, F.col("__o")))
            for p in range(len(dks))
        ]
        best = per_prio[0] if len(per_prio) == 1 else F.coalesce(*per_prio)
        name = f"__fb{i}"
        right = cand.groupBy("__k").agg(best.alias(name))
        small = _proven_small(dim, max_rows, broadcast, factor=len(dks))
        fkey, dkey = _join_keys(joined, *_common_type(joined, _col(fk), right, F.col("__k")), small)
        right = right.withColumn("__k", dkey)
        if small:
            joined = joined.withColumn("__fk", fkey).join(F.broadcast(right), F.col("__fk") == F.col("__k"), "left") \
                .drop("__fk", "__k")
        else:
            found = [f"k{h}" for h in hot.get(fk, [])] if hot is not None else hot_keys(joined, fkey) if salt_hot_keys else []
            joined = salted_join(joined, right, fkey, "__k", found)
        result_cols.append(F.col(name))
    pick = F.coalesce(*result_cols, F.lit(default)) if default is not None else F.coalesce(*result_cols)
    return joined.withColumn(out, pick).drop(*[f"__fb{i}" for i in range(len(runs))])


def map_with_table(fact: DataFrame, column: str, mapping: DataFrame, *, src: str = "from",
                   dst: str = "to", default: str | None = None, keep_unmapped: bool = True,
                   out: str | None = None, broadcast="auto") -> DataFrame:
    """X4/C1 with a mapping table: whole-value replacement in one pass.

    ``keep_unmapped`` keeps unmapped values (replace); otherwise they become
    ``default`` (map with default).  The first mapping row per source value
    wins; the join is a :func:`lookup`, so the broadcast bound, null-key
    spreading and hot-key salting apply.
    """
    out = out or column
    m = mapping.select(_col(src).alias("__mk"), _col(dst).alias("__mv"),
                       F.monotonically_increasing_id().alias("__mo"))
    j = lookup(fact, m, fact_key=column, dim_key="__mk", values=["__mv"], order=["__mo"], broadcast=broadcast)
    if keep_unmapped:
        mapped = F.coalesce(F.col("__mv"), _col(column))
    elif default is not None:
        mapped = F.coalesce(F.col("__mv"), F.lit(default))
    else:
        mapped = F.col("__mv")
    return j.withColumn(out, mapped).drop("__mv")
