"""Sorting, paging, ranking and navigation.

Every order ends in the record id, so ties are never left to chance
(the reference leaves them unspecified, Q-16).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import attrs as A

ATTR_PREFIXES = ("attributesList.", "attributes.")


def sort_key(field: str, numeric: bool = True) -> Column:
    """O1/O2: the sort key of a field name.  ``attributesList.X`` (or
    ``attributes.X``) sorts by the first value of attribute X, as an
    integer (P5) when ``numeric``."""
    for p in ATTR_PREFIXES:
        if field.startswith(p):
            v = A.first_value_of(field[len(p):])
            return A.leading_number(v) if numeric else v
    if field == "dateCreated":
        field = "date_created"
    return F.col(field)


def _dir(direction) -> int:
    return -1 if direction == -1 else 1   # anything but -1 means ascending (O1)


def order_columns(sort=("dateCreated", 1), secondary=None, id_col: str = "record_id",
                  numeric: bool = True) -> list[Column]:
    """Sort expressions for O1-O3.  The secondary key shares the primary
    direction (O3); the id is the final tie-break, ascending."""
    field, direction = sort
    d = _dir(direction)
    keys = [sort_key(field, numeric)]
    if secondary:
        keys.append(sort_key(secondary, numeric))
    cols = [k.asc() if d == 1 else k.desc() for k in keys]   # asc: nulls first, desc: nulls last
    return cols + [F.col(id_col).asc()]


def sort_records(df: DataFrame, sort=("dateCreated", 1), secondary=None, id_col="record_id",
                 numeric=True) -> DataFrame:
    return df.orderBy(*order_columns(sort, secondary, id_col, numeric))


def page_records(df: DataFrame, page: int | None, per_page: int | None, sort=("dateCreated", 1),
                 secondary=None, id_col="record_id") -> DataFrame:
    """0-based page of ``per_page`` rows.  Sort + limit is planned as a
    ``TakeOrderedAndProject`` (per-partition top-k, then merge) so no
    full sort of the table happens."""
    out = sort_records(df, sort, secondary, id_col)
    if page is None or per_page is None:
        return out
    return out.offset(page * per_page).limit(per_page) if page else out.limit(per_page)


def rank_records_window(df: DataFrame, scope: list[str], sort=("dateCreated", 1), secondary=None,
                        id_col="record_id") -> DataFrame:
    """W1 with a window partitioned by the scope: simple, but a scope
    holding a large share of all rows lands in one task.  Kept as the
    reference form for tests; ``rank_records`` is the skew-safe one."""
    order = order_columns(sort, secondary, id_col)
    w = Window.partitionBy(*scope).orderBy(*order)
    ranked = (df.withColumn("rank", F.row_number().over(w))
                .withColumn("prev_id", F.lag(id_col).over(w))
                .withColumn("next_id", F.lead(id_col).over(w)))
    ends = scope_ends(df, scope, sort, secondary, id_col)
    return ranked.join(ends, scope, "left")


def _reversed(id_col: Column, kind) -> Column:
    """A value that sorts the other way round than the id (integers, texts)."""
    if isinstance(kind, T.StringType):
        # the bytes' complement in hex; the last sign, above all digits, puts a longer text before its prefix
        return F.concat(F.translate(F.hex(id_col.cast("binary")), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("~"))
    if isinstance(kind, T.IntegralType):
        return -id_col.cast("decimal(20,0)")
    raise TypeError(f"ids must be integers or texts, not {kind.simpleString()}")


SAMPLE_PER_BUCKET = 32


def _boundaries(base: DataFrame, n: int) -> list:
    """At most n - 1 positions that cut the rows into about equal buckets:
    quantiles of the rows with the smallest id hashes, about 32 a bucket."""
    total = base.count()
    share = min(1.0, SAMPLE_PER_BUCKET * n / max(total, 1))
    some = base.where(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    found = some.agg(F.array_sort(F.collect_list("_pos"))).first()[0]
    return list(dict.fromkeys(found[len(found) * i // n] for i in range(1, n))) if found else []


def rank_records(df: DataFrame, scope: list[str], sort=("dateCreated", 1), secondary=None,
                 id_col="record_id", partitions: int | None = None) -> DataFrame:
    """Within each scope, ``rank`` (1-based), ``prev_id``, ``next_id``,
    ``first_id``, ``last_id`` over the sorted selection -- skew-safe, with one
    exchange of the rows and no table written.

    1. bucket boundaries, as positions (scope, sort keys, id), come from a
       small sample by id hash.  A row's bucket is a plain function of the row
       and these constants, so every use of it sees the same split, whatever
       Spark reuses or plans anew; a scope holding a third of all rows is
       spread over a third of the buckets;
    2. scopes cut by a boundary (at most one a boundary) are counted by
       bucket, with their end ids: a table of at most 2 x buckets rows, made
       into offsets by a small window and broadcast (a proven size bound);
    3. rows meet by bucket, windows by (bucket, scope) give the rank,
       neighbours and ends inside a bucket, and the offsets do the rest.
    Ids are integers or texts.
    Returns (id, scope..., rank, prev_id, next_id, first_id, last_id)."""
    if not scope:
        # one total order over the whole selection (the reference's list
        # view): same plan with a constant scope
        out = rank_records(df.withColumn("_all", F.lit(0)), ["_all"], sort, secondary, id_col, partitions)
        return out.drop("_all")
    spark = df.sparkSession
    keys = [sort_key(sort[0])] + ([sort_key(secondary)] if secondary else [])
    ks = [f"_k{i}" for i in range(len(keys))]
    desc = _dir(sort[1]) == -1
    base = df.select(*scope, *[k.alias(c) for c, k in zip(ks, keys, strict=True)], F.col(id_col).alias("_id"))
    # positions ascend inside a scope in sort order, or against it where the sort descends
    last = _reversed(F.col("_id"), base.schema["_id"].dataType) if desc else F.col("_id")
    base = base.withColumn("_pos", F.struct(*[F.col(c).alias(f"s{i}") for i, c in enumerate(scope)], *ks, last.alias("i")))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = _boundaries(base, n)
    if cuts:
        step = max(1, int(len(cuts) ** 0.5))
        fields = base.schema["_pos"].dataType.fields
        const = lambda rows: F.array(*[F.struct(*[F.lit(r[f.name]).cast(f.dataType).alias(f.name) for f in fields]) for r in rows])
        fine, coarse = const(cuts), const(cuts[::step])
        upto = lambda a: F.size(F.filter(a, lambda x: x <= F.col("_pos")))
        # the coarse count is bound once a row, as a lambda's variable
        fall = lambda c: F.when(c == 0, 0).otherwise((c - 1) * step + upto(F.slice(fine, (c - 1) * step + 1, F.lit(step))))
        bucket = F.get(F.transform(F.array(upto(coarse)), fall), 0)
        # rows of the scopes that a boundary lies in: the scopes are constants, no bucket is worked out to find them
        ends = spark.range(1).select(F.explode(fine).alias("x")).select(*[F.col(f"x.s{i}").alias(f"_e{i}") for i in range(len(scope))]).distinct()
        cut = base.join(F.broadcast(ends), [F.col(c).eqNullSafe(F.col(f"_e{i}")) for i, c in enumerate(scope)], "left_semi").withColumn("_b", bucket)
        base = base.withColumn("_b", bucket)
    else:
        base = base.withColumn("_b", F.lit(0))
    dealt = base.repartition(n, "_b") if cuts else base

    korder = [F.col(c).desc() if desc else F.col(c).asc() for c in ks] + [F.col("_id").asc()]
    w = Window.partitionBy("_b", *scope).orderBy(*korder)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    loc = dealt.select(
        "_id", "_b", *scope, F.row_number().over(w).cast("long").alias("_rank"),
        F.lag("_id").over(w).alias("_prev"), F.lead("_id").over(w).alias("_next"),
        F.first("_id").over(whole).alias("_pfirst"), F.last("_id").over(whole).alias("_plast"))
    if not cuts:
        return loc.select(F.col("_id").alias(id_col), *scope, F.col("_rank").alias("rank"), F.col("_prev").alias("prev_id"),
                          F.col("_next").alias("next_id"), F.col("_pfirst").alias("first_id"), F.col("_plast").alias("last_id"))

    low, high = F.min_by("_id", "_pos"), F.max_by("_id", "_pos")
    edges = (cut.groupBy("_b", *scope)
             .agg(F.count(F.lit(1)).alias("_cnt"), (high if desc else low).alias("_bf"), (low if desc else high).alias("_bl")))
    w = Window.partitionBy(*scope).orderBy(F.col("_b").desc() if desc else F.col("_b").asc())
    wall = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fix = edges.select(
        F.col("_b").alias("_fb"), *[F.col(c).alias(f"_s_{c}") for c in scope],
        F.coalesce(F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.lag("_bl").over(w).alias("_pl"), F.lead("_bf").over(w).alias("_nf"),
        F.first("_bf").over(wall).alias("_sf"), F.last("_bl").over(wall).alias("_sl"))
    # at most one scope a boundary, in at most one bucket more than its boundaries: broadcast is size-bounded
    same = [F.col("_b") == F.col("_fb")] + [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in scope]
    j = loc.join(F.broadcast(fix), same, "left")
    return j.select(
        F.col("_id").alias(id_col), *scope,
        (F.col("_rank") + F.coalesce(F.col("_off"), F.lit(0))).alias("rank"),
        F.coalesce(F.col("_prev"), F.col("_pl")).alias("prev_id"),
        F.coalesce(F.col("_next"), F.col("_nf")).alias("next_id"),
        F.coalesce(F.col("_sf"), F.col("_pfirst")).alias("first_id"),
        F.coalesce(F.col("_sl"), F.col("_plast")).alias("last_id"))


def ranked_page(df: DataFrame, first: int, n: int, sort=("dateCreated", 1), secondary=None, id_col="record_id") -> DataFrame:
    """W1 over a whole selection for one page: rows of rank ``first`` + 1 to
    ``first`` + n with their neighbours, by a top-k of one row more than the
    page's end (no sort or rank of the rest)."""
    keys = df.select(F.col(id_col).alias("_id"), F.struct(*[c.alias(f"k{i}") for i, c in enumerate(
        [sort_key(sort[0])] + ([sort_key(secondary)] if secondary else []))]).alias("_k"))
    names = [f"_k.k{i}" for i in range(2 if secondary else 1)]
    desc = _dir(sort[1]) == -1
    order = [F.col(c).desc() if desc else F.col(c).asc() for c in names] + [F.col("_id").asc()]
    w = Window.orderBy(*order)
    top = keys.orderBy(*order).limit(first + n + 1)
    got = top.select(F.col("_id").alias(id_col), F.row_number().over(w).cast("long").alias("rank"),
                     F.lag("_id").over(w).alias("prev_id"), F.lead("_id").over(w).alias("next_id"))
    return got.where((F.col("rank") > first) & (F.col("rank") <= first + n))


def _sort_struct(sort, secondary, id_col) -> tuple[Column, bool]:
    """A struct whose natural (ascending, nulls first) order is the sort
    order; for descending sorts the struct is compared reversed."""
    field, direction = sort
    keys = [sort_key(field)] + ([sort_key(secondary)] if secondary else [])
    return F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)]), _dir(direction) == -1


def scope_ends(df: DataFrame, scope: list[str], sort=("dateCreated", 1), secondary=None,
               id_col="record_id") -> DataFrame:
    """first / last id per scope in sort order, as an aggregate."""
    s, desc = _sort_struct(sort, secondary, id_col)
    idc = F.col(id_col)
    if not desc:
        # ascending key (nulls first), id ascending
        o = F.struct(s.alias("s"), idc.alias("i"))
        first, last = F.min_by(idc, o), F.max_by(idc, o)
    else:
        # descending key (nulls last), id ascending: the first row has the
        # largest key and, among equals, the smallest id
        o = F.struct(s.alias("s"), _reversed(idc, df.schema[id_col].dataType).alias("i"))
        first, last = F.max_by(idc, o), F.min_by(idc, o)
    return df.groupBy(*scope).agg(first.alias("first_id"), last.alias("last_id"))


def navigate_all(df: DataFrame, scope: list[str], sort=("dateCreated", 1), id_col="record_id") -> DataFrame:
    """W2 for every record: wrap-around navigation built on W1."""
    r = rank_records(df, scope, sort, None, id_col)
    return r.select(id_col, *scope, "rank",
                    F.coalesce("prev_id", "last_id").alias("prev_id"),
                    F.coalesce("next_id", "first_id").alias("next_id"),
                    "first_id", "last_id")


def navigate(df: DataFrame, target_id, scope: list[str], sort=("dateCreated", 1),
             id_col="record_id") -> DataFrame:
    """W2 for one target, without a window: one aggregate per scope
    compares every record's (key, id) with the target's, in either
    direction.  An empty ``scope`` navigates the whole selection; a NULL
    scope is a scope of its own.  Ids are integers or texts.

    Returns one row per scope that contains the target."""
    if not scope:
        return navigate(df.withColumn("_all", F.lit(0)), target_id, ["_all"], sort, id_col).drop("_all")
    field, direction = sort
    desc = _dir(direction) == -1
    # rows in sort order have ascending positions, or descending ones with the id's sign turned (ties stay by id)
    last = _reversed(F.col(id_col), df.schema[id_col].dataType) if desc else F.col(id_col)
    pos = F.struct(sort_key(field).alias("k"), last.alias("i"))
    base = df.select(*scope, F.col(id_col).alias("_id"), pos.alias("_p"))
    tgt = base.where(F.col("_id") == F.lit(target_id)).select(
        *[F.col(c).alias(f"_t_{c}") for c in scope], F.col("_p").alias("_tp"), F.col("_id").alias("_tid"))
    # the target side holds one row (ids are unique): a proven size bound
    j = base.join(F.broadcast(tgt), [base[c].eqNullSafe(tgt[f"_t_{c}"]) for c in scope])
    low, high = F.col("_p") < F.col("_tp"), F.col("_p") > F.col("_tp")
    before, after = (high, low) if desc else (low, high)
    nearest, farthest = (F.min_by, F.max_by) if desc else (F.max_by, F.min_by)
    agg = j.groupBy(*scope, "_tid").agg(
        (F.lit(1) + F.count_if(before)).alias("rank"),
        nearest(F.when(before, F.col("_id")), F.when(before, F.col("_p"))).alias("prev_id"),
        farthest(F.when(after, F.col("_id")), F.when(after, F.col("_p"))).alias("next_id"),
        farthest(F.col("_id"), F.col("_p")).alias("first_id"),
        nearest(F.col("_id"), F.col("_p")).alias("last_id"),
    )
    return agg.select(F.col("_tid").alias(id_col), *scope, "rank",
                      F.coalesce("prev_id", "last_id").alias("prev_id"),
                      F.coalesce("next_id", "first_id").alias("next_id"),
                      "first_id", "last_id")


def ordinal_names(attrs="attributes", strip_spaces: bool = True) -> Column:
    """Per attribute position the export name: key, key_2, key_3 ... in
    array order for repeated keys (spaces removed first when asked); a number
    that makes a name already taken is passed over."""
    keys = A.field(attrs, "key")
    # regexp_replace on the whole array at once (array_join/split would
    # break on keys holding the separator), then number repeats
    keys = F.transform(keys, lambda k: F.regexp_replace(k, " ", "")) if strip_spaces else keys

    def take(taken, k):
        tries = F.transform(F.sequence(F.lit(2), F.size(taken) + 2), lambda i: F.concat(k, F.lit("_"), i.cast("string")))
        free = F.get(F.filter(tries, lambda t: ~F.coalesce(F.array_contains(taken, t), F.lit(False))), 0)
        return F.concat(taken, F.array(F.when(F.coalesce(F.array_contains(taken, k), F.lit(False)), free).otherwise(k)))

    return F.aggregate(keys, F.array().cast("array<string>"), take)


def first_n_per_group(df: DataFrame, group_cols: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group; Spark plans the row_number
    filter as a group limit (per-partition top-n before the shuffle)."""
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
