"""Join-based enrichment and existence logic.

Broadcast policy: only dimensions that are small by nature (fixed code
catalogs, the site list) are broadcast explicitly (``small=True``), and only
after their rows have been counted (``MOST_SMALL``; beyond it the join is
planned like any other). Anything that grows with the data is left to the planner; with AQE on, a side is
turned into a broadcast only after its runtime size is measured under
``spark.sql.autoBroadcastJoinThreshold``, otherwise it stays a shuffle join
(with skew-splitting of hot keys).

Per-row scans of another table (existence, correlated counts, last date,
status priority) are rewritten as one aggregate of the fact table per key,
then one left join: linear instead of quadratic, and the aggregate uses
map-side partial combining, so a hot key cannot overload one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelake.functions._col import as_col

__all__ = [
    "enrich", "broadcast_small", "flag_in", "flags_in", "inverse_flag", "match_marker", "count_matching", "last_value",
    "status_by_priority", "fill_from", "overwrite_from", "fill_for_codes", "anti", "semi", "as_of", "match_phrases", "unknown_codes",
    "StatusRule",
]


def _keys(on):
    return [on] if isinstance(on, str) else list(on)


#: Rows of a dimension that is broadcast on request.
MOST_SMALL = 100_000


def broadcast_small(df: DataFrame, rows_of: DataFrame | None = None, most: int = MOST_SMALL) -> DataFrame:
    """``df`` hinted for broadcast if it has at most ``most`` rows, else as it is.

    ``rows_of`` is counted in its place: a cheaper frame with as many rows
    (``df`` before columns were joined to it by unique keys).
    """
    counted = (df if rows_of is None else rows_of).limit(most + 1).count()
    return F.broadcast(df) if counted <= most else df


def _maybe_broadcast(df: DataFrame, small: bool) -> DataFrame:
    return broadcast_small(df) if small else df


def enrich(df: DataFrame, dim: DataFrame, on, how: str = "left", right_on=None,
           null_safe: bool = False, defaults: dict | None = None, small: bool = False,
           select=None) -> DataFrame:
    """Join ``dim`` onto ``df``.

    ``on`` (and ``right_on`` when the names differ, J3) may be one key or a
    list (J2). ``null_safe`` makes NULL keys match (pandas merge semantics).
    The right-side key columns are dropped. ``defaults`` fills unmatched
    values (J17). ``select`` restricts the dimension's value columns.
    """
    lk = _keys(on)
    rk = _keys(right_on) if right_on is not None else lk
    if select is not None:
        dim = dim.select(*rk, *[c for c in select if c not in rk])
    tmp = [f"__rk{i}" for i in range(len(rk))]
    d = dim.select(*[F.col(r).alias(t) for r, t in zip(rk, tmp)],
                   *[c for c in dim.columns if c not in rk])
    d = _maybe_broadcast(d, small)
    conds = [(F.col(lc).eqNullSafe(F.col(t)) if null_safe else (F.col(lc) == F.col(t)))
             for lc, t in zip(lk, tmp)]
    out = df.join(d, reduce(lambda a, b: a & b, conds), how).drop(*tmp)
    if defaults:
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
    return out


def _key_set(ids: DataFrame, on, right_on=None):
    rk = _keys(right_on) if right_on is not None else _keys(on)
    tmp = [f"__k{i}" for i in range(len(rk))]
    return ids.select(*[F.col(r).alias(t) for r, t in zip(rk, tmp)]).distinct(), tmp


def flag_in(df: DataFrame, ids: DataFrame, on, name: str, hit=1, miss=0, right_on=None,
            small: bool = False) -> DataFrame:
    """``hit`` if the key is in ``ids`` else ``miss``.

    ``ids`` is reduced to distinct keys first (aggregated per key, partial
    combine), so duplicates in it never multiply rows of ``df``.
    """
    ks, tmp = _key_set(ids, on, right_on)
    ks = _maybe_broadcast(ks.withColumn("__hit", F.lit(True)), small)
    conds = [F.col(lc) == F.col(t) for lc, t in zip(_keys(on), tmp)]
    return (df.join(ks, reduce(lambda a, b: a & b, conds), "left")
            .withColumn(name, F.when(F.col("__hit"), F.lit(hit)).otherwise(F.lit(miss)))
            .drop("__hit", *tmp))


def inverse_flag(df: DataFrame, ids: DataFrame, on, name: str, right_on=None) -> DataFrame:
    """0 when the key is in ``ids`` (e.g. the previous list), else 1."""
    return flag_in(df, ids, on, name, hit=0, miss=1, right_on=right_on)


def match_marker(df: DataFrame, dim: DataFrame, on, name: str, yes="SI", no="NO",
                 right_on=None) -> DataFrame:
    """``'SI'``/``'NO'`` by whether the key exists in ``dim``."""
    return flag_in(df, dim, on, name, hit=yes, miss=no, right_on=right_on)


def flags_in(df: DataFrame, facts: DataFrame, on, flags: dict | None = None, counts: dict | None = None,
             latest: dict | None = None, right_on=None) -> DataFrame:
    """J8/J10/J11/J12 for many predicates: ONE aggregate of the fact per key and
    one left join, however many columns are asked for.

    ``flags``: name -> predicate (1/0); ``counts``: name -> predicate (0 when
    none); ``latest``: name -> (column, predicate or None), NULL when none.
    """
    flags, counts, latest = flags or {}, counts or {}, latest or {}
    rk = _keys(right_on) if right_on is not None else _keys(on)
    aggs = [F.max(F.when(p, 1).otherwise(0)).alias(n) for n, p in flags.items()]
    aggs += [F.count_if(p).alias(n) for n, p in counts.items()]
    aggs += [F.max(F.when(p, F.col(c)) if p is not None else F.col(c)).alias(n) for n, (c, p) in latest.items()]
    return enrich(df, facts.groupBy(*rk).agg(*aggs), on, right_on=rk, defaults={n: 0 for n in (*flags, *counts)})


def count_matching(df: DataFrame, facts: DataFrame, on, name: str, predicate: Column | None = None,
                   right_on=None) -> DataFrame:
    """Per key, number of fact rows satisfying ``predicate`` (0 when none)."""
    rk = _keys(right_on) if right_on is not None else _keys(on)
    f = facts if predicate is None else facts.filter(predicate)
    agg = f.groupBy(*rk).agg(F.count(F.lit(1)).alias(name))
    return enrich(df, agg, on, right_on=rk, defaults={name: 0})


def last_value(df: DataFrame, facts: DataFrame, on, value: str, name: str, right_on=None,
               predicate: Column | None = None, agg: str = "max") -> DataFrame:
    """Per key, ``max``/``min`` of a fact column (NULL when no row)."""
    rk = _keys(right_on) if right_on is not None else _keys(on)
    f = facts if predicate is None else facts.filter(predicate)
    fn = F.max if agg == "max" else F.min
    a = f.groupBy(*rk).agg(fn(value).alias(name))
    return enrich(df, a, on, right_on=rk)


class StatusRule:
    """One priority level: rows matching ``predicate`` give ``label``."""

    def __init__(self, label: str, predicate: Column):
        self.label, self.predicate = label, predicate


def status_by_priority(df: DataFrame, facts: DataFrame, on, rules, default: str,
                       name: str = "status", right_on=None) -> DataFrame:
    """The first rule (in priority order) any of the key's rows meets.

    One aggregate per key computes ``max(priority)`` over matching rows; the
    key's status is the label of the best level; keys without any matching
    row (or absent from ``facts``) get ``default``.
    """
    rk = _keys(right_on) if right_on is not None else _keys(on)
    n = len(rules)
    level = None
    for i, r in enumerate(rules):
        level = (F.when(r.predicate, F.lit(n - i)) if level is None
                 else level.when(r.predicate, F.lit(n - i)))
    a = facts.groupBy(*rk).agg(F.max(level).alias("__lvl"))
    lab = None
    for i, r in enumerate(rules):
        lab = (F.when(F.col("__lvl") == n - i, F.lit(r.label)) if lab is None
               else lab.when(F.col("__lvl") == n - i, F.lit(r.label)))
    return enrich(df, a, on, right_on=rk).withColumn(name, lab.otherwise(F.lit(default))).drop("__lvl")


def unknown_codes(facts: DataFrame, col: str, known) -> DataFrame:
    """Rows per state code that is neither NULL nor one of the ``known`` ones."""
    return (facts.filter(F.col(col).isNotNull() & ~F.col(col).isin(*known)).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n")))


def fill_from(df: DataFrame, dst: str, src, name: str | None = None) -> DataFrame:
    """Missing ``dst`` values take ``src`` (``fillna(other)``)."""
    return df.withColumn(name or dst, F.coalesce(F.col(dst), as_col(src)))


def overwrite_from(df: DataFrame, dst: str, src, name: str | None = None) -> DataFrame:
    """``src`` wins where present, else keep ``dst``."""
    return df.withColumn(name or dst, F.coalesce(as_col(src), F.col(dst)))


def fill_for_codes(df: DataFrame, code_col: str, codes, fills: dict) -> DataFrame:
    """For listed codes only, missing columns take the given value/column."""
    hit = F.col(code_col).isin(*codes)
    return df.withColumns({
        c: F.when(hit & F.col(c).isNull(), v if isinstance(v, Column) else F.lit(v)).otherwise(F.col(c))
        for c, v in fills.items()
    })


def anti(df: DataFrame, other: DataFrame, on, right_on=None, null_safe: bool = False) -> DataFrame:
    """Rows of ``df`` whose key is absent from ``other`` (NULL keys kept,
    or with ``null_safe`` compared like any other)."""
    lk = _keys(on)
    rk = _keys(right_on) if right_on is not None else lk
    tmp = [f"__a{i}" for i in range(len(rk))]
    o = other.select(*[F.col(r).alias(t) for r, t in zip(rk, tmp)])
    same = [F.col(l).eqNullSafe(F.col(t)) if null_safe else F.col(l) == F.col(t) for l, t in zip(lk, tmp)]
    return df.join(o, reduce(lambda a, b: a & b, same), "left_anti")


def as_of(df: DataFrame, other: DataFrame, on, at: str, other_at: str, cols) -> DataFrame:
    """``df`` with ``cols`` of the latest row of ``other`` at or before ``at``, per key (G10 for each key and time).

    Both sides meet by key and *distinct* time: a window runs over the times
    of a key, not over its rows, so a key with very many rows is no task of
    its own; the rows get the result by a plain join. ``other`` has one row
    per key and time (of several the greatest counts). NULL keys are a key,
    a NULL time finds nothing.
    """
    keys, cols = _keys(on), list(cols)
    got = [f"__v_{c}" for c in cols]
    times = df.select(*keys, F.col(at).alias("__at")).distinct().withColumn("__s", F.lit(None).cast(
        T.StructType([T.StructField(g, other.schema[c].dataType) for g, c in zip(got, cols)])))
    known = other.groupBy(*keys, F.col(other_at).alias("__at")).agg(
        F.max(F.struct(*[F.col(c).alias(g) for g, c in zip(got, cols)])).alias("__s")).filter("__at is not null")
    w = Window.partitionBy(*keys).orderBy("__at").rangeBetween(Window.unboundedPreceding, 0)
    filled = times.withColumn("__asked", F.lit(True)).unionByName(known.withColumn("__asked", F.lit(False))).withColumn(
        "__s", F.last("__s", ignorenulls=True).over(w)).filter("__asked and __at is not null")
    side = filled.select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__at", *[F.col(f"__s.{g}").alias(g) for g in got])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys] + [F.col(at) == F.col("__at")])
    out = df.join(side, same, "left").drop("__at", *[f"__k_{k}" for k in keys])
    return out.withColumnsRenamed(dict(zip(got, cols)))


#: Phrases whose keys are broadcast.
MOST_PHRASES = 100_000


def plain_words(c) -> Column:
    """Lower-cased text whose words (letters and digits) stand between single spaces, also at both ends."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(as_col(c)), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))


def match_phrases(messages: DataFrame, phrases: DataFrame, text: str, phrase: str) -> DataFrame:
    """Every message with every phrase that its text holds as whole words (columns of both).

    Texts and phrases meet on a shared index of adjacent word pairs (of single
    words for a one-word phrase): a phrase's key is its pair with the most
    letters, and a text is indexed by those of its pairs that are a key.
    What meets is verified. Phrases without a word match nothing.
    """
    words = F.split(F.trim(plain_words(phrase)), " ")
    pairs = F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1)))
    longest = F.array_max(F.transform(pairs, lambda p: F.struct(F.length(p).alias("n"), p.alias("p"))))
    p = phrases.filter(F.trim(plain_words(phrase)) != "").select(
        "*", plain_words(phrase).alias("__phrase"), F.when(F.size(words) == 1, F.get(words, 0)).otherwise(longest["p"]).alias("__key"))
    keys = p.select("__key").distinct()
    side = F.broadcast(keys) if keys.count() <= MOST_PHRASES else keys
    m = messages.select("*", plain_words(text).alias("__text"))
    own = F.split(F.trim("__text"), " ")
    grams = F.array_distinct(F.concat(own, F.when(F.size(own) < 2, F.array().cast("array<string>")).otherwise(F.transform(
        F.sequence(F.lit(0), F.size(own) - 2), lambda i: F.concat_ws(" ", F.get(own, i), F.get(own, i + 1))))))
    found = m.select("*", F.explode(grams).alias("__key")).join(side, "__key", "left_semi")
    return found.join(p, "__key").filter(F.contains("__text", F.col("__phrase"))).drop("__key", "__text", "__phrase")


def semi(df: DataFrame, other: DataFrame, on, right_on=None) -> DataFrame:
    """Rows of ``df`` whose key exists in ``other`` (no row multiplication)."""
    lk = _keys(on)
    rk = _keys(right_on) if right_on is not None else lk
    tmp = [f"__s{i}" for i in range(len(rk))]
    o = other.select(*[F.col(r).alias(t) for r, t in zip(rk, tmp)])
    return df.join(o, reduce(lambda a, b: a & b, [F.col(l) == F.col(t) for l, t in zip(lk, tmp)]),
                   "left_semi")
