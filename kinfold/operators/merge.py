"""Key merges with match indicator, cardinality check and hot-key safety.

A member table joined to its own per-household totals arrives already partitioned
by household on the totals' side, and Spark would then re-use that partitioning.
AQE splits an oversized partition only where both inputs of a sort-merge join are
fresh exchanges, so one household holding a third of all rows would stay in one
task. Joining on the key plus a hash of the key asks for fresh exchanges, and AQE
then splits the hot partition at run time; sides below the broadcast threshold are
still broadcast after their size is known.
"""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

_HASH = "__key_hash"
_SEEN = "__right_seen"
_COUNT = "__key_count"

BASE_ONLY, LOOKUP_ONLY, MATCHED = 1, 2, 3


def _keys(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


COUNTS = ("base_rows", "lookup_rows", "matched", "base_only", "lookup_only", "base_repeats", "lookup_repeats")


@dataclass
class MergeReport:
    """Match counts of named merges, added up by the very run that uses them.

    Counts come as observed metrics of the merges' own inputs and output, so they cost neither a job nor an exchange. A merge's counts
    are known once the first action over it is done; merges that haven't run yet, or that Spark found to be empty and
    left out, have none.
    """

    watched: list[tuple[str, bool, Observation]] = field(default_factory=list)

    def observe(self, name: str, one_to_one: bool | str, df: DataFrame, **counts) -> DataFrame:
        seen = Observation()
        self.watched.append((name, bool(one_to_one), seen))
        return df.observe(seen, *[c.alias(k) for k, c in counts.items()])

    def counts(self) -> dict[str, dict[str, int | None]]:
        """Counts by merge name, in the order of the merges.

        ``lookup_only`` is known for merges that keep such rows and for one-to-one merges, repeats (rows whose key came
        before) for the sides that a merge checks.
        """
        found: dict[str, dict[str, int | None]] = {}
        # Metrics arrive by the listener's queue, after the action itself.
        SparkSession.getActiveSession().sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        for name, one_to_one, seen in self.watched:
            own = found.setdefault(name, {"one_to_one": one_to_one})
            if seen._jo.future().isCompleted():
                own.update(seen.get)
        for own in found.values():
            base, lookup, matched = (own.get(k) for k in ("base_rows", "lookup_rows", "matched"))
            if matched is not None and base is not None:
                own.setdefault("base_only", base - matched)
            if matched is not None and lookup is not None and own["one_to_one"]:
                own.setdefault("lookup_only", lookup - matched)
        return {name: {k: own.get(k) for k in COUNTS} for name, own in found.items()}

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(name, *own.values()) for name, own in self.counts().items()]
        return spark.createDataFrame(rows, "merge string, " + ", ".join(f"{c} bigint" for c in COUNTS))


_report: ContextVar[MergeReport | None] = ContextVar("report", default=None)


@contextmanager
def merge_report():
    """Named merges that are built inside are counted; gives the report, to be read after the frames have been used."""
    report = MergeReport()
    token = _report.set(report)
    try:
        yield report
    finally:
        _report.reset(token)


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return df.groupBy(*_keys(keys)).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def _numbered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumn(_COUNT, F.row_number().over(Window.partitionBy(*keys).orderBy(*keys)))


def _once(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of numbered rows the first of each key; the job fails at a second one."""
    message = F.concat(F.lit("key is not unique: "), F.to_json(F.struct(*keys)))
    unique = F.when(F.col(_COUNT) > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return df.filter(unique).drop(_COUNT)


def require_unique(df: DataFrame, keys) -> DataFrame:
    """The same rows; the job fails when a key occurs twice.

    The check is part of the plan, so it costs no pass of its own: rows are numbered within
    their key, and the sort for it is the one a merge join on the key needs. The job stops at a
    second row, so no key gathers more than that in vain.
    """
    keys = _keys(keys)
    return _once(_numbered(df, keys), keys)


def _counted(df: DataFrame, keys: Sequence[str], side: str, check: bool, stop: bool, report: MergeReport | None, name: str | None,
             one_to_one: bool | str) -> DataFrame:
    """One side of a merge, checked and counted as asked for; counting repeats shares the window of the check."""
    if check:
        df = _numbered(df, keys)
    if report is not None:
        counts = {f"{side}_rows": F.count(F.lit(1))}
        if check:
            counts[f"{side}_repeats"] = F.count_if(F.col(_COUNT) > 1)
        df = report.observe(name, one_to_one, df, **counts)
    if not check:
        return df
    return _once(df, keys) if stop else df.drop(_COUNT)


def join_on(left: DataFrame, right: DataFrame, keys, how: str = "left",
            null_safe: bool = False, split_hot: bool = True) -> DataFrame:
    """Equi-join on same-named keys, keeping the left key columns.

    ``null_safe`` lets missing keys match each other. ``split_hot=False`` keeps the
    partitioning of the inputs; it is meant for sides that are both unique by key.
    """
    keys = _keys(keys)
    if split_hot:
        left = left.withColumn(_HASH, F.xxhash64(*keys))
        right = right.withColumn(_HASH, F.xxhash64(*keys))
    on = keys + ([_HASH] if split_hot else [])
    if not null_safe:
        return left.join(right, on, how).drop(_HASH)
    named = right.select(*[F.col(c).alias(f"__r_{c}") if c in on else F.col(c) for c in right.columns])
    condition = reduce(and_, [left[c].eqNullSafe(named[f"__r_{c}"]) for c in on])
    return left.join(named, condition, how).drop(_HASH, *[f"__r_{c}" for c in on])


def merge(base: DataFrame, lookup: DataFrame, keys, *, keep: str = "base", indicator: str | None = None,
          null_safe: bool = False, validate: bool | str = True, one_to_one: bool | str = False, split_hot: bool = True,
          name: str | None = None) -> DataFrame:
    """Many-to-one merge of ``lookup`` (unique by key) into ``base``.

    The job stops at a key that the lookup has twice, with ``one_to_one`` also at one that the
    base has twice. ``validate=False`` is for inputs that are unique by construction; ``validate="count"`` only counts
    repeated keys in the report, and a base row then meets every lookup row of its key. ``one_to_one="known"`` says that
    the base has no repeated keys by construction: it isn't checked, but counted as one-to-one.

    ``keep`` is ``"base"`` (all base rows), ``"matched"`` or ``"all"`` (also rows only
    in the lookup). ``indicator`` names a column with 1 base only, 2 lookup only,
    3 matched. Non-key columns that both sides have are taken from the base. A merge with a ``name`` is counted inside
    ``merge_report``.
    """
    if keep not in ("base", "matched", "all"):
        raise ValueError(f"keep must be base, matched or all, not {keep!r}")
    keys = _keys(keys)
    overlap = [c for c in lookup.columns if c in base.columns and c not in keys]
    lookup = lookup.drop(*overlap)
    report = _report.get() if name is not None else None
    stop = validate != "count"
    lookup = _counted(lookup, keys, "lookup", bool(validate), stop, report, name, one_to_one)
    base = _counted(base, keys, "base", bool(validate) and one_to_one is True, stop, report, name, one_to_one)
    if keep == "matched":
        out = join_on(base, lookup, keys, "inner", null_safe, split_hot)
        if report is not None:
            out = report.observe(name, one_to_one, out, matched=F.count(F.lit(1)))
        return out.withColumn(indicator, F.lit(MATCHED)) if indicator else out
    if indicator is None and keep == "base" and report is None:
        return join_on(base, lookup, keys, "left", null_safe, split_hot)

    mark = indicator or "_merge"
    joined = join_on(base, lookup.withColumn(_SEEN, F.lit(True)), keys, "left", null_safe, split_hot)
    if report is not None:
        joined = report.observe(name, one_to_one, joined, matched=F.count_if(F.col(_SEEN)), base_only=F.count_if(F.col(_SEEN).isNull()))
    out = joined.withColumn(mark, F.when(F.col(_SEEN), MATCHED).otherwise(BASE_ONLY)).drop(_SEEN)
    if keep == "all":
        # A full outer join cannot be split on a hot base key; a left join plus the
        # lookup rows without any base key can, and the keys are reduced before they move.
        base_keys = base.select(*keys).distinct()
        unseen = join_on(lookup, base_keys, keys, "left_anti", null_safe, split_hot=False)
        if report is not None:
            unseen = report.observe(name, one_to_one, unseen, lookup_only=F.count(F.lit(1)))
        out = out.unionByName(unseen.withColumn(mark, F.lit(LOOKUP_ONLY)), allowMissingColumns=True)
    return out if indicator else out.drop(mark)


def with_suffix(df: DataFrame, suffix: str, except_for: Sequence[str] = ()) -> DataFrame:
    """Every column renamed with a suffix, but for the listed keys."""
    return df.withColumnsRenamed({c: c + suffix for c in df.columns if c not in set(except_for)})


def parent_lookup(members: DataFrame, household: str, member_id: str, parent_id: str,
                  attributes: Sequence[str], suffix: str, tiebreak: Sequence, name: str | None = None,
                  among: DataFrame | None = None) -> DataFrame:
    """Attach attributes of the member whose id is named in ``parent_id``.

    Missing parent ids match a member with a missing id, as in the survey's rules;
    where two members share an id the first by ``tiebreak`` is used. ``among`` are the same members from before other
    merges, which are then not run again for the lookup.
    """
    from kinfold.operators.dedup import first_per_key

    parents = first_per_key(members if among is None else among, [household, member_id], tiebreak)
    parents = with_suffix(
        parents.select(household, F.col(member_id).alias(parent_id), *[c for c in attributes if c != parent_id]),
        suffix, except_for=[household, parent_id],
    )
    return merge(members, parents, [household, parent_id], null_safe=True, validate=False, name=name)
