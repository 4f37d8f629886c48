"""Table contracts compiled into one pass: every rule of every table in one aggregate.

A :class:`Contract` lists a table's rules (NOT NULL, CHECK, DEFAULT, UNIQUE, FOREIGN KEY).
:func:`evaluate` turns each row of a table into the few marks its rules ask for:

* a row rule marks a row that violates it (no key);
* a UNIQUE rule marks each key value;
* a FOREIGN KEY marks the child's key, and the parent table marks its own key in slot 0.

The marks of all tables are united and counted by one partially aggregated
``groupBy(group, key)``. A key value is a violation if it was marked more than once
(UNIQUE), or by children but by no parent (FOREIGN KEY). So each table is scanned once
however many rules and references it has, nothing is joined, and a key that holds most rows (a
hot courier, a NULL) is reduced to one row per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("not_null", "check", "default", "unique", "fk")


@dataclass(frozen=True)
class Contract:
    """The rules of one table; ``foreign`` maps a column to (parent table, parent column)."""

    table: str
    not_null: Sequence[str] = ()
    checks: dict[str, Column] = field(default_factory=dict)   # column -> true for rows that conform
    defaults: Sequence[str] = ()
    unique: Sequence[Sequence[str]] = ()
    foreign: dict[str, tuple[str, str]] = field(default_factory=dict)


@dataclass(frozen=True)
class Rule:
    table: str
    name: str
    kind: str
    group: int      # keys of one group are counted together: a rule, or all references to one parent
    slot: int       # place within the group; a parent's own keys are slot 0
    key: Column | None          # what is marked; None marks the row
    applies: Column             # whether a row is marked
    columns: tuple[str, ...] = ()   # what it reads


def _key(columns: Sequence[str]) -> Column:
    """One text per key value; parts are told apart by their lengths, and a NULL part makes it NULL."""
    if len(columns) == 1:
        return F.col(columns[0]).cast("string")
    parts = [F.col(c).cast("string") for c in columns]
    return F.concat(*(x for p in parts for x in (F.length(p).cast("string"), F.lit(":"), p)))


def rules(contracts: Sequence[Contract], kinds: Sequence[str] = KINDS, arity: int | None = None) -> list[Rule]:
    """The rules of ``kinds``, numbered; ``arity`` 1 takes UNIQUE rules of one column, 2 those of several."""
    out, parents, number = [], {}, 0

    def add(contract: Contract, name: str, kind: str, key: Column | None, applies: Column, columns: Sequence[str] = ()) -> None:
        nonlocal number
        if kind in kinds:
            out.append(Rule(contract.table, f"{kind}:{name}", kind, number, 1, key, applies, tuple(columns or (name,))))
            number += 1
    for c in contracts:
        for col in c.not_null:
            add(c, col, "not_null", None, F.col(col).isNull())
        for name, holds in c.checks.items():
            add(c, name, "check", None, ~holds)   # a NULL passes, as in SQL
        for col in c.defaults:
            add(c, col, "default", None, F.col(col).isNull())
        for columns in c.unique:
            if arity in (None, min(len(columns), 2)):
                add(c, ",".join(columns), "unique", _key(columns), _key(columns).isNotNull(), columns)
    for c in contracts if "fk" in kinds else ():
        for col, parent in c.foreign.items():
            if parent not in parents:
                parents[parent] = [number, 0]
                number += 1
            parents[parent][1] += 1
            group, slot = parents[parent]
            out.append(Rule(c.table, f"fk:{col}->{parent[0]}", "fk", group, slot, _key([col]), _key([col]).isNotNull(), (col,)))
    for (table, col), (group, _) in parents.items():
        out.append(Rule(table, f"parent:{col}", "parent", group, 0, _key([col]), _key([col]).isNotNull(), (col,)))
    return out


def tables_of(found: Sequence[Rule]) -> set[str]:
    """Tables that the rules read, parents included."""
    return {r.table for r in found}


def columns_of(found: Sequence[Rule]) -> dict[str, set[str]]:
    """The columns that the rules read, by table."""
    out: dict[str, set[str]] = {}
    for r in found:
        out.setdefault(r.table, set()).update(r.columns)
    return out


def evaluate(tables: dict[str, DataFrame], found: Sequence[Rule]) -> DataFrame:
    """Rows (table, rule, violations), zero included; each table of ``tables`` is read once."""
    empty = F.lit(None).cast("string")
    marks = None
    for name in sorted(tables_of(found)):
        own = [F.when(r.applies, F.struct(F.lit(r.group).alias("group"), F.lit(r.slot).alias("slot"),
                                          (empty if r.key is None else r.key).alias("key")))
               for r in found if r.table == name]
        one = tables[name].select(F.inline(F.array(*own))).where(F.col("group").isNotNull())
        marks = one if marks is None else marks.union(one)
    slots = range(max(r.slot for r in found) + 1)
    counted = marks.groupBy("group", "key").agg(
        *(F.sum(F.when(F.col("slot") == i, 1).otherwise(0)).alias(f"n{i}") for i in slots))
    unique = F.col("group").isin(sorted({r.group for r in found if r.kind == "unique"}) or [-1])
    foreign = F.col("group").isin(sorted({r.group for r in found if r.kind == "fk"}) or [-1])

    def wrong(i: int) -> Column:
        return (F.when(unique, (F.col(f"n{i}") > 1).cast("bigint"))
                .when(foreign & (F.col("n0") > 0), F.lit(0).cast("bigint")).otherwise(F.col(f"n{i}")))
    totals = counted.groupBy("group").agg(*(F.sum(wrong(i)).alias(f"v{i}") for i in slots if i))
    found_rows = totals.select("group", F.inline(F.array(*(
        F.struct(F.lit(i).alias("slot"), F.col(f"v{i}").alias("violations")) for i in slots if i))))
    named = [(r.table, r.name, r.group, r.slot) for r in found if r.kind != "parent"]
    listed = marks.sparkSession.createDataFrame(named, "table string, rule string, group int, slot int")
    return (listed.join(found_rows, ["group", "slot"], "left")
            .select("table", "rule", F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations")))
