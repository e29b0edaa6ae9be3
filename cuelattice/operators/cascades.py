"""Cascade deletion over a graph of tables: what goes with the rows of one table."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import stage


@dataclass(frozen=True)
class Link:
    """Rows of `child` whose child_key is a gone row's parent_key in `parent` go with it."""

    child: str
    child_key: str
    parent: str
    parent_key: str


def deletion_order(links: Iterable[Link], root: str) -> list[str]:
    """Tables that hang on the root, children before parents, the root last. A graph with a
    cycle among them has no such order and is refused."""
    children: dict[str, list[str]] = {}
    for x in links:
        children.setdefault(x.parent, []).append(x.child)
    order: list[str] = []
    path: list[str] = []

    def visit(table: str) -> None:
        if table in path:
            raise ValueError("tables hang on each other in a circle: " + " -> ".join([*path[path.index(table) :], table]))
        if table not in order:
            path.append(table)
            for child in sorted(set(children.get(table, []))):
                visit(child)
            path.pop()
            order.append(table)

    visit(root)
    return order


def plan_cascade(tables: dict[str, DataFrame], links: Iterable[Link], root: str, gone: DataFrame) -> list[tuple[str, DataFrame, DataFrame]]:
    """gone: the root's rows to delete -> for each table, children before parents, its name,
    the rows that go and the rows that stay. A row goes once, however many of its parents
    go; null keys hang on nothing. Only keys of gone rows are joined, each key once, and
    they are written once for the tables below."""
    links = list(links)
    order = deletion_order(links, root)
    known = [t for t in order if t not in tables]
    if known:
        raise ValueError("no table is given for " + ", ".join(known))
    found, keys = {}, {}
    for table in reversed(order):
        rows = tables[table]
        if table == root:
            going, staying = gone, rows.join(gone.select(*rows.columns).distinct(), rows.columns, "left_anti")
        else:
            marks = []
            for n, x in enumerate(k for k in links if k.child == table and k.parent in found):
                if (x.parent, x.parent_key) not in keys:
                    keys[x.parent, x.parent_key] = stage(found[x.parent][0].select(x.parent_key).filter(F.col(x.parent_key).isNotNull()).distinct())
                mark = f"_gone_{n}"
                other = keys[x.parent, x.parent_key].select(F.col(x.parent_key).alias(f"_key_{n}"), F.lit(True).alias(mark))
                rows = rows.join(other, F.col(x.child_key) == F.col(f"_key_{n}"), "left").drop(f"_key_{n}")
                marks.append(F.coalesce(F.col(mark), F.lit(False)))
            any_ = marks[0]
            for m in marks[1:]:
                any_ = any_ | m
            going, staying = (rows.filter(c).select(*tables[table].columns) for c in (any_, ~any_))
        found[table] = (going, staying)
    return [(t, *found[t]) for t in order]
