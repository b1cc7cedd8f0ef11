"""Every declared check in one report: (check_name, failures)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators import quality as q


def _row_rules(now: Column | None) -> dict[str, dict[str, Column]]:
    """The row-level rules by table; they are counted in that table's single pass."""
    rules: dict[str, dict[str, Column]] = {}
    for name, rule in q.row_rules(now).items():
        rules.setdefault(rule.table, {})[name] = rule.violation
    return rules


def _report_rows(frame: DataFrame, failures: Mapping[str, Column]) -> DataFrame:
    """One aggregate over ``frame``, turned into a row per check."""
    rows = [F.struct(F.lit(name).alias("check_name"), n.alias("failures")) for name, n in failures.items()]
    return frame.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def table_profile(table: str, frame: DataFrame, row_rules: Mapping[str, Column]) -> DataFrame:
    """All row-level checks of a table in one scan; a NULL condition is no violation."""
    conditions = {f"not_null:{table}.{c}": F.col(c).isNull() for c in q.NOT_NULL.get(table, ())}
    for owner, column, values in q.ACCEPTED_VALUES:
        if owner == table:
            conditions[f"accepted_values:{table}.{column}"] = ~F.col(column).isin(*values)
    conditions.update({f"rule:{name}": condition for name, condition in row_rules.items()})
    return _report_rows(frame, {name: F.count(F.when(condition, 1)) for name, condition in conditions.items()})


def _tables_of_key(key: str) -> list[str]:
    owners = [table for table, column in q.UNIQUE.items() if column == key]
    ends = [end for child, column, parent in q.RELATIONSHIPS if column == key for end in (child, parent)]
    return sorted({*owners, *ends} | ({"stg_order_items", "fact_orders"} if key == "order_id" else set()))


# Money that the pass over ``order_id`` carries along, to compare the order fact with its items.
ORDER_MONEY = {"stg_order_items": "line_total", "fact_orders": "order_value"}


def _money_of(name: str, key: str) -> Column:
    return (F.col(ORDER_MONEY[name]) if key == "order_id" and name in ORDER_MONEY else F.lit(None)).cast("decimal(30,2)")


def _add_money(name: str) -> Callable[[Column], Column]:
    return F.sum if name == "stg_order_items" else F.max


def key_counts(tables: q.Tables, key: str, names: Sequence[str]) -> DataFrame:
    """Rows per key value in each of the named tables, and for orders their money, from one shuffle of partial sums."""
    with_money = [name for name in names if key == "order_id" and name in ORDER_MONEY]
    stacked = reduce(
        DataFrame.unionByName,
        [
            tables[name]
            .filter(F.col(key).isNotNull())
            .select(F.col(key).alias("value"), F.lit(name).alias("table_name"), _money_of(name, key).alias("money"))
            for name in names
        ],
    )
    of = {name: F.col("table_name") == name for name in names}
    counts = [F.count(F.when(of[name], 1)).alias(name) for name in names]
    sums = [_add_money(name)(F.when(of[name], F.col("money"))).alias(f"{name}_money") for name in with_money]
    return stacked.groupBy("value").agg(*counts, *sums)


def _order_rules() -> dict[str, Column]:
    """Orders without items, and orders whose value is not that of their items, from counts and money per order."""
    empty = F.sum(F.when(F.col("stg_order_items") == 0, F.col("fact_orders")))
    again = F.coalesce("stg_order_items_money", F.lit(0))
    differs = F.sum(F.when(q.beyond_tolerance(F.col("fact_orders_money"), again), F.col("fact_orders")))
    failures = {"rule:orders_have_items": empty, "rule:revenue_matches_items": differs}
    return {name: F.coalesce(n, F.lit(0)) for name, n in failures.items()}


def _repeated(key: str, names: Sequence[str]) -> dict[str, Column]:
    return {
        f"unique:{table}.{key}": F.count(F.when(F.col(table) > 1, 1))
        for table, column in q.UNIQUE.items()
        if column == key and table in names
    }


def _orphans(child: str, key: str, parent: str) -> dict[str, Column]:
    orphans = F.sum(F.when(F.coalesce(parent, F.lit(0)) == 0, F.col(child)))
    return {f"relationships:{child}.{key}": F.coalesce(orphans, F.lit(0))}


def key_profile(tables: q.Tables, key: str) -> DataFrame:
    """Uniqueness and relationships of all tables that share a key, without a join per check."""
    names = _tables_of_key(key)
    failures = _repeated(key, names)
    for child, column, parent in q.RELATIONSHIPS:
        if column == key:
            failures |= _orphans(child, key, parent)
    if key == "order_id":
        failures |= _order_rules()
    return _report_rows(key_counts(tables, key, names), failures)


def bucketed_key_profile(tables: q.Tables, bucketed: Sequence[str]) -> DataFrame:
    """The same for ``order_id`` where the items and the order fact are bucketed by it.

    These two are summed where they lie and compared with each other without a shuffle; the other tables go through one
    shuffle of their partial sums, and meet whichever of the two they have to do with in a join that moves only them."""
    key = "order_id"
    others = [name for name in _tables_of_key(key) if name not in bucketed]
    moved = key_counts(tables, key, others)
    here = {
        name: tables[name]
        .filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("value"))
        .agg(F.count(F.lit(1)).alias(name), _add_money(name)(_money_of(name, key)).alias(f"{name}_money"))
        for name in bucketed
    }
    both = reduce(lambda a, b: a.join(b, "value", "full_outer"), here.values())
    both = both.withColumns({name: F.coalesce(name, F.lit(0)) for name in bucketed})
    alone = _repeated(key, others)
    parts = [_report_rows(both, _repeated(key, bucketed) | _order_rules())]
    for child, column, parent in q.RELATIONSHIPS:
        if column != key:
            continue
        orphans = _orphans(child, key, parent)
        if child in others and parent in others:
            alone |= orphans
        elif child in others:
            parts.append(_report_rows(moved.join(here[parent].select("value", parent), "value", "left"), orphans))
        else:
            parts.append(_report_rows(here[child].select("value", child).join(moved.select("value", parent), "value", "left"), orphans))
    return reduce(DataFrame.unionByName, [*parts, _report_rows(moved, alone)])


def check_report(
    tables: q.Tables,
    now: Column | None = None,
    minimum: Mapping[str, int] = q.MIN_ROWS,
    laid_out: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Failures of the 68 generic checks and the 16 rules.

    ``laid_out`` names, for a key, the tables that are bucketed by it (``Warehouse.bucketed``); they are not shuffled.

    One scan per table covers its row-level checks, one shuffle per key its uniqueness and
    relationships, and for orders the comparison with their items. Meant for persisted tables, so that
    no mart and no monitoring model is computed twice.
    """
    row_rules = _row_rules(now)
    keys = dict.fromkeys(q.UNIQUE.values())
    parts = [table_profile(t, tables[t], row_rules.get(t, {})) for t in q.NOT_NULL]
    laid_out = laid_out or {}
    parts += [bucketed_key_profile(tables, laid_out[key]) if key in laid_out else key_profile(tables, key) for key in keys]
    few = q.min_row_counts(tables["source_row_counts"], minimum)
    parts.append(_report_rows(few, {"rule:min_row_counts": F.count(F.lit(1))}))
    return reduce(DataFrame.unionByName, parts)
