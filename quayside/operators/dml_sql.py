"""UPDATE, DELETE and MERGE statements, run as the operators of :mod:`.dml`.

Spark parses the statement; the parsed plan names the table and holds the values
and conditions, which are handed on as columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from quayside.functions.naming import quote_identifier
from quayside.operators.dml import DmlResult, MergeClause, delete, merge, update


def run_dml(spark: SparkSession, statement: str) -> DmlResult | None:
    """Run an UPDATE, DELETE or MERGE; ``None`` if the statement is another one."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(statement)
    run = {"UpdateTable": _update, "DeleteFromTable": _delete, "MergeIntoTable": _merge}
    kind = _kind(plan)
    return run[kind](spark, plan) if kind in run else None


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _items(sequence) -> list:
    return [sequence.apply(i) for i in range(sequence.size())]


def _column(spark: SparkSession, expression) -> Column:
    return Column(spark._jvm.org.apache.spark.sql.classic.ExpressionUtils.column(expression))


def _condition(spark: SparkSession, option) -> Column | None:
    return _column(spark, option.get()) if option.isDefined() else None


def _relation(plan) -> tuple[str, str | None]:
    """Table name and alias of a relation, with or without one."""
    if _kind(plan) == "SubqueryAlias":
        return _relation(plan.child())[0], plan.alias()
    return ".".join(map(quote_identifier, _items(plan.multipartIdentifier()))), None


def _assignments(spark: SparkSession, actions) -> dict[str, Column]:
    return {
        _items(item.key().nameParts())[-1]: _column(spark, item.value())
        for item in _items(actions)
    }


def _update(spark: SparkSession, plan) -> DmlResult:
    table, alias = _relation(plan.table())
    values = _assignments(spark, plan.assignments())
    return update(spark, table, values, _condition(spark, plan.condition()), alias)


def _delete(spark: SparkSession, plan) -> DmlResult:
    table, alias = _relation(plan.table())
    return delete(spark, table, _column(spark, plan.condition()), alias)


def _merge(spark: SparkSession, plan) -> DmlResult:
    table, alias = _relation(plan.targetTable())
    source_plan = plan.sourceTable()
    if _kind(source_plan) == "SubqueryAlias":
        source_alias = source_plan.alias()
    else:
        source_alias = _items(source_plan.multipartIdentifier())[-1]
    target_alias = alias or table.split("`")[-2]
    columns, source = spark.table(table).columns, _frame(spark, source_plan)

    def clause(action) -> MergeClause:
        kind = _kind(action)
        values = None
        if kind in ("UpdateStarAction", "InsertStarAction"):
            values = {name: f"{quote_identifier(source_alias)}.{quote_identifier(name)}" for name in columns}
        elif kind != "DeleteAction":
            values = _assignments(spark, action.assignments())
        return MergeClause(kind[:6].lower(), _condition(spark, action.condition()), values)

    sides = {target_alias.lower(): columns, source_alias.lower(): source.columns}
    if not _has_key(plan.mergeCondition(), sides):
        raise ValueError("MERGE needs ON with an equality of a value of the target and one of the source")
    return merge(
        spark,
        table,
        source,
        _column(spark, plan.mergeCondition()),
        target_alias=target_alias,
        source_alias=source_alias,
        matched=[clause(a) for a in _items(plan.matchedActions())],
        not_matched=[clause(a) for a in _items(plan.notMatchedActions())],
        not_matched_by_source=[clause(a) for a in _items(plan.notMatchedBySourceActions())],
    )


def _frame(spark: SparkSession, plan) -> DataFrame:
    dataset = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, plan)
    return DataFrame(dataset, spark)


def _has_key(condition, sides: dict[str, list[str]]) -> bool:
    """Whether one of the joined conditions equates something of one side with something of the other."""
    if _kind(condition) == "And":
        return _has_key(condition.left(), sides) or _has_key(condition.right(), sides)
    if _kind(condition) != "EqualTo":
        return False
    left, right = _sides_of(condition.left(), sides), _sides_of(condition.right(), sides)
    return len(left) == len(right) == 1 and left != right


def _sides_of(expression, sides: dict[str, list[str]]) -> set[str]:
    """The aliases of the sides whose columns an expression uses."""
    found = set()
    for leaf in _items(expression.collectLeaves()):
        if _kind(leaf) != "UnresolvedAttribute":
            continue
        names = [name.lower() for name in _items(leaf.nameParts())]
        if len(names) > 1 and names[-2] in sides:
            found.add(names[-2])
        else:
            found |= {alias for alias, own in sides.items() if names[0] in map(str.lower, own)}
    return found
