"""Running SQL scripts: split, classify, run in order, report each statement."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import CalendarIntervalType

from quayside.functions.naming import helper_name
from quayside.functions.sqltext import classify, error_hint, split_statements, truncate_sql
from quayside.operators.dml_sql import run_dml
from quayside.sources.dialect import TIME_TEXT, CsvDialect
from quayside.sources.scan import with_typed_nulls
from quayside.storage import HadoopFiles, scratch_dir

_PLACE = helper_name("place")

#: A stored routine: takes the session and the call's argument values, returns rows or nothing.
Routine = Callable[..., DataFrame | None]

_CALL = re.compile(
    r"EXECUTE\s+SCRIPT\s+(?P<name>[^\s(]+)\s*(?:\((?P<arguments>.*)\))?\s*", re.I | re.S
)
_NOT_FOUND = re.compile(r"(TABLE|VIEW|SCHEMA|ROUTINE|FUNCTION|COLUMN)\w*_NOT_FOUND")


class EmptyScriptError(ValueError):
    """A script holds no statement."""


@dataclass(frozen=True)
class Outcome:
    """What one statement did.

    ``status`` is ``rows`` (a result set), ``affected`` (rows changed), ``ok``
    or ``failed``.
    """

    number: int
    statement: str
    display: str
    kind: str
    status: str
    rows: int | None = None
    result: DataFrame | None = None
    message: str | None = None

    @property
    def text(self) -> str:
        if self.status == "rows":
            return f"{self.rows} rows"
        if self.status == "affected" and self.rows is not None:
            return f"{self.rows} rows affected"
        return "failed" if self.status == "failed" else "OK"


@dataclass
class ScriptResult:
    """Outcomes of the statements that ran; a script stops at its first failure."""

    total: int
    outcomes: list[Outcome] = field(default_factory=list)
    spool: str | None = None
    """Folder that keeps the result sets."""

    def close(self, spark: SparkSession) -> None:
        """Remove what is kept of the result sets, which cannot be read any more."""
        if self.spool:
            HadoopFiles(spark).delete(self.spool)

    @property
    def executed(self) -> int:
        return sum(o.status != "failed" for o in self.outcomes)

    @property
    def failed(self) -> int:
        return len(self.outcomes) - self.executed

    @property
    def results(self) -> list[DataFrame]:
        """Result sets, in statement order, as they were when their statements ran."""
        return [o.result for o in self.outcomes if o.result is not None]

    @property
    def status_lines(self) -> list[str]:
        return [f"[{o.number}/{self.total}] {o.display} {o.text}" for o in self.outcomes]

    @property
    def summary(self) -> str:
        ran = len(self.outcomes)
        noun = "statement" if ran == 1 else "statements"
        return f"{ran} {noun} executed, {self.failed} failed"

    def report(self, spark: SparkSession) -> DataFrame:
        """One row per statement that ran: n, kind, status, rows, statement."""
        rows = [(o.number, o.kind, o.status, o.rows, o.display) for o in self.outcomes]
        return spark.createDataFrame(
            rows, "n int, kind string, status string, rows long, statement string"
        )


def run_script(
    spark: SparkSession,
    script: str,
    sink: str | None = None,
    format: str = "csv",
    routines: Mapping[str, Routine] | None = None,
) -> ScriptResult:
    """Run the statements of a script in order, each with its text unchanged.

    Each result set is evaluated once, when its statement runs, and kept below
    ``spark.checkpoint.dir`` until ``ScriptResult.close``, whatever later statements
    do to its tables.  With ``sink``, it is also written to ``<sink>/result_<number>``
    as CSV with a header or as JSON rows.  ``routines`` holds the callables behind
    ``EXECUTE SCRIPT name(arguments)``.
    """
    if format not in ("csv", "json"):
        raise ValueError(f"unsupported result format: '{format}'; supported: csv, json")
    statement = F.col("statement")
    text = spark.createDataFrame([(script,)], "script string")
    pieces = text.select(F.posexplode(split_statements(F.col("script"))).alias("n", "statement"))
    statements = pieces.select(
        "n", statement, truncate_sql(statement).alias("display"), classify(statement).alias("kind")
    ).orderBy("n").collect()
    if not statements:
        raise EmptyScriptError("No SQL statements to execute")
    spool = scratch_dir(spark, "script")
    run = _Run(spark, sink, format, {k.lower(): v for k, v in (routines or {}).items()}, spool)
    result = ScriptResult(len(statements), spool=spool)
    for row in statements:
        number = row.n + 1
        try:
            status, rows, frame = run.statement(number, row.statement, row.kind)
        except Exception as error:
            message = _error_text(spark, number, row.statement, error)
            result.outcomes.append(
                Outcome(number, row.statement, row.display, row.kind, "failed", message=message)
            )
            break
        result.outcomes.append(
            Outcome(number, row.statement, row.display, row.kind, status, rows, frame)
        )
    return result


@dataclass(frozen=True)
class _Run:
    spark: SparkSession
    sink: str | None
    format: str
    routines: Mapping[str, Routine]
    spool: str

    def statement(
        self, number: int, statement: str, kind: str
    ) -> tuple[str, int | None, DataFrame | None]:
        if kind == "Dml":
            return "affected", self._change(statement), None
        if kind == "Execute":
            frame = self._execute(statement)
        else:
            frame = self.spark.sql(statement)
        # Statements without result columns come back as an empty frame.
        if kind == "Ddl" or frame is None or not frame.columns:
            return "ok", None, None
        rows, frame = self._kept(number, frame)
        if self.sink is not None:
            self._deliver(number, frame)
        return "rows", rows, frame

    def _change(self, statement: str) -> int | None:
        changed = run_dml(self.spark, statement)
        if changed is not None:
            # Nobody could name the replaced files afterwards.
            changed.drop_previous(self.spark)
            return changed.rows
        # An insert has run when sql() returns; its write metric counts committed rows.
        plan = self.spark.sql(statement)._jdf.queryExecution().executedPlan()
        metric = plan.commandPhysicalPlan().metrics().get("numOutputRows")
        return metric.get().value() if metric.isDefined() else None

    def _execute(self, statement: str) -> DataFrame | None:
        call = _CALL.fullmatch(_without_comments(self.spark, statement))
        if call is None:
            return self.spark.sql(statement)
        name = call["name"].replace('"', "").replace("`", "").lower()
        if name not in self.routines:
            raise LookupError(f"object {call['name']} not found")
        arguments = (call["arguments"] or "").strip()
        values = self.spark.sql(f"SELECT {arguments}").first() if arguments else ()
        return self.routines[name](self.spark, *values)

    def _kept(self, number: int, frame: DataFrame) -> tuple[int, DataFrame]:
        """The number of rows, and the rows as they are now."""
        plan = frame._jdf.queryExecution().optimizedPlan()
        if plan.getClass().getSimpleName() in ("CommandResult", "LocalRelation"):
            return frame.count(), frame
        if any(isinstance(f.dataType, CalendarIntervalType) for f in frame.schema.fields):
            raise ValueError("results with calendar intervals cannot be kept; cast them to text")
        counted, names = Observation(), frame.columns
        # No file format has room for any name, nor for two columns of one name.
        rows = with_typed_nulls(frame.toDF(*(f"c{i}" for i in range(len(names)))))
        ordered = plan.outputOrdering().nonEmpty()
        if ordered:
            rows = rows.withColumn(_PLACE, F.monotonically_increasing_id())
        path = f"{self.spool}/result_{number:03d}"
        rows.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(path)
        kept = self.spark.read.schema(rows.schema).parquet(path)
        if ordered:
            kept = kept.orderBy(_PLACE).drop(_PLACE)
        return counted.get["rows"], kept.toDF(*names)

    def _deliver(self, number: int, frame: DataFrame) -> None:
        rows = with_typed_nulls(frame)
        path = f"{self.sink}/result_{number:03d}"
        if self.format == "csv":
            dialect = CsvDialect()
            rows = rows.select(*dialect.line_columns(rows.schema))
            rows.write.options(**dialect.write_options()).csv(path)
        else:
            rows.write.options(**TIME_TEXT).json(path)


def _without_comments(spark: SparkSession, statement: str) -> str:
    from quayside.functions.sqltext import strip_comments, trim_space

    text = spark.createDataFrame([(statement,)], "s string")
    return text.select(trim_space(strip_comments(F.col("s")))).first()[0]


def _error_text(spark: SparkSession, number: int, statement: str, error: Exception) -> str:
    message = str(error)
    condition = error.getCondition() if isinstance(error, PySparkException) else None
    searched = f"object not found: {message}" if _NOT_FOUND.search(condition or "") else message
    found = spark.createDataFrame([(searched,)], "message string")
    hint = found.select(error_hint(F.col("message"))).first()[0]
    lines = [f"Error in statement {number}:", f"  {statement}", "", f"  {message}"]
    return "\n".join(lines + (["", f"  Hint: {hint}"] if hint else []))
