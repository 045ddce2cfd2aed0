"""Data-quality checks (Q1-Q7), the price-jump test (W2) and test-run summaries.

Checks are declarative specs; ``run_checks`` fuses every row-level check of a
table (not_null, accepted_values, expression) into ONE aggregate per table,
and runs one grouped aggregate per uniqueness check, so a table is scanned
once for all its row-level checks instead of once per check.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow import dims
from tickflow.functions.numeric import dround
from tickflow.functions.timeutil import minus, seconds_between, ts_lit
from tickflow.plans import ranges


# ------------------------------------------------------------------ W2

def price_jumps(minute: DataFrame) -> DataFrame:
    """Minute-to-minute jumps beyond the per-symbol sanity limit (strict >)."""
    base = minute.select("commodity", "symbol", "minute_bucket", "last_price")
    lagged = ranges.with_lag(base, ["commodity", "symbol"], ["minute_bucket"], ["last_price"])
    pct = F.when(F.col("prev_last_price").isNull() | (F.col("prev_last_price") == 0), F.lit(None)) \
        .otherwise(F.abs(F.col("last_price") - F.col("prev_last_price")) / F.col("prev_last_price"))
    limit = None
    for sym, lim in dims.JUMP_LIMITS.items():
        c = (F.col("symbol") == sym) & (F.col("pct_change") > lim)
        limit = c if limit is None else (limit | c)
    return (lagged.withColumn("pct_change", pct)
            .filter(F.col("pct_change").isNotNull() & limit)
            .select("commodity", "symbol", "minute_bucket", "last_price",
                    F.col("prev_last_price").alias("prev_price"), "pct_change"))


# ------------------------------------------------------------------ check specs (Q1-Q5)

@dataclass(frozen=True)
class Check:
    kind: str            # not_null | unique | accepted_values | expression | price_jump
    columns: tuple = ()  # one column, or the key columns of a uniqueness check
    values: tuple = ()   # accepted values
    expr: str = ""       # SQL boolean expression; NULL result passes

    @property
    def name(self) -> str:
        if self.kind == "expression":
            return f"expression_is_true:{self.expr}"
        if self.kind == "accepted_values":
            return f"accepted_values:{self.columns[0]}"
        return f"{self.kind}:{'+'.join(self.columns)}"


def not_null(col: str) -> Check:
    return Check("not_null", (col,))


def unique(*cols: str) -> Check:
    return Check("unique", tuple(cols))


def accepted(col: str, values) -> Check:
    return Check("accepted_values", (col,), tuple(values))


def expression(sql: str) -> Check:
    return Check("expression", (), (), sql)


def _row_failure(c: Check) -> Column:
    if c.kind == "not_null":
        return F.count_if(F.col(c.columns[0]).isNull())
    if c.kind == "accepted_values":
        col = F.col(c.columns[0])
        return F.count_if(col.isNotNull() & ~col.isin(*c.values))
    if c.kind == "expression":
        return F.count_if(F.coalesce(~F.expr(c.expr), F.lit(False)))
    raise ValueError(c.kind)


def duplicates(df: DataFrame, keys) -> DataFrame:
    """Key values occurring more than once, one row each.

    Of a single column NULL is no value; a combination of columns is grouped with its
    NULLs.  The grouped table has the key columns only, so nothing else is shuffled.
    """
    keys = list(keys)
    rows = df.select(*keys)
    if len(keys) == 1:
        rows = rows.filter(F.col(keys[0]).isNotNull())
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def _rows(table: str, names: list[str], agg: DataFrame, cols: list[str]) -> DataFrame:
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(n).alias("check_name"),
                 F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias("failures"))
        for n, c in zip(names, cols)])).alias("r")).select("r.*")


def run_checks(tables: dict[str, DataFrame], specs: dict[str, list[Check]]) -> DataFrame:
    """All checks -> (table_name, check_name, failures, status) (Q7).

    Per table all row-level checks share one global aggregate, of which each
    task forwards one row; a uniqueness check counts its duplicated keys, and
    only the key columns go through its shuffle.  The price-jump test counts the
    jumps of the minute mart.
    """
    parts = []
    for table, checks in specs.items():
        df = tables[table]
        row_checks = [c for c in checks if c.kind not in ("unique", "price_jump")]
        uniq = [c for c in checks if c.kind == "unique"]
        jumps = [c for c in checks if c.kind == "price_jump"]
        names = [c.name for c in row_checks]
        cols = [f"c{i}" for i in range(len(row_checks))]
        if row_checks:
            agg = df.agg(*[_row_failure(c).alias(k) for c, k in zip(row_checks, cols)])
            parts.append(_rows(table, names, agg, cols))
        for c in uniq:
            dup = duplicates(df, c.columns)
            parts.append(_rows(table, [c.name], dup.agg(F.count(F.lit(1)).alias("_dup")), ["_dup"]))
        for c in jumps:
            found = price_jumps(df).agg(F.count(F.lit(1)).alias("_jumps"))
            parts.append(_rows(table, [c.name], found, ["_jumps"]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))


COMMODITIES = ("gold", "bitcoin", "eurusd")
CURRENCIES = ("USD",)
MOVE_TYPES = ("MEDIUM_MOVE", "LARGE_MOVE", "EXTREME_MOVE")


def default_specs() -> dict[str, list[Check]]:
    """The staging and mart checks of the original project."""
    return {
        "stg_raw_prices": [
            expression("event_ts <= ingest_ts + INTERVAL 1 MINUTE"),
            expression("event_ts >= ingest_ts - INTERVAL 24 HOURS"),
            not_null("event_id"), unique("event_id"),
            not_null("commodity"), accepted("commodity", COMMODITIES),
            not_null("symbol"), not_null("price"),
            not_null("currency"), accepted("currency", CURRENCIES),
            not_null("event_ts"), not_null("ingest_ts"), not_null("source"),
        ],
        "mart_latest_prices": [
            unique("commodity", "symbol"), expression("last_price > 0"),
            not_null("commodity"), accepted("commodity", COMMODITIES),
            not_null("symbol"), not_null("last_timestamp"), not_null("last_price"),
            not_null("currency"), accepted("currency", CURRENCIES), not_null("source"),
        ],
        "mart_minute_last_price": [
            unique("commodity", "symbol", "minute_bucket"),
            expression("min_price <= max_price"), expression("last_price > 0"),
            expression("min_price > 0"), expression("max_price > 0"), expression("n >= 1"),
            not_null("commodity"), accepted("commodity", COMMODITIES),
            not_null("symbol"), not_null("minute_bucket"), not_null("last_price"),
            not_null("n"), not_null("min_price"), not_null("max_price"),
            Check("price_jump", ("last_price",)),
        ],
        "mart_price_events": [
            unique("commodity", "symbol", "event_ts"),
            expression("price_change_pct is not null"),
            not_null("commodity"), accepted("commodity", COMMODITIES),
            *[not_null(c) for c in ("symbol", "prev_event_ts", "event_ts", "time_gap_seconds",
                                    "current_price", "prev_price", "price_change_pct",
                                    "event_type")],
            accepted("event_type", MOVE_TYPES),
        ],
        "mart_price_volatility_1h": [
            unique("commodity", "symbol", "hour_bucket"),
            expression("observations_count >= 1"), expression("min_price <= max_price"),
            not_null("commodity"), accepted("commodity", COMMODITIES),
            *[not_null(c) for c in ("symbol", "hour_bucket", "observations_count", "avg_price",
                                    "min_price", "max_price", "price_stddev", "price_range",
                                    "range_pct")],
        ],
    }


# ------------------------------------------------------------------ test runs

TEST_DOCUMENT = ("metadata struct<generated_at: string>, "
                 "results array<struct<unique_id: string, status: string, failures: bigint>>, _broken string")


def read_test_documents(spark: SparkSession, path: str) -> DataFrame:
    """Run-results JSON documents, one per file: (file, run_ts_utc, results, broken).

    A file that is no such document is a row with ``broken`` set and no results; its time, like
    that of a document without one, is the file's.
    """
    docs = (spark.read.schema(TEST_DOCUMENT).option("multiLine", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_broken").json(path))
    at = F.try_to_timestamp(F.col("metadata.generated_at"))
    results = F.coalesce("results", F.array().cast("array<struct<unique_id: string, status: string, failures: bigint>>"))
    return docs.select(F.col("_metadata.file_path").alias("file"),
                       F.coalesce(at, F.col("_metadata.file_modification_time")).cast("timestamp_ntz").alias("run_ts_utc"),
                       results.alias("results"), (F.col("_broken").isNotNull() | F.col("results").isNull()).alias("broken"))


def document_runs(documents: DataFrame, environment: str = "dev", keep: Sequence[str] = ()) -> DataFrame:
    """A test run per document (S8 to A16): counts by status; a broken document is a failed run with one error."""
    def n(status: str) -> Column:
        return F.size(F.filter("results", lambda r: r["status"] == status))

    broken = F.col("broken").cast("int")
    bad = broken + n("error") + n("fail")
    status = F.when(bad > 0, RUN_FAIL).when(n("warn") > 0, RUN_WARN).otherwise(RUN_PASS)
    return documents.select(
        *keep, "run_ts_utc", F.lit(environment).alias("environment"), status.alias("status"), F.size("results").alias("total"),
        *[(n(s) + broken if s == "error" else n(s)).alias(s) for s in TEST_STATUSES], "broken")


# Per-test statuses and run statuses.
TEST_STATUSES = ["pass", "warn", "error", "fail", "skipped"]
RUN_FAIL, RUN_WARN, RUN_PASS = "FAIL", "WARN", "PASS"


def summarise(results: DataFrame, run_col: str = "run_ts_utc", environment: str = "dev") -> DataFrame:
    """Per run: pass/warn/error/fail/skipped/total and the run status (A16):
    any error or fail -> FAIL, else any warn -> WARN, else PASS."""
    s = F.col("status")
    g = results.groupBy(run_col).agg(
        F.count(F.lit(1)).cast("int").alias("total"),
        *[F.count_if(s == st).cast("int").alias(st) for st in TEST_STATUSES])
    status = (F.when((F.col("error") > 0) | (F.col("fail") > 0), RUN_FAIL)
              .when(F.col("warn") > 0, RUN_WARN).otherwise(RUN_PASS))
    return g.select(run_col, F.lit(environment).alias("environment"), status.alias("status"),
                    "total", "pass", "warn", "error", "fail", "skipped")


def failed_runs(runs: DataFrame, as_of, minutes: int = 35) -> DataFrame:
    """FAIL runs in the trailing window."""
    return runs.filter((F.col("run_ts_utc") >= minus(as_of, f"{minutes} minutes"))
                       & (F.col("status") == RUN_FAIL))


def pass_rate(runs: DataFrame, as_of, hours: int = 24) -> DataFrame:
    """Share of passed tests and newest run age over a trailing window."""
    w = runs.filter(F.col("run_ts_utc") >= minus(as_of, f"{hours} hours"))
    return w.agg(dround(F.sum("pass") * 100.0 / F.sum("total"), 2).alias("pass_rate_pct"),
                 F.floor(seconds_between(ts_lit(as_of), F.max("run_ts_utc"))).cast("bigint")
                 .alias("seconds_since_last_run"))
