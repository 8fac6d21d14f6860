"""Run logs and AUC distributions.

A run log is NDJSON with ``record.message`` (a printed Python dict) and
``record.time.timestamp``.  Messages are cut into string literals and the rest, repaired to JSON piece by piece
and parsed with ``from_json`` - no driver-side parsing.  Session
AUC densities are Gaussian kernel sums on a fixed grid: tasks sum the kernels of the distinct
AUC values (with their counts) of an Arrow batch at once, and one small aggregate adds the sums.
"""

from __future__ import annotations

import math
import time
from typing import Optional, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankfold.config import SUMMARY_FIELDS
from rankfold.operators.indexing import with_global_index
from rankfold.session import written

DETAIL_TYPE = ("struct<session_id:string,auc:double,size:bigint,positives:bigint,negatives:bigint,"
               "positive_rate:double>")
RESULT_TYPE = (f"map<string,struct<GAUCSimple:double,GAUCWeighted:double,n_groups:bigint,std:double,min:double,"
               f"max:double,median:double,GAUC_valid:boolean,group_details:array<{DETAIL_TYPE}>>>")


# ---------------------------------------------------------------- S6
LOG_SCHEMA = "record struct<message:string,time:struct<timestamp:double>>"


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """NDJSON run log -> (message, timestamp).  Explicit schema: no
    inference pass over the log; other fields of a record are ignored."""
    raw = spark.read.schema(LOG_SCHEMA).json(path)
    return raw.select(F.col("record.message").alias("message"), F.col("record.time.timestamp").alias("timestamp"))


# ---------------------------------------------------------------- rendering (the writer side)
def _py_str(c):
    """Python string literal of a column: backslashes, apostrophes and line ends escaped."""
    for plain, escaped in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        c = F.replace(c, F.lit(plain), F.lit(escaped))
    return F.concat(F.lit("'"), c, F.lit("'"))


_SUMMARY_NUMBERS = ("GAUCSimple", "GAUCWeighted", "n_groups", "std", "min", "max", "median")


def _py_value(c):
    """Python-literal text of a column value (True / False / None, numbers)."""
    return F.when(c.isNull(), F.lit("None")).otherwise(c.cast("string"))


def render_messages(details: DataFrame, chunk_sessions: int = 100_000, start_time: Optional[float] = None,
                    metrics: Optional[DataFrame] = None, chunk: Optional[F.Column] = None,
                    part: Optional[F.Column] = None) -> DataFrame:
    """Write group details as printed-dict messages, one per (target, chunk of
    at most ~``chunk_sessions`` sessions): ``{'<target>': {'group_details':
    [{'session_id': ..., 'auc': ..., ...}, ...]}}``.  With ``metrics`` (one row
    per target) each message also carries that target's summary fields.
    Output has the run-log shape ``record struct<message, time struct<timestamp>>``.
    ``chunk`` (a whole number per row) names the messages instead of ``chunk_sessions``;
    a message's time is ``start_time`` plus its chunk.  ``part`` cuts a chunk into
    several messages of its time, which ``select_result`` reads as one with ``parts=True``."""
    if chunk is None:
        counts = details.groupBy("target").agg(F.count(F.lit(1)).alias("_n"))
        k = F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(float(chunk_sessions)))).cast("long")
        d = details.join(counts, "target").withColumn("_chunk", F.pmod(F.xxhash64("session_id"), k))
    else:
        d = details.withColumn("_chunk", chunk)
    d = d.withColumn("_part", F.lit(0) if part is None else part)
    item = F.concat(
        F.lit("{'session_id': "), _py_str(F.col("session_id")),
        F.lit(", 'auc': "), F.col("auc").cast("string"),
        F.lit(", 'size': "), F.col("size").cast("string"),
        F.lit(", 'positives': "), F.col("positives").cast("string"),
        F.lit(", 'negatives': "), F.col("negatives").cast("string"),
        F.lit(", 'positive_rate': "), F.col("positive_rate").cast("string"), F.lit("}"))
    msgs = d.groupBy("target", "_chunk", "_part").agg(F.array_join(F.collect_list(item), ", ").alias("_items"))
    t0 = float(start_time if start_time is not None else time.time())
    summary_text = F.lit("'GAUC_valid': True")
    if metrics is not None:
        m = metrics.select("target", *_SUMMARY_NUMBERS, "GAUC_valid")
        msgs = msgs.join(m, "target", "left")
        parts = [F.concat(F.lit(f"'{f}': "), _py_value(F.col(f))) for f in _SUMMARY_NUMBERS]
        parts.append(F.concat(F.lit("'GAUC_valid': "),
                              F.when(F.col("GAUC_valid"), F.lit("True")).otherwise(F.lit("False"))))
        summary_text = F.concat_ws(", ", *parts)
    message = F.concat(F.lit("{"), _py_str(F.col("target")), F.lit(": {"), summary_text,
                       F.lit(", 'group_details': ["), F.col("_items"), F.lit("]}}"))
    return msgs.select(F.struct(message.alias("message"),
                                F.struct((F.lit(t0) + F.col("_chunk").cast("double")).alias("timestamp"))
                                .alias("time")).alias("record"))


# ---------------------------------------------------------------- G1
_TOKEN = r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|[^'"]+"""


def _json_string(token):
    """A Python string literal (either quote) as a JSON string."""
    body = F.substring(token, F.lit(2), F.length(token) - 2)
    for old, new in (("\\\\", "\u0001"), ("\\'", "'"), ('\\"', '"'), ('"', '\\"')):
        body = F.replace(body, F.lit(old), F.lit(new))
    body = F.regexp_replace(body, r"\\x([0-9a-fA-F]{2})", r"\\u00$1")
    return F.concat(F.lit('"'), F.replace(body, F.lit("\u0001"), F.lit("\\\\")), F.lit('"'))


def repair_message(message) -> F.Column:
    """G1: printed dict -> JSON text.  The message is cut into string literals
    and the rest; quotes and escapes change only inside the first, True / False
    / None only in the second.  Without an escape or a quotation mark every apostrophe
    bounds a literal, so such a message is cut at them and needs no pattern."""
    m = F.col(message) if isinstance(message, str) else message

    def unquoted(t):
        plain = t
        for word, value in (("True", "true"), ("False", "false"), ("None", "null")):
            plain = F.regexp_replace(plain, rf"\b{word}\b", value)
        # most pieces hold nothing to repair
        return F.when(t.contains("True") | t.contains("False") | t.contains("None"), plain).otherwise(t)

    def repaired(t):
        body = F.substring(t, F.lit(2), F.length(t) - 2)
        simple = F.concat(F.lit('"'), body, F.lit('"'))
        literal = F.when(body.contains("\\") | body.contains('"'), _json_string(t)).otherwise(simple)
        return F.when(t.startswith("'") | t.startswith('"'), literal).otherwise(unquoted(t))

    pieces = F.array_join(F.transform(F.split(m, "'"), lambda t, i: F.when(i % 2 == 0, unquoted(t)).otherwise(t)), '"')
    tokens = F.array_join(F.transform(F.regexp_extract_all(m, F.lit(_TOKEN), 0), repaired), "")
    return F.when(m.contains("\\") | m.contains('"'), tokens).otherwise(pieces)


def parse_messages(logs: DataFrame, message_col: str = "message", strict: bool = True) -> DataFrame:
    """G1: add ``parsed`` (map target -> result struct); lines that are no dict
    give NULL.  A message that starts like a dict and does not parse raises, or
    gives NULL with ``strict=False``."""
    text = F.trim(F.col(message_col))
    parsed = F.from_json(repair_message(message_col), RESULT_TYPE)
    out = logs.withColumn("parsed", F.when(text.startswith("{"), parsed))
    if strict:
        broken = F.raise_error(F.concat(F.lit("unreadable result message: "), F.substring(text, 1, 200))).cast(RESULT_TYPE)
        out = out.withColumn("parsed", F.when(text.startswith("{") & F.col("parsed").isNull(), broken).otherwise(F.col("parsed")))
    return out


# ---------------------------------------------------------------- G2 / G3
def select_result(logs: DataFrame, target: str, field: str = "group_details",
                  position: Optional[int] = None, parts: bool = False, strict: bool = True) -> DataFrame:
    """The messages that hold a result for ``target`` (selected by shape),
    optionally only the ``position``-th from the end by timestamp (e.g. -10);
    with ``parts`` the messages of one time are parts of one, and all of them
    come out; returns (timestamp, value) with ``value`` = ``parsed[target][field]``."""
    if field not in SUMMARY_FIELDS:
        raise ValueError(f"no such summary field: {field!r}")
    flat = logs
    if "message" not in logs.columns and "record" in logs.columns:
        flat = logs.select(F.col("record.message").alias("message"),
                           F.col("record.time.timestamp").cast("double").alias("timestamp"))
    p = parse_messages(flat, strict=strict)
    hits = p.where(F.col("parsed").isNotNull() & F.map_contains_key("parsed", F.lit(target)))
    if position is not None:
        n = abs(int(position)) if position < 0 else None
        if n is None:
            raise ValueError("position counts from the end and must be negative")
        if parts:
            # read twice, for its times and for the chosen one: the messages are made and parsed once
            hits = written(hits.select("timestamp", F.col("parsed")[target][field].alias("value")))
            times = [r[0] for r in hits.select("timestamp").distinct().orderBy(F.desc("timestamp")).limit(n).collect()]
            if len(times) < n:
                raise IndexError(f"message {position} of {len(times)} for target {target!r}")
            return hits.where(F.col("timestamp").eqNullSafe(F.lit(times[-1]).cast("double")))
        # top-n by time (small n): one TakeOrderedAndProject, then the n-th row
        last = hits.orderBy(F.desc("timestamp"), F.desc("message")).limit(n)
        nth = last.orderBy(F.asc("timestamp"), F.asc("message")).limit(1)
        found = last.count()
        if found < n:
            raise IndexError(f"message {position} of {found} for target {target!r}")
        hits = nth
    return hits.select("timestamp", F.col("parsed")[target][field].alias("value"))


def session_aucs(logs: DataFrame, target: str, position: Optional[int] = None, parts: bool = False, strict: bool = True) -> DataFrame:
    """One row per session entry of the selected result(s).  ``strict=False`` passes over unreadable results, which
    :func:`unreadable` counts."""
    r = select_result(logs, target, "group_details", position, parts, strict)
    return r.select(F.inline("value")).select("session_id", "auc", "size", "positives", "negatives",
                                              "positive_rate")


def unreadable(logs: DataFrame) -> int:
    """Messages that start like a result and do not parse (e.g. one that holds ``nan`` or a tuple)."""
    flat = logs.select(F.col("record.message").alias("message")) if "message" not in logs.columns else logs
    p = parse_messages(flat, strict=False)
    return p.where(F.trim("message").startswith("{") & F.col("parsed").isNull()).count()


def all_session_aucs(logs: DataFrame, strict: bool = True) -> DataFrame:
    """G3 for every target at once: each message is parsed a single time and
    its map entries are unnested to (target, session entries)."""
    flat = logs
    if "message" not in logs.columns and "record" in logs.columns:
        flat = logs.select(F.col("record.message").alias("message"))
    p = parse_messages(flat, strict=strict).where(F.col("parsed").isNotNull())
    per_target = p.select(F.explode("parsed").alias("target", "result"))
    return per_target.select("target", F.inline("result.group_details")).select(
        "target", "session_id", "auc", "size", "positives", "negatives", "positive_rate")


# ---------------------------------------------------------------- G4 / G5
def grid(points: int = 101, lo: float = 0.0, hi: float = 1.0) -> list[float]:
    return [lo + (hi - lo) * i / (points - 1) for i in range(points)]


def auc_density(aucs: DataFrame, value_col: str = "auc", run_col: Optional[str] = None,
                points: Sequence[float] = None) -> DataFrame:
    """Gaussian kernel density on ``points`` per run, bandwidth by Scott's
    rule ``h = stddev_samp * n^(-1/5)``.  Runs with fewer than two values or
    zero spread have no density.  Output: (run, x, density)."""
    xs = np.array(list(points) if points is not None else grid(), float)
    run = F.col(run_col) if run_col else F.lit("all")
    v = aucs.select(run.cast("string").alias("run"), F.col(value_col).cast("double").alias("a")).where(F.col("a").isNotNull())
    # the values are read once; what follows works on the distinct ones
    distinct = written(v.groupBy("run", "a").agg(F.count(F.lit(1)).alias("c")))
    n, shifted = F.sum("c"), F.col("a") - 0.5
    spread = (F.sum(F.col("c") * shifted * shifted) - F.sum(F.col("c") * shifted) * F.sum(F.col("c") * shifted) / n) / (n - 1)
    stats = distinct.groupBy("run").agg(n.alias("n"), F.sqrt(F.greatest(F.when(n >= 2, spread), F.lit(0.0))).alias("sd"), (F.max("a") > F.min("a")).alias("wide"))
    stats = stats.where((F.col("n") >= 2) & F.col("wide")).select("run", "n", (F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).alias("h"))

    def kernels(batches):
        for batch in batches:
            runs = batch.column(0).dictionary_encode()
            a, c, h = (batch.column(k).to_numpy(zero_copy_only=False).astype(float) for k in (1, 2, 3))
            code, sums = runs.indices.to_numpy(zero_copy_only=False), np.zeros((len(runs.dictionary), len(xs)))
            for k in range(0, len(a), 8192):
                part = slice(k, k + 8192)
                z = (xs[None, :] - a[part, None]) / h[part, None]
                np.add.at(sums, code[part], c[part, None] * np.exp(-0.5 * z * z))
            names = runs.dictionary.take(pa.array(np.repeat(np.arange(len(sums)), len(xs))))
            yield pa.RecordBatch.from_arrays([names, pa.array(np.tile(xs, len(sums))), pa.array(sums.ravel())], ["run", "x", "k"])

    sums = distinct.join(stats.select("run", "h"), "run").select("run", "a", "c", "h").mapInArrow(kernels, "run string, x double, k double")
    rows = sums.groupBy("run", "x").agg(F.sum("k").alias("k")).join(stats, "run")
    return rows.select("run", "x", (F.col("k") / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi))).alias("density"))


def cut_to_shortest(aucs: DataFrame, run_col: str, order_col: str) -> DataFrame:
    """Keep, per run, the first m values in ``order_col`` order, m being
    the smallest run size.  Ordered numbering without a per-run window."""
    idx = with_global_index(aucs, [run_col, order_col], "_g")
    per_run = idx.groupBy(run_col).agg(F.min("_g").alias("_start"), F.count(F.lit(1)).alias("_n"))
    m = per_run.agg(F.min("_n")).first()[0] or 0
    j = idx.join(per_run.select(run_col, "_start"), run_col)
    return j.where(F.col("_g") - F.col("_start") < F.lit(int(m))).drop("_g", "_start")
