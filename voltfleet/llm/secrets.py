"""Secret scans over an incremental blob ledger, in DataFrame functions only.

Every version of a text is addressed by its SHA-256. A ledger holds, for each pair of blob and rule version that has been
scanned, the spans found. A run scans a blob once, however many paths and versions share it, and only by rule versions that the
ledger lacks for it; findings are then joined back to every path.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as c


class Rule(NamedTuple):
    """A kind of secret: matches are leftmost and don't overlap; those whose ``group`` has under ``least`` characters are dropped."""

    kind: str
    pattern: str
    group: int
    least: int
    version: str = "1"

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


#: Fixed values. Order is that of spans with equal starts.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),  # runs are maximal, so shorter ones can be left out at once
)

_SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"


def pieces(text: Column, rule: Rule) -> Column:
    """Lengths in code points, in order of the matches of one rule: what stands before each, the match, and what of it is judged."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    judged = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
    sizes = [F.transform(x, lambda y: F.char_length(y).cast("bigint")) for x in (F.split(text, rule.pattern, -1), found, judged)]
    cells = F.arrays_zip(*[s.alias(n) for s, n in zip(sizes, ("gap", "taken", "size"), strict=True)])
    return F.when(text.rlike(rule.pattern), cells).otherwise(F.array()).cast("array<struct<gap:bigint,taken:bigint,size:bigint>>")


def blob_of(text: Column) -> Column:
    """Content address; a null text is the empty blob."""
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)


def scan(versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """New ledger rows: blob, rule (kind and version), spans, for pairs that ``ledger`` (blob, rule) lacks.

    ``versions`` has a column text, one row for each path and version. Copies are folded before and after the shuffle, so a
    blob that a third of all rows share is one row of each task. Matches are rows of their own, dealt by blob like the blobs, and
    running sums of their lengths are their places; so the work on a text grows with its matches. Empty tables give no rows.
    """
    blobs = versions.select(blob_of(F.col("text")).alias("blob"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).groupBy("blob").agg(F.first("text").alias("text"))
    if ledger is None:
        unseen = blobs.withColumn("seen", F.array().cast("array<string>"))
    else:
        seen = ledger.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        unseen = blobs.join(seen, "blob", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
    pairs = [F.struct(F.lit(r.key).alias("rule"), F.lit(i).alias("kind"), F.lit(r.least).alias("least"), F.when(~F.array_contains("seen", r.key), pieces(F.col("text"), r)).alias("pieces")) for i, r in enumerate(rules)]
    scanned = unseen.select("blob", F.explode(F.array(*pairs)).alias("pair")).where("pair.pieces is not null")
    matches = scanned.select("blob", "pair.rule", "pair.kind", "pair.least", F.posexplode_outer("pair.pieces").alias("at", "piece"))
    before = Window.partitionBy("blob", "rule").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = matches.select("blob", "rule", "kind", "least", "piece.taken", "piece.size", F.sum(F.col("piece.gap") + F.col("piece.taken")).over(before).alias("end"))
    span = F.when(F.col("size") >= F.col("least"), F.struct((F.col("end") - F.col("taken")).alias("start"), "kind", "end"))
    return placed.groupBy("blob", "rule").agg(F.array_sort(F.collect_list(span)).cast(_SPAN).alias("spans"))


def record(spark: SparkSession, folder: str, versions: DataFrame, rules: tuple[Rule, ...] = RULES) -> None:
    """Add the versions of one commit to the ledger in ``folder``: their paths, and scans of the pairs of blob and rule version new to it.

    ``versions`` has path, version and text. The texts themselves are not kept. Recording a commit twice adds its paths twice
    and scans nothing; a run that fails between the two tables leaves scans without paths, which the next one finds done.
    """
    ledger = scans(spark, folder)
    scan(versions, ledger, rules).write.mode("append").parquet(f"{folder}/scans")
    versions.select("path", "version", blob_of(F.col("text")).alias("blob")).write.mode("append").parquet(f"{folder}/paths")


def scans(spark: SparkSession, folder: str) -> DataFrame:
    """blob, rule, spans of all commits; none where nothing is recorded yet."""
    schema = f"blob string, rule string, spans {_SPAN}"
    try:
        return spark.read.schema(schema).parquet(f"{folder}/scans")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def recorded(spark: SparkSession, folder: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """path, version, found for every version ever recorded, whether or not its path still has that text."""
    return _joined(spark.read.parquet(f"{folder}/paths"), scans(spark, folder), rules)


def _joined(paths: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """Findings join their paths' blobs; those of blobs with very many paths are broadcast."""
    names = [r.key for r in rules]
    blobs = c.cut(ledger.where(F.col("rule").isin(names) & (F.size("spans") > 0)).groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("found")))
    return c.join_one(paths, blobs, "blob", "left").withColumn("found", F.coalesce("found", F.array().cast(_SPAN))).drop("blob")


def findings(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``versions`` with found: spans (start, kind number, end) of all rules in order, from a complete ledger."""
    return _joined(versions.withColumn("blob", blob_of(F.col("text"))), ledger, rules)


def _number(kind: int) -> Column:
    return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")


def digest(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Of rows with a column found: a count for each kind, all spans as text, and their digest; other columns stay."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    text = F.array_join(F.transform("found", lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"], s["end"])), ",")
    counts = {f"n_{r.kind}": _number(i) for i, r in enumerate(rules)}
    return found.withColumns(counts | {"spans": text}).withColumn("base_sha256", F.sha2("spans", 256)).drop("found")


def report(docs: DataFrame, rules: tuple[Rule, ...] = RULES, ledger: DataFrame | None = None) -> DataFrame:
    """doc_id, a count for each kind, all spans as text and their digest, for each row; null texts are empty."""
    new = scan(docs, ledger, rules)
    full = new if ledger is None else ledger.select("blob", "rule", "spans").unionByName(new)
    return digest(findings(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), full, rules).drop("text"), rules)


def clean_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` in whose text no rule finds a secret, all columns kept; blobs of very many rows are broadcast."""
    dirty = c.cut(scan(docs, None, rules).where(F.size("spans") > 0).select("blob", F.lit(True).alias("dirty")).distinct())
    return c.join_one(docs.select(F.struct(*docs.columns).alias("row"), blob_of(F.col("text")).alias("blob")), dirty, "blob", "left").where("dirty is null").select("row.*")


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents come in two commits, the second of which has all of them: it scans only blobs that the first did not have."""
    docs = c.read(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("path"), "text")
    folder = f"{c.shared_folder(spark)}/secrets-{uuid.uuid4().hex}"
    first = F.coalesce(F.crc32(F.col("path").cast("string")) % 2 == 0, F.lit(False))
    record(spark, folder, docs.where(first).withColumn("version", F.lit(1)))
    record(spark, folder, docs.withColumn("version", F.lit(2)))
    return digest(recorded(spark, folder).where("version = 2").select(F.col("path").alias("doc_id"), "found"))


QUERIES = {"op3_secret_scans": op3_secret_scans}


def _sql_spans(kind: int, name: str, pattern: str, size: str) -> str:
    return f"""SELECT doc_id, {kind} AS kind, '{name}' AS name, list_sum(list_transform(g[:i], lambda x: len(x))) + coalesce(list_sum(list_transform(m[:i - 1], lambda x: len(x))), 0) AS s, len(m[i]) AS n
FROM (SELECT doc_id, m, g, z, unnest(generate_series(1, len(m))) AS i
      FROM (SELECT doc_id, regexp_extract_all(t, {pattern}) AS m, string_split_regex(t, {pattern}) AS g, {size} AS z FROM d)) WHERE z[i] >= {RULES[kind].least}"""


_QUOTED = [f"$p${p}$p$" for p in (RULES[0].pattern, RULES[1].pattern, r"[0-9a-f]+")]

ORACLE = {
    "op3_secret_scans": "WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),\nf AS ("
    + "\nUNION ALL ".join(
        (
            _sql_spans(0, "assign", _QUOTED[0], f"list_transform(regexp_extract_all(t, {_QUOTED[0]}, 2), lambda x: len(x))"),
            _sql_spans(1, "access", _QUOTED[1], f"list_transform(regexp_extract_all(t, {_QUOTED[1]}), lambda x: len(x))"),
            _sql_spans(2, "hex", _QUOTED[2], f"list_transform(regexp_extract_all(t, {_QUOTED[2]}), lambda x: len(x))"),
        )
    )
    + """)
SELECT d.doc_id, count(*) FILTER (WHERE kind = 0)::BIGINT AS n_assign, count(*) FILTER (WHERE kind = 1)::BIGINT AS n_access, count(*) FILTER (WHERE kind = 2)::BIGINT AS n_hex,
       coalesce(string_agg(name || ':' || s::BIGINT || ':' || (s + n)::BIGINT, ',' ORDER BY s, kind), '') AS spans,
       sha256(coalesce(string_agg(name || ':' || s::BIGINT || ':' || (s + n)::BIGINT, ',' ORDER BY s, kind), '')) AS base_sha256
FROM d LEFT JOIN f USING (doc_id) GROUP BY d.doc_id""",
}
