"""Secret scans over an incremental ledger of blobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from corpusloom.llm.common import OWN, bit_table, full_text, may_have, staged


@dataclass(frozen=True)
class SecretRule:
    """A pattern (Java syntax) whose matches count when `group` has at least `least` characters."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int

    @property
    def label(self) -> str:
        return f"{self.kind}@{self.version}"


#: The base rules, in the order in which kinds are listed.
BASE_RULES = [
    SecretRule("assign", 1, r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    SecretRule("access", 1, r"AKIA[A-Z0-9]{12,}", 0, 16),
    SecretRule("hex", 1, r"[0-9a-f]{32,}", 0, 32),
]
LEDGER = "blob string, rule string, spans array<struct<start:int,end:int>>"


def blob_of(text: Column) -> Column:
    """The content address of a text: SHA-256 of its UTF-8 bytes; a null text is the empty blob."""
    return F.sha2(text, 256)


def _matches(rule: SecretRule) -> Column:
    """Per leftmost non-overlapping match of `_text`: lengths of the text before it, of itself and of its value."""
    pattern = F.lit(rule.pattern)
    found = F.transform(
        F.arrays_zip(
            F.split("_text", rule.pattern, -1).alias("gap"), F.regexp_extract_all("_text", pattern, F.lit(0)).alias("whole"),
            F.regexp_extract_all("_text", pattern, F.lit(rule.group)).alias("value"),
        ),
        lambda x: F.struct(
            F.lit(rule.label).alias("rule"), F.length(x["gap"]).alias("gap"), F.length(x["whole"]).alias("whole"), F.length(x["value"]).alias("value"),
        ),
    )
    none = F.array().cast("array<struct<rule:string,gap:int,whole:int,value:int>>")
    return F.when(F.array_contains("_todo", rule.label) & F.col("_text").rlike(rule.pattern), found).otherwise(none)


def unseen(versions: DataFrame, ledger: DataFrame | None, rules: list[SecretRule], path: str, text: str = "text") -> DataFrame:
    """(blob, _text, _todo): each different text once, with the rule versions that the ledger does not have for it."""
    addressed = versions.select(F.col(path).alias("_path"), full_text(text).alias("_text")).withColumn("blob", blob_of(F.col("_text")))
    labels = F.array(*[F.lit(r.label) for r in rules])
    # One path stands for all copies of a blob; texts do not take part in this step.
    todo = addressed.groupBy("blob").agg(F.min("_path").alias("_path"))
    if ledger is None:
        todo = todo.withColumn("_todo", labels)
    else:
        pairs = todo.withColumn("rule", F.explode(labels)).join(ledger.select("blob", "rule").distinct(), ["blob", "rule"], "left_anti")
        todo = pairs.groupBy("blob", "_path").agg(F.collect_set("rule").alias("_todo"))
    todo = todo.withColumnsRenamed({"blob": "_todo_blob", "_path": "_todo_path"})
    chosen = (F.col("blob") == F.col("_todo_blob")) & F.col("_path").eqNullSafe(F.col("_todo_path"))
    return addressed.join(todo, chosen).select("blob", "_text", "_todo")


def scan(versions: DataFrame, path: str, text: str = "text", ledger: DataFrame | None = None, rules: list[SecretRule] = BASE_RULES) -> DataFrame:
    """New rows (blob, rule, spans) for the ledger, written; only blobs and rule versions not in `ledger` are read.

    `versions` has one row per version of a path, or just the current ones. Spans are [start, end) in code points, in
    order; a blob without findings has a row with no spans, so that it is never scanned again for that rule version.
    Null and empty texts are the empty blob; repeated rows and copies are one blob; no versions give no rows.
    """
    todo = unseen(versions, ledger, rules, path, text)
    if len({r.label for r in rules}) < len(rules):
        raise ValueError("rules need different labels")
    least = F.create_map(*[F.lit(v) for r in rules for v in (r.label, r.least)])
    scanned = todo.select("blob", "_todo", F.concat(*[_matches(r) for r in rules]).alias("_found"))
    scanned = scanned.select(
        "blob", F.explode(F.transform("_todo", lambda label: F.struct(label.alias("rule"), F.filter("_found", lambda m: m["rule"] == label).alias("m")))).alias("x")
    ).select("blob", "x.rule", "x.m")
    # The last piece after a match has no match; its fields are null.
    rows = staged(scanned.dropDuplicates(["blob", "rule"]))
    order = W.partitionBy("blob", "rule").orderBy("at")
    hits = (
        rows.select("blob", "rule", F.posexplode("m").alias("at", "m")).filter("m.whole is not null")
        .withColumn("end", F.sum(F.col("m.gap") + F.col("m.whole")).over(order.rowsBetween(W.unboundedPreceding, 0)).cast("int"))
        .filter(F.col("m.value") >= least[F.col("rule")])
        .groupBy("blob", "rule").agg(F.sort_array(F.collect_list(F.struct((F.col("end") - F.col("m.whole")).alias("start"), F.col("end")))).alias("spans"))
    )
    none = F.array().cast("array<struct<start:int,end:int>>")
    return staged(rows.select("blob", "rule").join(hits, ["blob", "rule"], "left").select("blob", "rule", F.coalesce("spans", none).alias("spans")))


def findings(versions: DataFrame, ledger: DataFrame, text: str = "text", rules: list[SecretRule] = BASE_RULES) -> DataFrame:
    """All rows and columns of `versions` with `secrets`: array of (start, rank, kind, end) by start, then by the order of `rules`.

    Only rows whose blob may have findings move to meet them; a bitmap of bounded size tells the others, which stay where they
    are and have none. A column `secrets` of `versions` is replaced; other columns may have any names that don't begin with
    the mark of our own helper columns.
    """
    rank = F.create_map(*[F.lit(v) for i, r in enumerate(rules) for v in (r.label, i)])
    kind = F.split("rule", "@")[0]
    shape = "array<struct<start:int,rank:int,kind:string,end:int>>"
    current = (
        ledger.filter(F.col("rule").isin([r.label for r in rules]) & (F.size("spans") > 0))
        .withColumn("_kind", kind).withColumn("_rank", rank[F.col("rule")])
        .withColumn("s", F.explode("spans"))
        .groupBy("blob").agg(F.sort_array(F.collect_set(F.struct(F.col("s.start"), F.col("_rank").alias("rank"), F.col("_kind").alias("kind"), F.col("s.end")))).cast(shape).alias("secrets"))
    )
    # The blobs with findings are written, so that the join can split a blob that very many paths share.
    current = staged(current)
    current = current.withColumnsRenamed({"blob": f"{OWN}blob", "secrets": f"{OWN}secrets"})
    rows = versions.drop("secrets").withColumn(f"{OWN}blob", blob_of(full_text(text)))
    flagged = may_have(rows, f"{OWN}blob", *bit_table(current, f"{OWN}blob"), f"{OWN}may")
    none = F.array().cast(shape)
    met = flagged.filter(f"{OWN}may").join(current, f"{OWN}blob", "left").withColumn("secrets", F.coalesce(f"{OWN}secrets", none))
    found = flagged.filter(f"not {OWN}may").withColumn("secrets", none).drop(f"{OWN}blob", f"{OWN}may")
    return found.unionByName(met.drop(f"{OWN}blob", f"{OWN}may", f"{OWN}secrets"))


def spans_text(secrets: Column) -> Column:
    """kind:start:end of each finding, comma-joined."""
    return F.array_join(F.transform(secrets, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, secrets: Column, mask: str = "[secret]") -> Column:
    """The text with every found span, or union of overlapping ones, replaced by `mask`."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(done, s):
        gap = F.substring(text, done["at"] + 1, s["start"] - done["at"])
        fresh = s["start"] >= done["at"]
        return F.struct(
            F.when(fresh, F.concat(done["out"], gap, F.lit(mask))).otherwise(done["out"]).alias("out"), F.greatest(done["at"], s["end"]).alias("at"),
        )

    return F.when(F.size(secrets) == 0, text).otherwise(
        F.aggregate(secrets, start, step, lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))
    )
