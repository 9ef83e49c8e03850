"""Secret scanning with an incremental blob ledger, DataFrame only.

Every version of every path is addressed by the SHA-256 of its content. The
ledger is a Parquet table with one row per (blob, rule set version) that has
been scanned, holding its findings. A run

1. lists (path columns, blob) of all versions,
2. keeps the (blob, rule version) pairs the ledger lacks,
3. scans one copy of each such blob and appends the findings to the ledger,
4. joins the findings of the ledger back to all paths.

Content that recurs - copies, reverts, renames - is scanned once, and a new
rule version rescans every blob once.

Matches are leftmost and non-overlapping per rule, as a regular-expression
scan finds them: splitting the text at the matches gives the gaps, so each
span is a running sum of gap and match lengths, in code points.

Defined results: null text is the empty text; empty texts, texts without a
match and tables without rows give no spans (count 0, empty string); equal
texts share one blob; repeated rows stay repeated; null path values are kept; a
text of any length is matched whole, in the memory of one task. Path columns may
have any names: one called as a column of ``FINDINGS`` stays, and the finding's
column is then called ``found_`` and its name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds, ``need`` (matched against the whole finding) decides
    whether a finding counts. A failing finding still uses up its text."""
    kind: str
    pattern: str
    need: str | None = None
    base: bool = True


# The patterns of the rules.
_ASSIGN = r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?"""
_VALUE = r"[A-Za-z0-9+/_.=-]"
RULES = (
    Rule("assign", _ASSIGN + _VALUE + "+", _ASSIGN + _VALUE + "{12,}"),
    # Runs are maximal, so asking for the length in the pattern is the same
    # as dropping short runs, and cheaper.
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
    # The method's own additions.
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", base=False),
    Rule("forge", r"\bgh[pousr]_[A-Za-z0-9]{36,}", base=False),
)
RULES_VERSION = "1"

FINDINGS = ("blob", "rules_version", "spans")


def _rule_spans(text: Column, rule: Rule, rank: int) -> Column:
    """array<struct<start, rank, end, kind>> of one rule's findings."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    gaps = F.split(text, rule.pattern, -1)

    def walk(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["gap"])
        end = start + F.length(pair["hit"])
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        keep = pair["hit"].rlike(f"^(?:{rule.need})$") if rule.need else F.lit(True)
        return F.struct(end.alias("at"), F.when(keep, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    pairs = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
    empty = F.expr("cast(array() as array<struct<start:int,rank:int,end:int,kind:string>>)")
    spans = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("out")), walk, lambda acc: acc["out"])
    return F.when(text.rlike(rule.pattern), spans).otherwise(empty)


def find_spans(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """All findings, sorted by start, then by the order of the rules."""
    return F.array_sort(F.concat(*[_rule_spans(text, r, i) for i, r in enumerate(rules)]))


def span_list(spans: Column, kinds: list[str] | None = None) -> Column:
    """kind:start:end, comma-joined."""
    if kinds is not None:
        spans = F.filter(spans, lambda s: s["kind"].isin(kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _address(text: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


def update_ledger(versions: DataFrame, text: str = "text", ledger: str | None = None,
                  rules: tuple[Rule, ...] = RULES, rules_version: str = RULES_VERSION) -> DataFrame:
    """Scan what the ledger lacks and return its rows for this rule version, one per blob.

    ``ledger`` is the folder of the ledger table (a fresh one in the shared
    scratch folder without it). It is only appended to, by one run at a time; a
    run that is repeated finds its pairs already there.
    """
    spark = versions.sparkSession
    ledger = ledger or scratch_path(spark, "secret-ledger")
    known = _read_ledger(spark, ledger)
    blobs = versions.select(_address(text).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if known is not None:
        done = known.filter(F.col("rules_version") == rules_version).select("blob")
        blobs = blobs.join(done, "blob", "left_anti")
    # One copy of each unseen blob; the partial aggregate drops copies within
    # a map task before anything is shuffled.
    unseen = blobs.dropDuplicates(["blob"])
    (unseen.select("blob", F.lit(rules_version).alias("rules_version"), find_spans(F.col("text"), rules).alias("spans"))
     .write.mode("append").parquet(ledger))
    return spark.read.parquet(ledger).filter(F.col("rules_version") == rules_version)


def scan_versions(versions: DataFrame, path_columns: list[str], text: str = "text", ledger: str | None = None,
                  rules: tuple[Rule, ...] = RULES, rules_version: str = RULES_VERSION) -> DataFrame:
    """path columns, blob, rules_version and spans of every version (see ``update_ledger``)."""
    found = update_ledger(versions, text, ledger, rules, rules_version)
    paths = versions.select(*path_columns, _address(text).alias("__blob"))
    found = found.select(*[F.col(c).alias(f"__found_{c}") for c in FINDINGS])
    taken = {c.lower() for c in path_columns}
    named = [F.col(f"__found_{c}").alias(f"found_{c}" if c in taken else c) for c in FINDINGS]
    return paths.join(found, F.col("__blob") == F.col("__found_blob"), "left").select(*path_columns, *named)


def base_digest(findings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id with the counts, the digest of the base rules' spans, and all spans."""
    base = [r.kind for r in rules if r.base]
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return findings.select("doc_id", *[count(k).alias(f"n_{k}") for k in base],
                           F.sha2(span_list(F.col("spans"), base).cast("binary"), 256).alias("base_sha256"),
                           span_list(F.col("spans")).alias("spans"))


def mask_secrets(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every finding replaced by ``[KIND]``; all rows and columns stay.

    Overlapping findings are masked together, under the kind that starts first.
    Null texts stay null. Rows are matched to findings by content, so repeated
    or null ids do no harm.
    """
    found = (update_ledger(docs, ledger=ledger, rules=rules).filter(F.size("spans") > 0)
             .select(F.col("blob").alias("__blob"), F.col("spans").alias("__spans")))

    def cut(acc: Column, s: Column) -> Column:
        piece = F.when(s["start"] >= acc["at"],
                       F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]),
                                F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), piece.alias("out"))

    masked = F.aggregate("__spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), cut,
                         lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    joined = docs.withColumn("__blob", _address("text")).join(found, "__blob", "left")
    text = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(masked)
    return joined.withColumn("text", text).select(*docs.columns)
