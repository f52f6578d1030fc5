"""Secret scans over an incremental ledger of blobs, in DataFrame operations only.

Every historical version of a path is addressed by its content (SHA-256). The
ledger holds one row per blob, rule and rule version that has been scanned, with
the spans found. A scan

1. reduces the given versions to their distinct blobs, in a narrow table without
   texts, and chooses one path of each,
2. leaves out the (blob, rule, rule version) triples the ledger already holds,
3. runs the rules over the chosen rows of the rest and writes a new ledger table,
4. joins the findings back to every path whose version is that blob.

A blob that many paths share is scanned once, and a later run over a grown
history scans only what is new; a rule whose version changes is run again.

No text is shuffled: a row learns from bitmaps of bounded size, broadcast,
whether it is to be scanned. A bitmap may name a row too many, never one too
few; what such a row finds is left out by the narrow table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimflow.llm.common import bitmap_of, filter_bits, flag_members, staged, text_of
from dimflow.llm.spans import with_matches

LEDGER_SCHEMA = ("blob binary, rule string, version int, "
                 "spans array<struct<start:int,end:int>>")


@dataclass(frozen=True)
class Rule:
    """``pattern`` proposes spans; those whose capture ``group`` has ``least`` characters stay.

    ``hint`` is a pattern that occurs in every text with a span that stays.
    """
    name: str
    version: int
    pattern: str
    least: int
    hint: str
    group: int = 0


# The three rules of the scan; ASCII letters of the first in either case.
_WORDS = ("([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
          "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])")
ASSIGN = _WORDS + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
RULES = (
    Rule("assign", 1, ASSIGN, 12, _WORDS + r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12}""", group=2),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 18, r"AKIA[A-Z0-9]{14}"),
    Rule("hex", 1, r"[0-9a-f]{16,}", 16, r"[0-9a-f]{16}"),
)


def _wanted(versions: DataFrame, ledger: DataFrame | None, rules: Sequence[Rule]) -> DataFrame:
    """``blob, key, many, rules`` of every blob with unseen rules: the key of its chosen row, whether others share it."""
    blobs = versions.groupBy("blob").agg(F.min("path").alias("path"), (F.count(F.lit(1)) > 1).alias("many"))
    current = F.array(*[F.lit(f"{rule.name}:{rule.version}") for rule in rules])
    if ledger is None:
        unseen = current
    else:
        done = ledger.groupBy("blob").agg(F.collect_set(F.concat_ws(":", "rule", "version")).alias("seen"))
        blobs = blobs.join(done, "blob", "left")
        unseen = F.array_except(current, F.coalesce("seen", F.array().cast("array<string>")))
    wanted = blobs.select("blob", F.xxhash64("blob", "path").alias("key"), "many", unseen.alias("rules"))
    return staged(wanted.where(F.size("rules") > 0), "secret_wanted")


def _flagged(rows: DataFrame, keys: DataFrame, key: Column, flag: str) -> DataFrame:
    """``rows`` with a boolean column: may ``key`` be among ``keys``? No row moves."""
    bits = filter_bits(keys.count())
    return flag_members(rows, key, bitmap_of(keys, bits), bits, flag)


def scan_blobs(versions: DataFrame, ledger: DataFrame | None, rules: Sequence[Rule] = RULES) -> DataFrame:
    """New ledger rows for the unseen (blob, rule, version) triples of ``versions`` (``path, blob, __text``)."""
    wanted = _wanted(versions, ledger, rules)
    chosen = F.xxhash64("blob", "path")
    blobs = versions
    if ledger is None:  # every blob: only those of several rows need a choice
        several = wanted.where("many")
        blobs = _flagged(blobs, several.select(F.xxhash64("blob").alias("key")), F.xxhash64("blob"), "__many")
        blobs = _flagged(blobs, several.select("key"), chosen, "__chosen")
        blobs = blobs.withColumn("__scan", ~F.col("__many") | F.col("__chosen"))
        for rule in rules:
            blobs = blobs.withColumn(f"__new_{rule.name}", F.col("__scan"))
    else:
        for rule in rules:
            keys = wanted.where(F.array_contains("rules", f"{rule.name}:{rule.version}")).select("key")
            blobs = _flagged(blobs, keys, chosen, f"__new_{rule.name}")

    def unseen(rule: Rule) -> Column:
        return F.col(f"__new_{rule.name}")

    any_unseen = unseen(rules[0])
    for rule in rules[1:]:
        any_unseen = any_unseen | unseen(rule)
    blobs = blobs.where(any_unseen)
    for rule in rules:
        blobs = with_matches(blobs, "__text", rule.pattern, unseen(rule) & F.col("__text").rlike(rule.hint),
                             rule.name, group=rule.group or None)

    def long_enough(rule: Rule) -> Column:
        field = "part" if rule.group else "hit"
        return F.filter(rule.name, lambda s: F.length(s[field]) >= rule.least)

    entries = F.array(*[
        F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.version).alias("version"), unseen(rule).alias("new"),
                 F.transform(long_enough(rule), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
                 .alias("spans"))
        for rule in rules])
    triple = F.concat_ws(":", "e.rule", "e.version")
    found = (blobs.select("blob", F.explode(F.filter(entries, lambda e: e["new"] & (F.size(e["spans"]) > 0))).alias("e"))
             .groupBy("blob", triple.alias("triple")).agg(F.first("e.spans").alias("spans"))
             .groupBy("blob").agg(F.map_from_entries(F.collect_list(F.struct("triple", "spans"))).alias("found")))
    # Written first: a row that a bitmap named too many finds nothing that the narrow table does not ask for.
    found = staged(found, "secret_found")
    asked = wanted.join(found, "blob", "left").select("blob", "found", F.explode("rules").alias("triple"))
    version = F.substring_index("triple", ":", -1)
    none = F.array().cast(found.schema["found"].dataType.valueType)
    return asked.select(
        "blob", F.expr("left(triple, length(triple) - length(substring_index(triple, ':', -1)) - 1)").alias("rule"),
        version.cast("int").alias("version"), F.coalesce(F.try_element_at("found", F.col("triple")), none).alias("spans"))


def scan(versions: DataFrame, path_col: str = "path", text_col: str = "text", ledger: DataFrame | None = None,
         rules: Sequence[Rule] = RULES) -> tuple[DataFrame, DataFrame]:
    """``(findings, new_ledger)`` of every version of every path.

    ``findings`` has one row per row of ``versions``: ``path``, ``blob`` and
    ``spans``, an array of (start, end, kind) by start, then rule as listed;
    empty where nothing was found. ``new_ledger`` has the rows to append to the
    ledger (``LEDGER_SCHEMA``), already written to the shared folder. A null text
    is the empty blob; repeated rows and null paths each keep their row.
    """
    rows = versions.select(F.col(path_col).alias("path"), text_of(text_col).alias("__text"))
    rows = rows.withColumn("blob", F.unhex(F.sha2("__text", 256)))
    new = staged(scan_blobs(rows, ledger, rules), "secret_ledger")
    current = F.array(*[F.lit(f"{r.name}:{r.version}") for r in rules])
    known = new if ledger is None else ledger.select(*new.columns).unionByName(new)
    found = known.where((F.size("spans") > 0) & F.array_contains(current, F.concat_ws(":", "rule", "version")))
    order = F.array_position(F.array(*[F.lit(r.name) for r in rules]), F.col("rule"))
    spans = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), order.alias("rank"),
                                                    s["end"].alias("end"), F.col("rule").alias("kind")))
    # Written first: the join then has a plain exchange on either side, and the partition of a hot blob can be split.
    by_blob = staged(found.select("blob", spans.alias("spans")).groupBy("blob")
                     .agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("__spans")), "secret_findings")
    findings = rows.select("path", "blob").join(by_blob, "blob", "left").select(
        "path", "blob", F.transform(F.coalesce("__spans", F.array().cast(by_blob.schema["__spans"].dataType)),
                                    lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                       s["kind"].alias("kind"))).alias("spans"))
    return findings, new
