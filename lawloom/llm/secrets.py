"""Secret scans with an incremental ledger of blobs.

Every historical version of every path is content-addressed (SHA-256 of its text).  The ledger
is a folder of Parquet runs that says which rules, each at which version, have seen which
blob, and what they found.  A scan

1. addresses all versions and takes one holder of each distinct blob (a partial aggregate of
   small rows: a third of all versions may share a blob),
2. anti-joins blobs and rule versions with the ledger,
3. reads the texts of the remaining holders and applies only the rules that are still due,
4. adds the answers, also the empty ones, to the ledger as one run, and
5. joins the findings of the current rules back to all versions by address.

A run counts once its write has been committed (Spark's success mark is there); what a failed
run left is passed over, and the next scan does its work again.  A rule that changes gets a new
version and sees every blob once more; other rules do not run.

Rules are columns over whole texts: a pattern, a cheap condition a text must meet to be
searched, and a check of each match.  Matches of a rule are leftmost and don't overlap; one
that fails its check is dropped and not tried anew.

Defined results: a null text is an empty one; an empty text has no spans; spans of different
kinds may overlap, and those that begin at one place are listed in the order of the rules;
repeated rows and rows of equal or null doc_id are all returned; an empty table gives no rows;
very long texts are scanned whole; extra columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialised, shared_folder
from .pii import listed, spans

FOUND = "array<struct<rule:string,start:int,end:int>>"
NONE = "array<struct<start:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: `needs` is a pattern without which a text isn't searched."""

    kind: str
    pattern: str
    needs: str
    check: Callable[[Column], Column] | None = None
    version: int = 1

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"

    def search(self, text: Column) -> Column:
        """array<struct<start, end>> of the checked matches."""
        hits = spans(text, self.pattern)
        hits = F.filter(hits, lambda s: self.check(s["m"])) if self.check else hits
        found = F.transform(hits, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
        return F.when(text.rlike(self.needs), found).otherwise(F.array().cast(NONE))


def least(n: int) -> Callable[[Column], Column]:
    return lambda m: F.length(m) >= n


# The base rules.  Letters of the announcing words count in either case.
ANNOUNCED = "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
ASSIGN = ANNOUNCED + r"[\"']?\x20*[:=]\x20*[\"']?"
BASE = (
    Rule("assign", ASSIGN + r"[A-Za-z0-9+/_.=-]+", ANNOUNCED + r"[\"']?\x20*[:=]", lambda m: F.length(F.regexp_replace(m, "^" + ASSIGN, "")) >= 6),
    Rule("access", r"AKIA[A-Z0-9]+", "AKIA[A-Z0-9]", least(20)),
    Rule("hex", r"[0-9a-f]{24,}", r"[0-9a-f]{24}"),  # the runs [0-9a-f]+ of 24 or more
)
# Further kinds, by the forms their issuers publish.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", "gh[pousr]_"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", "xox[abprs]-"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}", "AIza"),
    Rule("payment", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}", "k_(?:live|test)_"),
    Rule("signed", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}", "eyJ"),
    Rule("private", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", "PRIVATE KEY-----"),
    Rule("login", r"[a-z][a-z0-9+.-]{1,20}://[A-Za-z0-9._%+-]{1,64}:[A-Za-z0-9._%+-]{1,64}@", "://"),
)
RULES = BASE + MORE


class Ledger:
    """Runs of (blob, rules, found) below a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def runs(self) -> list[str]:
        """The folders of committed runs."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(self.folder)
        fs = path.getFileSystem(conf)
        if not fs.exists(path):
            return []
        folders = [s.getPath() for s in fs.listStatus(path) if s.isDirectory()]
        return sorted(p.toString() for p in folders if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def entries(self) -> DataFrame:
        """blob, the rules that have seen it (kind@version), and what they found."""
        schema = f"blob binary, rules array<string>, found {FOUND}"
        runs = self.runs()
        return self.spark.read.schema(schema).parquet(*runs) if runs else self.spark.createDataFrame([], schema)

    def add(self, entries: DataFrame) -> None:
        entries.select("blob", "rules", "found").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(f"{self.folder}/run={uuid.uuid4().hex}")


def addressed(versions: DataFrame, path: Sequence[str]) -> DataFrame:
    """The path columns, text, blob (its address) and pick (a number for the holder: where two
    holders of a blob agree in it, their texts are equal all the same)."""
    d = versions.select(*path, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return d.select("*", F.unhex(F.sha2("text", 256)).alias("blob"), F.xxhash64(*path).alias("pick"))


def due(blobs: DataFrame, ledger: Ledger, rules: Sequence[Rule]) -> DataFrame:
    """blob, pick and `due`, the rules that haven't seen the blob; only rows with any."""
    wanted = F.array(*[F.lit(r.key) for r in rules])
    if not ledger.runs():
        return blobs.withColumn("due", wanted)
    seen = ledger.entries().groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
    left = F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
    return blobs.join(seen, "blob", "left").select("blob", "pick", left.alias("due")).where(F.size("due") > 0)


def answers(rule: Rule) -> Column:
    """What a rule finds in `text`, if it is due there."""
    found = F.transform(rule.search(F.col("text")), lambda s: F.struct(F.lit(rule.key).alias("rule"), s["start"].alias("start"), s["end"].alias("end")))
    return F.when(F.array_contains("due", rule.key), found).otherwise(F.array().cast(FOUND))


def scan(versions: DataFrame, ledger: Ledger, rules: Sequence[Rule] = RULES, path: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Bring the ledger up to date; each version's path columns, blob (hex), the spans of each
    kind (array<struct<start, end>>), n_<kind>, base and spans (as text)."""
    d = addressed(versions, path)
    places = materialised(d.select(*path, "blob", "pick"))
    blobs = places.groupBy("blob").agg(F.min("pick").alias("pick"))
    texts = d.select("blob", "pick", "text").join(due(blobs, ledger, rules), ["blob", "pick"])
    ledger.add(texts.select("blob", F.col("due").alias("rules"), F.concat(*map(answers, rules)).alias("found")))

    keys = [r.key for r in rules]
    hits = ledger.entries().where(F.size("found") > 0).select("blob", F.filter("found", lambda f: f["rule"].isin(keys)).alias("found"))
    hits = hits.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("found"))).alias("found"))
    all_ = places.join(hits, "blob", "left")
    own = lambda r: F.coalesce(F.transform(F.filter("found", lambda f: f["rule"] == r.key), lambda f: F.struct(f["start"].alias("start"), f["end"].alias("end"))), F.array().cast(NONE))
    all_ = all_.select(*path, F.lower(F.hex("blob")).alias("blob"), *[own(r).alias(r.kind) for r in rules])
    base = [(r.kind, F.col(r.kind)) for r in rules if r.kind in {b.kind for b in BASE}]
    return all_.select("*", *[F.size(r.kind).cast("long").alias(f"n_{r.kind}") for r in rules], (listed(base) if base else F.lit("")).alias("base"), listed([(r.kind, F.col(r.kind)) for r in rules]).alias("spans"))


def own_ledger(spark: SparkSession) -> Ledger:
    """An empty ledger of one's own in the shared folder."""
    return Ledger(spark, f"{shared_folder(spark)}/ledgers/{uuid.uuid4().hex}")
